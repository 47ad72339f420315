"""Sources: headed / headerless CSV, Parquet datasets, optional inputs.

Explicit schemas are the default: inferring types costs an extra full pass
over the input, which at large scale is a whole extra job.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errlens.sources.tables import open_parts, replace, resolve

# Observation table (one row per user-day) as used by the training and
# scoring steps.  Types are inferred from use; see FIXTURES.md §1.
OBSERVATION_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType(), False),
    T.StructField("day", T.IntegerType(), False),
    # a double: a column with gaps is usually written as 1.0, 4.0, ...
    T.StructField("stress", T.DoubleType(), True),
    T.StructField("phq4_score", T.DoubleType(), True),
    T.StructField("social_level", T.DoubleType(), True),
    T.StructField("sleep_duration", T.DoubleType(), True),
    T.StructField("daily_steps", T.DoubleType(), True),
    T.StructField("covid_total", T.DoubleType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("race", T.StringType(), True),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Headed CSV.

    With ``schema`` columns are matched by **name**: the header of the file
    gives the order, further columns are left out, a column that the schema
    names and the file lacks is an error, and so is a file of the folder
    with another header.  ``mode`` says what happens to a cell that does not
    parse: ``FAILFAST`` (default) ends the job, ``PERMISSIVE`` gives null,
    ``DROPMALFORMED`` drops the row.  With ``infer=True`` and no schema
    Spark reads the input once more to find types.
    """
    path = resolve(spark, path)
    if schema is None:
        return spark.read.option("header", "true").option("inferSchema", str(infer).lower()).csv(path)
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    # without inference only the header line is read
    header = spark.read.option("header", "true").option("inferSchema", "false").csv(path).columns
    missing = [f.name for f in wanted if header.count(f.name) != 1]
    if missing:
        raise ValueError(f"columns {missing} are not (or not once) in the header {header} of {path}")
    types = {f.name: f.dataType for f in wanted}
    in_file = T.StructType([T.StructField(c, types.get(c, T.StringType()), True) for c in header])
    reader = spark.read.option("header", "true").option("enforceSchema", "false").option("mode", mode)
    return reader.schema(in_file).csv(path).select(*types)


def split_csv(spark: SparkSession, path: str, schema: T.StructType | str, out: str) -> tuple[DataFrame, DataFrame]:
    """Headed CSV in one scan as two tables below ``out``: the rows that parse, and a quarantine of the lines that do not.

    The quarantine has ``file``, ``line`` (its text) and ``reason``: a wrong
    number of fields, or the columns whose cells are not of their type.
    Every line but headers and empty lines is in one of the two.  Columns
    are matched by name as in :func:`read_csv`.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    source = resolve(spark, path)
    header = spark.read.option("header", "true").option("inferSchema", "false").csv(source).columns
    missing = [f.name for f in wanted if header.count(f.name) != 1]
    if missing:
        raise ValueError(f"columns {missing} are not (or not once) in the header {header} of {path}")
    types = {f.name: f.dataType for f in wanted}
    bad, texts = "_line", [f"_{i}" for i in range(len(header))]
    in_file = T.StructType([T.StructField(c, types.get(c, T.StringType()), True) for c in header] + [T.StructField(bad, T.StringType(), True)])
    rows = (spark.read.option("header", "true").option("enforceSchema", "false").option("mode", "PERMISSIVE")
            # all fields are parsed, so a line with a wrong number of them is noticed
            .option("columnPruning", "false").option("columnNameOfCorruptRecord", bad).schema(in_file).csv(source))
    cells = F.from_csv(F.col(bad), ", ".join([*(f"{t} STRING" for t in texts), "_all STRING"]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_all"})
    wrong = F.filter(F.array(*(
        F.when(F.col("_cells")[t].isNotNull() & F.col("_cells")[t].try_cast(types[c]).isNull(), F.lit(f"{c} is no {types[c].simpleString()}"))
        for t, c in zip(texts, header) if c in types)), lambda x: x.isNotNull())
    reason = (F.when(F.col("_cells")["_all"].isNotNull(), F.lit(f"not {len(header)} fields"))
              .when(F.size(wrong) > 0, F.concat_ws("; ", wrong)).otherwise(F.lit("does not parse")))
    told = (rows.withColumn("_cells", F.when(F.col(bad).isNotNull(), cells))
            .select(*wanted.fieldNames(), F.col("_metadata.file_path").alias("_file"), F.col(bad),
                    F.when(F.col(bad).isNotNull(), reason).alias("_reason"), F.col(bad).isNotNull().alias("_quarantine")))
    with open_parts(spark):
        replace(spark, out, told.write.partitionBy("_quarantine").parquet)
    both = spark.read.schema(told.schema).parquet(resolve(spark, out))
    good = both.filter(~F.col("_quarantine")).select(*wanted.fieldNames())
    return good, both.filter("_quarantine").select(F.col("_file").alias("file"), F.col(bad).alias("line"), F.col("_reason").alias("reason"))


def read_csv_headerless(spark: SparkSession, path: str,
                        columns: Sequence[str] | T.StructType) -> DataFrame:
    """Headerless CSV (all part files of a folder), columns named by position.

    ``columns`` is a schema, or a list of names read as strings.
    """
    path = resolve(spark, path)
    if isinstance(columns, T.StructType):
        schema = columns
    else:
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.option("header", "false").schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str, fallback_glob: str | None = "part-*.parquet") -> DataFrame:
    """A whole Parquet dataset folder (all part files; partition columns too).

    If a stray file next to the parts has no Parquet footer, the folder's
    ``fallback_glob`` files are read instead; any other failure is raised.
    """
    path = resolve(spark, path)
    try:
        return spark.read.parquet(path)
    except (PySparkException, Py4JJavaError) as err:
        if fallback_glob is None or "CANNOT_READ_FILE_FOOTER" not in str(err):
            raise
        return spark.read.parquet(f"{path.rstrip('/')}/{fallback_glob}")


def _is_missing_path(err: AnalysisException) -> bool:
    cls = getattr(err, "getCondition", lambda: None)() or ""
    return cls == "PATH_NOT_FOUND" or "Path does not exist" in str(err)


def read_optional(read, *args, **kwargs) -> DataFrame | None:
    """Run a reader; give ``None`` when its input path does not exist.

    Only a missing path is turned into ``None``; any other failure (bad
    schema, permissions) is raised, so the caller can skip a step whose
    input is absent without hiding real errors.
    """
    try:
        return read(*args, **kwargs)
    except AnalysisException as err:
        if _is_missing_path(err):
            return None
        raise


def table_from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small driver-side result (importances, grid rows) → DataFrame.

    Only for tables whose size is bounded by the number of features,
    models or grid points.
    """
    return spark.createDataFrame(list(rows), schema)
