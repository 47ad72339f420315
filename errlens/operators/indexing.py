"""String index of a column with any number of labels, without a label array on the driver.

MLlib's ``StringIndexer`` gathers the labels of a column on the driver and
sends them to every task, which ends at some millions.  Here the index is a
table (``column``, ``label``, ``index``, ``n``) in the same order: most
frequent first, equal counts by label.

* Labels are counted for all columns in one scan (map-side combine), so a
  label that holds a third of the rows is one row a task in the shuffle.
* The order is a range partitioning of (column, count, label); a label's
  index is the prefix sum of the sizes of the earlier partitions plus its
  place in its own.  No task sorts all labels, nothing is collected.
* Applying is a join.  Labels with at least 1/1024 of the counted rows, so
  1024 at most, are broadcast; their rows never move.  The other rows meet
  the other labels by shuffle on the label, none of which is hot; rows that
  need no lookup are spread by a running number.  A hot label that was not
  counted is left to the engine's skew join.

Labels are compared as UTF-8 bytes, MLlib's by UTF-16 units; the orders
differ only among characters beyond U+FFFF.

Cases: a null label is not counted; null and unseen labels get the next free
index (``keep``), drop their rows (``skip``) or end the job (``error``); an
empty table gives no labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace as changed

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from errlens.operators.features import FeatureSpec
from errlens.session import scratch_path
from errlens.sources import tables

HEAVY = 1024
_SPREAD = 4096


def fit_index(df: DataFrame, columns: Sequence[str], partitions: int | None = None, path: str | None = None) -> DataFrame:
    """``column``, ``label``, ``index`` (double) and ``n`` of every label of every column.

    ``path`` keeps the index as a table that :func:`load_index` reads;
    otherwise it lies in the scratch folder of the application.
    """
    if not columns:
        raise ValueError("no column to index")
    spark = df.sparkSession
    cells = F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns)))
    counts = df.select(cells).filter("label IS NOT NULL").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("column"), F.desc("n"), F.col("label")]
    ranged = counts.repartitionByRange(partitions, *order) if partitions else counts.repartitionByRange(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "at": place})
    at = scratch_path(spark, "string-index")
    placed.write.parquet(at)
    placed = spark.read.schema(placed.schema).parquet(at)

    sizes = placed.groupBy("column", "part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    upto = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = sizes.select("column", "part", (F.sum("size").over(upto) - F.col("size") - F.col("first")).alias("base"))
    index = (placed.join(base, ["column", "part"])
             .select("column", "label", (F.col("base") + F.col("at")).cast("double").alias("index"), "n"))
    path = path or scratch_path(spark, "string-index-table")
    tables.replace(spark, path, index.write.parquet)
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column string, label string, index double, n long").parquet(tables.resolve(spark, path))


def apply_index(df: DataFrame, index: DataFrame, column: str, out: str | None = None, invalid: str = "keep", heavy: int = HEAVY) -> DataFrame:
    """``df`` with the index of ``column`` as ``out`` (``<column>_index`` unless given)."""
    if invalid not in ("keep", "skip", "error"):
        raise ValueError("invalid must be 'keep', 'skip' or 'error'")
    own = index.filter(F.col("column") == column).select("label", "index", "n")
    total, size = (own.agg(x).scalar() for x in (F.sum("n"), F.count(F.lit(1))))
    is_heavy = F.col("n") * heavy >= total
    few = own.filter(is_heavy).select(F.col("label").alias("_few"), F.col("index").alias("_few_index"))       # at most ``heavy`` rows
    rest = own.filter(~is_heavy).select(F.concat(F.lit("="), "label").alias("_key"), F.col("index").alias("_rest_index"))
    label = F.col(column).cast("string")
    marked = df.join(F.broadcast(few), label == F.col("_few"), "left")
    asks = F.col("_few_index").isNull() & label.isNotNull()
    spread = F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(_SPREAD)).cast("string"))
    found = marked.withColumn("_key", F.when(asks, F.concat(F.lit("="), label)).otherwise(spread)).join(rest, "_key", "left")
    at = F.coalesce("_few_index", "_rest_index")
    if invalid == "keep":
        at = F.coalesce(at, size.cast("double"))
    elif invalid == "error":
        at = F.coalesce(at, F.raise_error(F.concat(F.lit(f"{column}: no index for "), F.coalesce(label, F.lit("null")))).cast("double"))
    done = found.withColumn("_out", at)
    if invalid == "skip":
        done = done.filter("_out IS NOT NULL")
    out = out or f"{column}_index"
    return done.select(*(F.col(c) for c in df.columns if c != out), F.col("_out").alias(out))


def with_indices(df: DataFrame, index: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``df`` with the index column of every categorical feature of ``spec``."""
    for c, out in zip(spec.categorical, spec.index_cols):
        df = apply_index(df, index, c, out, spec.index_invalid)
    return df


def indexed_spec(spec: FeatureSpec) -> FeatureSpec:
    """``spec`` for rows that :func:`with_indices` made: the index columns are numbers already."""
    return changed(spec, numeric=tuple(spec.vector_names), categorical=())
