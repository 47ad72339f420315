"""Parquet folders whose part files have different columns.

The files' footers are read by the tasks, one row per file; files of one
schema meet in one row, so the driver sees each schema once, with a file
that has it.  The schemas are merged by name:

* a column that some files lack is null there;
* a number type that holds the other exactly wins: byte < short < int < long,
  int and float < double, integers < a decimal with room for them,
  the wider of two decimals;
* a date is widened to a timestamp without time zone;
* any other two types end the read with both files' names.

The scan then reads every file with the merged schema; the reader itself
widens and fills in, so filters and columns are still pushed down.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errlens.sources.tables import resolve

_SPARK_KEY = "org.apache.spark.sql.parquet.row.metadata"


class SchemaConflict(TypeError):
    """Two files have types of one column that no type holds."""


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``schema`` (JSON), ``files`` and one ``file`` for each schema among the part files below ``path``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))
    key = _SPARK_KEY

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        for b in batches:
            out = []
            for uri in b.column("path").to_pylist():
                store, name = pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and uri[6] != "/" else uri)
                with store.open_input_file(name) as f:
                    found = pq.ParquetFile(f).schema_arrow
                said = (found.metadata or {}).get(key.encode())
                out.append(said.decode() if said else from_arrow_schema(found, prefer_timestamp_ntz=True).json())
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(out, pa.string())], names=["path", "schema"])

    return files.mapInArrow(footers, "path string, schema string").groupBy("schema").agg(
        F.count(F.lit(1)).alias("files"), F.min("path").alias("file"))


_RANK = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}       # digits that the type may need


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both exactly, as far as the Parquet reader can widen to it."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if type(x) in _RANK and type(y) in _RANK:
            return x if _RANK[type(x)] > _RANK[type(y)] else y
        if isinstance(y, T.DoubleType) and isinstance(x, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)):
            return y
        if isinstance(y, T.TimestampNTZType) and isinstance(x, T.DateType):
            return y
        if isinstance(y, T.DecimalType) and type(x) in _RANK:
            whole = max(y.precision - y.scale, _RANK[type(x)])
            return T.DecimalType(whole + y.scale, y.scale) if whole + y.scale <= 38 else None
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def merge(schemas: list[tuple[T.StructType, str]]) -> T.StructType:
    """One schema for all; columns in the order in which they first appear, files by name."""
    merged: dict[str, tuple[T.DataType, str]] = {}
    for schema, file in sorted(schemas, key=lambda x: x[1]):
        for f in schema:
            if f.name not in merged:
                merged[f.name] = (f.dataType, file)
                continue
            kind, first = merged[f.name]
            both = wider(kind, f.dataType)
            if both is None:
                raise SchemaConflict(f"column {f.name!r} is {kind.simpleString()} in {first} and {f.dataType.simpleString()} in {file}")
            merged[f.name] = (both, first if both == kind else file)
    return T.StructType([T.StructField(n, t, True) for n, (t, _) in merged.items()])


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All part files below ``path`` as one table with the merged schema; partition columns too."""
    path = resolve(spark, path)
    found = [(T.StructType.fromJson(json.loads(r["schema"])), r["file"]) for r in file_schemas(spark, path).collect()]   # one row per schema
    if not found:
        raise FileNotFoundError(f"{path} has no Parquet file")
    return spark.read.schema(merge(found)).parquet(path)
