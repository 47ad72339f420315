"""Small helpers shared by the operators of this subpackage.

Column selection is by exact name and position, so extra columns whose
names clash (also by case only) never reach an operator.  Intermediate
tables go to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.session import ensure_checkpoint_dir, scratch_path

SALTS = 64


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """``pick(df, alias="column")``: those columns only, by exact name (first of equal names)."""
    at: dict[str, int] = {}
    for i, n in enumerate(df.columns):
        at.setdefault(n, i)
    missing = [c for c in cols.values() if c not in at]
    if missing:
        raise ValueError(f"no column {missing}; there are {df.columns}")
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"_c{at[c]}").alias(a) for a, c in cols.items()))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def low_hashes(id_col: str, rows: int, wanted: int) -> Column:
    """Condition that keeps about four times ``wanted`` of ``rows`` rows, those of the smallest id hashes.

    The smallest hashes can then be sorted without every task sending
    ``wanted`` rows of its own.
    """
    share = min(1.0, 4 * wanted / max(rows, 1))
    return F.xxhash64(id_col) <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))


def salt(*cols: Column, salts: int = SALTS) -> Column:
    """A stable salt of a row."""
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def group_stats(rows: DataFrame, keys: list[str], id_col: str, salts: int = SALTS) -> DataFrame:
    """Size, smallest and largest id of each group, one row per (keys, salt).

    Rows of a group are first reduced per (keys, salt) with map-side
    combine, the at most ``salts`` partial rows of a group are reduced per
    key, and the totals go back to the partial rows.  A group that holds a
    third of all rows so reaches any later join as ``salts`` keys.
    ``rows`` needs a ``salt`` column.
    """
    part = rows.groupBy(*keys, "salt").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("lo"),
                                           F.max(id_col).alias("hi"))
    total = (part.groupBy(*keys).agg(F.sum("n").alias("group_size"), F.min("lo").alias("lowest"),
                                     F.max("hi").alias("highest")))
    cond = [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return (part.alias("p").join(total.alias("t"), on)
            .select(*(F.col(f"p.{k}").alias(k) for k in keys), "salt", "group_size", "lowest", "highest"))


def text_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the Arrow batches whose ``text`` column holds about ``max_bytes`` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        n = np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0))
        group = np.cumsum(n) // max_bytes
        cuts = np.flatnonzero(np.diff(group)) + 1
        for s, e in zip(np.r_[0, cuts], np.r_[cuts, b.num_rows]):
            yield b.slice(s, e - s)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    """The texts of a batch; null is empty."""
    return [t or "" for t in batch.column("text").to_pylist()]


def settled(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` that gives memory it has freed back to the system at its end; workers live on between tasks."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):               # another C library
            pass
    return wrapped


def out_batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in cols.values()],
                                      names=list(cols))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package (once per application), as ``--py-files`` would, by way of the shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/code/{sc.applicationId}"
    at = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/{package.name}.zip")
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(at.toString())
    _shipped.add(sc.applicationId)
