"""Sinks: predictions to Parquet, result tables to CSV, previews.

Every sink replaces its folder as a whole (:mod:`errlens.sources.tables`): a
write that fails leaves the old table, and it may read the table that it
replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errlens.sources.tables import open_parts, replace

# Column names of the stored predictions (fixed values: a data contract).
PREDICTION_COLUMNS = ("uid", "day", "label", "prediction", "probability")


def write_predictions(df: DataFrame, path: str,
                      columns: Sequence[str] = PREDICTION_COLUMNS,
                      partition_by: Sequence[str] = ()) -> None:
    """Project the prediction columns and replace a Parquet dataset.

    ``partition_by`` (e.g. ``["model"]``) lays the files out by value so a
    later read of one model prunes the others.  Written in parallel, one file
    per task and value; rows are not sorted by value first
    (:func:`errlens.sources.tables.open_parts`).
    """
    cols = list(partition_by) + [c for c in columns if c not in partition_by]
    writer = df.select(*cols).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with open_parts(df.sparkSession):
        replace(df.sparkSession, path, writer.parquet)


def write_csv_headerless(df: DataFrame, path: str) -> None:
    """Replace a folder of headerless CSV part files."""
    replace(df.sparkSession, path, df.write.option("header", "false").csv)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One headed CSV file, meant for small result tables.

    The rows meet in one writing task through a shuffle, so everything
    above it keeps its own tasks; the file streams out, in no order but that
    of ``df`` if it is sorted into one partition already.
    """
    replace(df.sparkSession, path, df.repartition(1).write.option("header", "true").csv)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | F.Column] = ()) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a total order (top-k plan)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
