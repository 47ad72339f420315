"""Accuracy tables that are kept up to date file by file.

The state is a table of counts, ``(source, *dims, actual, predicted, n)``:
all that the accuracy tables and confusion matrices need of the rows, by the
file (or day, or batch) that the rows came from.  Counts of different
sources add up, so

* new sources are reduced alone, in one scan of their rows;
* a source that is applied again replaces its own counts: applying it twice
  changes nothing, and a corrected file replaces the wrong one;
* the order of the sources does not matter;
* the tables from the state equal those from all rows.

The state is replaced whole (:mod:`errlens.sources.tables`): an update that
fails leaves the old one.  An update writes as many rows as the state has,
which is bounded by sources x groups; :func:`fold` sums up sources that will
not come again.  One writer at a time: of two updates made from the same
state the later one would lose the earlier one, so it is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.operators.evaluate import confusion_of, grouping_sets_of, reduce_predictions
from errlens.session import scratch_path
from errlens.sources import tables

SOURCE = "source"


def load(spark: SparkSession, path: str) -> DataFrame | None:
    """The counts by source; None before the first update."""
    return spark.read.parquet(tables.resolve(spark, path)) if tables.current(spark, path) else None


def update(predictions: DataFrame, path: str, dims: Sequence[str], source: Column | str | None = None, label: str = "label",
           prediction: str = "prediction", applied: Sequence[str] = ()) -> DataFrame:
    """Put the rows' counts into the state at ``path`` in place of what their sources had; the new state.

    ``source`` tells where a row comes from, by default its file.
    ``applied`` names sources that are read in full although they may hold no
    row any more: their old counts go.
    """
    spark = predictions.sparkSession
    dims = list(dims)
    if SOURCE in dims:
        raise ValueError(f"a dimension may not be called {SOURCE!r}")
    of = F.input_file_name() if source is None else F.col(source) if isinstance(source, str) else source
    before = tables.current(spark, path)
    reduced = reduce_predictions(predictions.select(*dims, label, prediction, of.cast("string").alias(SOURCE)), [SOURCE, *dims], label, prediction)
    at = scratch_path(spark, "state-update")
    reduced.write.parquet(at)
    fresh = spark.read.schema(reduced.schema).parquet(at)
    state = fresh
    if before:
        names = fresh.select(SOURCE).distinct()
        if applied:
            names = names.union(spark.createDataFrame([(a,) for a in applied], f"{SOURCE} string")).distinct()
        old = load(spark, path)
        if set(old.columns) != set(fresh.columns):
            raise ValueError(f"the state has {sorted(old.columns)}, the update {sorted(fresh.columns)}")
        same = F.col(f"o.{SOURCE}").eqNullSafe(F.col(f"n.{SOURCE}"))
        state = old.alias("o").join(names.alias("n"), same, "left_anti").unionByName(fresh)
    tables.replace(spark, path, state.write.parquet, after=before.version if before else 0)
    return load(spark, path)


def fold(spark: SparkSession, path: str, where: Column, name: str) -> DataFrame:
    """Sum up the sources for which ``where`` holds as one source ``name``; they can no longer be replaced one by one."""
    before = tables.current(spark, path)
    if before is None:
        raise ValueError(f"{path} holds no state")
    old = load(spark, path)
    taken = F.coalesce(where, F.lit(False))
    if not old.filter(~taken & (F.col(SOURCE) == name)).isEmpty():
        raise ValueError(f"a source that is not folded has the name {name!r}")
    keys = [c for c in old.columns if c not in (SOURCE, "n")]
    folded = (old.withColumn(SOURCE, F.when(taken, F.lit(name)).otherwise(F.col(SOURCE)))
              .groupBy(SOURCE, *keys).agg(F.sum("n").alias("n")))
    tables.replace(spark, path, folded.write.parquet, after=before.version)
    return load(spark, path)


def counts(state: DataFrame) -> DataFrame:
    """The state summed over its sources: what :func:`errlens.operators.evaluate.reduce_predictions` gives of all rows."""
    return state.groupBy(*(c for c in state.columns if c not in (SOURCE, "n"))).agg(F.sum("n").alias("n"))


def accuracy_tables(state: DataFrame, dims: Sequence[str], by: Sequence[str] | str | None = None) -> DataFrame:
    """Accuracy by each dimension and overall (``grouping_sets_of``) from the state."""
    return grouping_sets_of(counts(state), dims, by)


def confusion(state: DataFrame, by: Sequence[str] | str | None = None) -> DataFrame:
    """Confusion matrix (``confusion_of``) from the state."""
    return confusion_of(counts(state), by)
