"""The state of counts by source equals a full run, whatever the order of the updates."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from errlens.operators import evaluate as E
from errlens.operators import state as ST
from errlens.sources import tables

DIMS = ["model", "month", "uid"]


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(8)
    data = [(f"day-{k % 5}", r.choice("ab"), r.choice(["01", "02", None]), f"u{r.randint(0, 9)}", r.randint(0, 1), r.choice([0.0, 1.0, None])) for k in range(900)]
    return spark.createDataFrame(data, "file string, model string, month string, uid string, label int, prediction double").cache()


def bag(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def full(rows):
    return bag(E.reduce_predictions(rows, DIMS)), bag(E.grouping_sets_of(E.reduce_predictions(rows, DIMS), ["month", "uid"], "model"))


def of(state):
    return bag(ST.counts(state)), bag(ST.accuracy_tables(state, ["month", "uid"], "model"))


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (3, 1, 1, 4, 0, 2, 1), (4, 3, 2, 1, 0, 0)])
def test_order_and_repetition_change_nothing(spark, rows, tmp_path, order):
    path = str(tmp_path / "s")
    for k in order:
        state = ST.update(rows.filter(F.col("file") == f"day-{k}"), path, DIMS, "file")
    assert of(state) == full(rows)
    assert bag(ST.confusion(state, by="model")) == bag(E.confusion_matrix(rows, by="model"))


def test_corrected_source_replaces_the_wrong_one(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    ST.update(rows.withColumn("prediction", F.lit(1.0)), path, DIMS, "file")
    for k in range(5):
        state = ST.update(rows.filter(F.col("file") == f"day-{k}"), path, DIMS, "file")
    assert of(state) == full(rows)
    # a file that became empty: its rows are gone if it is named
    empty = rows.filter("file = 'day-2' AND uid = 'nobody'")
    assert of(ST.update(empty, path, DIMS, "file")) == full(rows)
    assert of(ST.update(empty, path, DIMS, "file", applied=["day-2"])) == full(rows.filter("file <> 'day-2'"))


def test_files_are_the_sources_by_default(spark, rows, tmp_path):
    data, path = str(tmp_path / "data"), str(tmp_path / "s")
    rows.repartition(3).write.parquet(data)
    for _ in range(2):
        state = ST.update(spark.read.parquet(data), path, DIMS)
    assert of(state) == full(rows) and state.select("source").distinct().count() == 3


def test_failed_update_leaves_the_old_state(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    ST.update(rows, path, DIMS, "file")
    broken = rows.withColumn("label", F.when(F.col("uid") == "u3", F.raise_error(F.lit("no"))).otherwise(F.col("label")))
    with pytest.raises(PySparkException):
        ST.update(broken, path, DIMS, "file")
    with pytest.raises(ValueError):
        ST.update(rows, path, ["model"], "file")
    assert of(ST.load(spark, path)) == full(rows)


def test_update_of_a_stale_state_is_refused(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    ST.update(rows, path, DIMS, "file")
    with pytest.raises(tables.StaleTable):
        tables.replace(spark, path, rows.write.parquet, after=0)
    assert of(ST.load(spark, path)) == full(rows) and tables.current(spark, path).version == 1


def test_folded_sources_keep_their_counts(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    ST.update(rows, path, DIMS, "file")
    state = ST.fold(spark, path, F.col("source") <= "day-2", "early")
    assert of(state) == full(rows)
    assert {r["source"] for r in state.select("source").distinct().collect()} == {"early", "day-3", "day-4"}
    with pytest.raises(ValueError):
        ST.fold(spark, path, F.col("source") == "early", "day-3")
    assert of(ST.update(rows.filter("file = 'day-4'"), path, DIMS, "file")) == full(rows)
    assert ST.load(spark, str(tmp_path / "none")) is None


def test_empty_first_update(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    assert ST.update(rows.limit(0), path, DIMS, "file").count() == 0
    assert of(ST.update(rows, path, DIMS, "file")) == full(rows)
