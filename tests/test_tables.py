"""Tables are replaced whole or not at all."""

import threading
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from errlens.sources import models as MD
from errlens.sources import readers as RD
from errlens.sources import tables as TB
from errlens.sources import writers as WR

COLUMNS = ("id", "v")


def rows(spark, n, v):
    return spark.range(n).withColumn("v", F.lit(v))


def content(spark, path):
    return {r["v"]: r["n"] for r in RD.read_parquet(spark, path).groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}


def failing(spark, v):
    """Rows of which the later ones end their tasks."""
    return spark.range(0, 4000, 1, 8).withColumn("v", F.when(F.col("id") > 3000, F.raise_error(F.lit("no"))).otherwise(F.lit(v)))


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        WR.write_predictions(failing(spark, "x"), path, COLUMNS)
    assert TB.current(spark, path) is None
    WR.write_predictions(rows(spark, 10, "a"), path, COLUMNS)
    for write in (lambda d: WR.write_predictions(d, path, COLUMNS), lambda d: WR.write_csv_headerless(d, path),
                  lambda d: WR.write_single_csv(d, path)):
        with pytest.raises(PySparkException):
            write(failing(spark, "x"))
        assert content(spark, path) == {"a": 10}
    assert len([p for p in Path(path).iterdir() if p.name.startswith("attempt-")]) == 1


def test_all_sinks_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    for k, v in enumerate("abc"):
        WR.write_single_csv(rows(spark, k + 1, v), path)
        assert [tuple(r) for r in RD.read_csv(spark, path, schema="v STRING, id INT").select("v").distinct().collect()] == [(v,)]
    WR.write_csv_headerless(rows(spark, 7, "d"), path)
    assert RD.read_csv_headerless(spark, path, ["id", "v"]).filter("v = 'd'").count() == 7
    assert TB.current(spark, path).version == 4


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    WR.write_predictions(rows(spark, 10, "a"), path, COLUMNS)
    for _ in range(3):
        old = RD.read_parquet(spark, path)
        WR.write_predictions(old.union(old), path, COLUMNS)
    assert content(spark, path) == {"a": 80}


def test_two_writers_leave_one_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    errors = []

    def write(v, n):
        try:
            for _ in range(3):
                WR.write_predictions(rows(spark, n, v).repartition(5), path, COLUMNS)
        except Exception as e:                     # seen by the test below
            errors.append(e)

    threads = [threading.Thread(target=write, args=x) for x in (("a", 300), ("b", 500), ("c", 700))]
    for t in threads:
        t.start()
    while any(t.is_alive() for t in threads):
        if TB.versions(spark, path):               # readers meet whole tables only
            assert list(content(spark, path).items())[0] in (("a", 300), ("b", 500), ("c", 700))
    for t in threads:
        t.join()
    assert not errors
    assert list(content(spark, path).items())[0] in (("a", 300), ("b", 500), ("c", 700)) and len(content(spark, path)) == 1


def test_plain_folders_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, 4, "old").write.parquet(path)
    assert content(spark, path) == {"old": 4}
    with pytest.raises(PySparkException):
        WR.write_predictions(failing(spark, "x"), path, COLUMNS)
    assert content(spark, path) == {"old": 4}
    WR.write_predictions(rows(spark, 5, "new"), path, COLUMNS)
    assert content(spark, path) == {"new": 5} and list(Path(path).glob("part-*"))
    TB.replace(spark, path, rows(spark, 6, "newer").write.parquet, grace_s=0)
    assert content(spark, path) == {"newer": 6} and not list(Path(path).glob("part-*"))


def test_a_crashed_writer_is_ignored_and_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    WR.write_predictions(rows(spark, 4, "a"), path, COLUMNS)
    rows(spark, 9, "half").write.parquet(f"{path}/attempt-dead")
    assert content(spark, path) == {"a": 4}
    assert TB.vacuum(spark, path) == []
    assert TB.vacuum(spark, path, older_than_s=0) == ["attempt-dead"]
    assert content(spark, path) == {"a": 4}


def test_damage_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    WR.write_predictions(rows(spark, 100, "a").repartition(3), path, COLUMNS)
    next(Path(path).glob("attempt-*/part-*")).unlink()
    with pytest.raises(TB.DamagedTable):
        RD.read_parquet(spark, path)


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        WR.write_predictions(rows(spark, k + 1, "a"), path, COLUMNS)
    assert TB.versions(spark, path) == [1, 2, 3, 4]
    TB.replace(spark, path, rows(spark, 5, "a").write.parquet, grace_s=0)
    assert TB.versions(spark, path) == [4, 5] and TB.current(spark, path).version == 5
    assert len(list(Path(path).glob("attempt-*"))) == 2


def test_pipelines_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    for v in ("a", "b"):
        MD.save_pipeline(Pipeline(stages=[StringIndexer(inputCol="v", outputCol="i")]).fit(rows(spark, 3, v)), path)
    assert MD.load_pipeline(path).stages[0].labels == ["b"]

    class Broken:
        def write(self):
            raise OSError("full disk")

    with pytest.raises(OSError):
        MD.save_pipeline(Broken(), path)
    assert MD.load_pipeline(path).stages[0].labels == ["b"]


def test_partitioned_writes_do_not_sort(spark, tmp_path, monkeypatch):
    """A task holds a file per value open; with more values than files it sorts the rest, and nothing is lost."""
    plans, path, key = [], str(tmp_path / "t"), "spark.sql.maxConcurrentOutputFileWriters"
    before, publish = spark.conf.get(key), TB.replace

    def spy(session, at, write, *a, **k):
        plans.append(session.conf.get(key))
        return publish(session, at, write, *a, **k)

    monkeypatch.setattr(WR, "replace", spy)
    for values in (2, 9):
        df = spark.range(0, 4000, 1, 3).withColumn("v", F.concat(F.lit("v"), F.col("id") % values))
        WR.write_predictions(df, path, COLUMNS, partition_by=["v"])
        assert content(spark, path) == {f"v{k}": df.filter(f"id % {values} = {k}").count() for k in range(values)}
        assert RD.read_parquet(spark, path).distinct().count() == 4000
    assert plans == [str(TB.OPEN_FILES)] * 2 and spark.conf.get(key) == before
    with pytest.raises(PySparkException):
        WR.write_predictions(failing(spark, "x"), path, COLUMNS, partition_by=["v"])
    assert spark.conf.get(key) == before and RD.read_parquet(spark, path).distinct().count() == 4000


def test_writers_at_one_time_put_the_setting_back_once(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    first, second = TB.open_parts(spark), TB.open_parts(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == str(TB.OPEN_FILES)
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == before
