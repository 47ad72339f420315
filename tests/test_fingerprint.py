"""Fingerprints of splits: order-free, exact, and a guard before scoring."""

import random

import pytest
from pyspark.sql import functions as F

from errlens.operators import fingerprint as FP
from errlens.operators import prep as P

KEYS = ("uid", "day")


def table(spark, n=2000, seed=1):
    r = random.Random(seed)
    rows = [(f"u{k % 37}", 20200101 + k, r.random(), None if k % 11 == 0 else "a:b") for k in range(n)]
    return spark.createDataFrame(rows + rows[:50], "uid string, day int, x double, note string")


def saved(df, **kw):
    return FP.fingerprint(P.hash_split(df, KEYS, seed=5)[0], KEYS, df.columns, seed=5, **kw)


def test_order_and_layout_do_not_matter_but_copies_do(spark):
    df = table(spark)
    a = FP.digests(df, df.columns).first()
    assert FP.digests(df.repartition(7).orderBy("x"), df.columns).first() == a
    assert FP.digests(df.dropDuplicates(), df.columns).first() != a
    assert FP.digests(df.union(df.limit(1)), df.columns).first() != a


def test_parts_add_up(spark):
    df = table(spark)
    parts = FP.digests(df, df.columns, {"p": P.split_part(KEYS, seed=5)}).collect()
    whole = FP.digests(df, df.columns).first()
    for c in ("rows", "lane0", "lane1", "lane2", "lane3"):
        assert sum(r[c] for r in parts) == whole[c]


def test_texts_of_different_rows_differ(spark):
    df = spark.createDataFrame([("a,1:b", "c"), ("a", "1:b,c"), (None, "-"), ("-", None), ("", None), (None, "")], "a string, b string")
    assert df.select(FP.row_text(["a", "b"]).alias("t")).distinct().count() == 6


def test_right_split_passes_and_wrong_ones_are_named(spark, tmp_path):
    df = table(spark)
    FP.save(spark, saved(df), str(tmp_path / "fp"))
    fp = FP.load(spark, str(tmp_path / "fp"))
    assert fp == saved(df)
    FP.check(df.repartition(5), fp, keys=KEYS, seed=5, test_fraction=0.2)
    FP.check(P.holdout(df, KEYS, seed=5), fp, whole=False)
    with pytest.raises(FP.SplitMismatch, match="were trained on") as e:
        FP.check(df, fp, seed=6)
    assert "neither" in str(e.value) and "not the one" not in str(e.value)
    with pytest.raises(FP.SplitMismatch, match="neither"):
        FP.check(df, fp, test_fraction=0.1)
    with pytest.raises(FP.SplitMismatch, match="were trained on"):
        FP.check(df, fp, test_fraction=0.3)
    with pytest.raises(FP.SplitMismatch, match="were trained on"):
        FP.check(df, fp, keys=("day",), seed=5)
    with pytest.raises(FP.SplitMismatch, match="were trained on"):
        FP.check(df, fp, whole=False)


def test_changed_files_are_found(spark):
    df = table(spark)
    fp = saved(df)
    one = df.filter(fp.in_training()).limit(1)
    for changed in (df.union(one), df.exceptAll(one), df.withColumn("x", F.col("x") + F.when(F.col("day") == one.first()["day"], 1).otherwise(0)),
                    df.filter("day < 0")):
        with pytest.raises(FP.SplitMismatch, match="not the one"):
            FP.check(changed, fp)
    # new hold-out rows are unseen, and no training row changed
    more = table(spark, 9000, 2).filter("day > 20202500")
    FP.check(df.union(more.filter(~fp.in_training())), fp)


def test_totals_beyond_64_bits(spark):
    big = spark.createDataFrame([(k, 2 ** 62) for k in range(8)], "_g int, lane0 long")
    assert big.agg(F.sum(F.col("lane0").cast("decimal(28,0)")).alias("s")).first()["s"] == 8 * 2 ** 62


def test_empty_input(spark):
    df = table(spark).limit(0)
    fp = saved(df)
    assert fp.rows == 0 and fp.lanes == (0, 0, 0, 0)
    FP.check(df, fp)
    with pytest.raises(FP.SplitMismatch):
        FP.check(table(spark), fp)


def test_plan_has_no_python_and_combines_before_the_shuffle(spark):
    df = table(spark)
    plan = FP.compare(df, saved(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_sum" in plan
