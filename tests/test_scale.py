"""Skew and plan-shape checks: the properties that matter at large scale."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from errlens.operators import evaluate as E
from errlens.operators import score as S
from errlens.operators import train as TR
from errlens.plans import fixtures as fx


@pytest.fixture(scope="module")
def skewed(spark, sf_small):
    """``scored`` where one user holds a third of all rows."""
    s = fx.scored(spark, sf_small)
    return s.withColumn("uid", F.when(F.col("day") % 3 == 0, F.lit("hot")).otherwise(F.col("uid")))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_accuracy_matches_brute_force(skewed):
    pdf = skewed.toPandas()
    share = (pdf.uid == "hot").mean()
    assert 0.25 < share < 0.45
    pdf["correct"] = (pdf.label == pdf.prediction).astype(int)
    want = pdf.groupby("uid").agg(accuracy=("correct", "mean"), samples=("correct", "size")).reset_index()
    got = E.accuracy_by(skewed, "uid", order=None).toPandas()
    m = want.merge(got, on="uid", suffixes=("_w", "_g"))
    assert len(m) == len(want) == len(got)
    assert (m.samples_w == m.samples_g).all() and ((m.accuracy_w - m.accuracy_g).abs() < 1e-12).all()
    top = E.bottom_k(skewed, "uid", 5).toPandas()
    ref = want.sort_values(["accuracy", "uid"]).head(5)
    assert top.uid.tolist() == ref.uid.tolist()


def test_grouped_accuracy_is_partially_aggregated_before_the_shuffle(skewed):
    df = E.accuracy_by(skewed, "uid", order=None)
    df.collect()
    plan = _plan(df)
    assert "partial_avg" in plan or "partial_sum" in plan
    # the partial aggregate sits below the exchange
    assert plan.index("Exchange") < plan.rindex("HashAggregate")


@pytest.mark.parametrize("q", ["confusion_matrix", "confidence_histogram", "probability_kde",
                               "accuracy_grouping_sets", "worst_users_top10", "score_two_models"])
def test_no_cartesian_or_python(spark, sf_small, q):
    from errlens.plans.queries import QUERIES
    df = QUERIES[q](spark, sf_small)
    df.collect()
    plan = _plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (q, bad)


def test_scoring_is_one_narrow_stage(spark, sf_small):
    train, test = fx.labelled(spark, sf_small), fx.labelled(spark, sf_small)
    prepared = TR.prepare(train, fx.SPEC)
    try:
        gbt = TR.fit_classifier(prepared, TR.ModelConfig(TR.GBT, depth=2, iters=2))
        rf = TR.fit_classifier(prepared, TR.ModelConfig(TR.RF, depth=2, trees=2))
        s = S.score_long(test, prepared.prep, {"a": gbt, "b": rf}, keep=["uid", "label"])
        s.count()
        assert "Exchange" not in _plan(s.select("model", "uid", "prediction"))
    finally:
        prepared.unpersist()


def test_layout_balanced_with_hot_user(spark, sf_small):
    o = fx.labelled(spark, sf_small).withColumn(
        "uid", F.when(F.col("day") % 3 == 0, F.lit("hot")).otherwise(F.col("uid")))
    laid = TR.canonical_layout(o, fx.LAYOUT_KEYS, 8)
    sizes = [r[1] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * (sum(sizes) / 8)


def test_layout_spreads_a_group_of_copies_and_stays_reproducible(spark, sf_small):
    """One exact row copied until it holds a third of the data: the copies
    are split over all partitions, no row is lost or added, and the layout
    is the same whatever the input partitioning."""
    o = fx.labelled(spark, sf_small)
    n = o.count()
    hot = o.orderBy(*fx.LAYOUT_KEYS).limit(1)
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_i")).drop("_i")
    data = o.unionByName(copies)
    layouts = []
    for inp in (data, data.repartition(5), data.repartition(3, "uid").sortWithinPartitions("f2")):
        laid = TR.canonical_layout(inp, fx.LAYOUT_KEYS, 8)
        parts = laid.rdd.glom().map(lambda rows: [tuple(r) for r in rows]).collect()
        sizes = [len(p) for p in parts]
        assert sum(sizes) == n + n // 2
        assert len(sizes) == 8 and max(sizes) < 1.3 * (sum(sizes) / 8)
        layouts.append(parts)
    assert layouts[0] == layouts[1] == layouts[2]
    # a bag-equal result: same rows, same multiplicities
    assert sorted(r for p in layouts[0] for r in p) == sorted(tuple(r) for r in data.collect())


def test_layout_counts_copies_before_the_first_shuffle(spark, sf_small):
    laid = TR.canonical_layout(fx.labelled(spark, sf_small), fx.LAYOUT_KEYS, 8)
    laid.write.format("noop").mode("overwrite").save()
    plan = laid._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(exchanges) == 2
    # the partial count sits below (after, in the text) the first exchange
    assert "partial_count" in "\n".join(lines[exchanges[-1]:])
    assert "REPARTITION_BY_NUM" in lines[exchanges[0]]


def test_bottom_k_by_equals_brute_force_with_partial_limit(spark, sf_small):
    two = fx.scored_two(spark, sf_small)
    top = E.bottom_k_by(two, "model", "uid", k=7)
    got = top.toPandas()
    assert "WindowGroupLimit" in _plan(top) and "Partial" in _plan(top)
    pdf = two.toPandas()
    pdf["correct"] = (pdf.label == pdf.prediction).astype(int)
    per = pdf.groupby(["model", "uid"]).agg(accuracy=("correct", "mean"), samples=("correct", "size")).reset_index()
    for m, g in per.groupby("model"):
        want = g.sort_values(["accuracy", "uid"]).head(7).uid.tolist()
        have = got[got.model == m].sort_values("rank").uid.tolist()
        assert have == want


@pytest.mark.parametrize("q, unread", [
    ("accuracy_by_month", {"l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag"}),
    ("worst_users_top10", {"l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"}),
    ("confusion_matrix", {"l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag",
                          "l_shipdate"}),
    ("row_counts", {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
                    "l_returnflag", "l_shipdate"}),
])
def test_scan_reads_only_needed_columns(spark, sf_small, q, unread):
    from errlens.plans.queries import QUERIES
    df = QUERIES[q](spark, sf_small)
    df.collect()
    scans = [line for line in _plan(df).splitlines() if "FileScan parquet" in line]
    assert scans
    for line in scans:
        read = {c.split("#")[0].strip() for c in line.split("FileScan parquet [", 1)[1].split("]", 1)[0].split(",")}
        assert "l_orderkey" in read and not unread & read, (q, read)
