import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from errlens.operators import evaluate as E
from errlens.plans import fixtures as fx


def _scored(spark):
    rows = [("u1", 202001, "A", 0, 0.0), ("u1", 202001, "A", 1, 0.0), ("u2", 202002, "B", 1, 1.0),
            ("u2", 202002, "B", 1, None), ("u3", 202002, "A", 0, 0.0), ("u3", 202001, "B", 1, 1.0)]
    return spark.createDataFrame(rows, "uid string, month int, race string, label int, prediction double")


def test_accuracy_null_prediction_ignored_but_counted(spark):
    r = E.accuracy_by(_scored(spark), "uid", order="keys").collect()
    got = {x.uid: (x.accuracy, x.samples) for x in r}
    assert got == {"u1": (0.5, 2), "u2": (1.0, 2), "u3": (1.0, 2)}


def test_bottom_k_ties_by_key(spark):
    r = E.bottom_k(_scored(spark), "uid", k=2).collect()
    assert [x.uid for x in r] == ["u1", "u2"]
    assert [x.uid for x in E.bottom_k(_scored(spark), "uid", k=3, min_samples=3).collect()] == []


def test_grouping_sets_consistent(spark):
    df = _scored(spark)
    gs = {(r.dim, r.value): (r.accuracy, r.samples)
          for r in E.accuracy_grouping_sets(df, ["month", "uid", "race"]).collect()}
    for dim in ["month", "uid", "race"]:
        single = E.accuracy_by(df, dim, order=None).collect()
        for r in single:
            assert gs[(dim, str(r[dim]))] == (r.accuracy, r.samples)
    overall = E.accuracy_overall(df).first()
    assert gs[("all", None)] == (overall.accuracy, overall.samples)


def test_count_weighted_group_accuracy_equals_overall(spark, sf_small):
    s = fx.scored(spark, sf_small).withColumn("month", F.substring(F.col("day").cast("string"), 1, 6))
    overall = E.accuracy_overall(s).first().accuracy
    for key in ["month", "uid", "race"]:
        rows = E.accuracy_by(s, key, order=None).collect()
        weighted = sum(r.accuracy * r.samples for r in rows) / sum(r.samples for r in rows)
        assert math.isclose(weighted, overall, rel_tol=1e-12)


def test_evaluator_matches_avg(spark, sf_small):
    s = fx.scored(spark, sf_small)
    assert math.isclose(E.evaluator_accuracy(s), E.accuracy_overall(s).first().accuracy, rel_tol=1e-12)


def test_confusion_matrix_dense_with_zero_cell(spark, sf_small):
    s = fx.scored(spark, sf_small)
    cm = {(r.actual, r.predicted): r.n for r in E.confusion_matrix(s).collect()}
    assert set(cm) == {(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)}
    assert cm[(0.0, 1.0)] == 0   # the rule never predicts 1 for a label-0 row
    total = s.count()
    assert sum(cm.values()) == total
    acc = E.accuracy_overall(s).first().accuracy
    assert math.isclose((cm[(0.0, 0.0)] + cm[(1.0, 1.0)]) / total, acc, rel_tol=1e-12)
    piv = {r.actual: (r.pred_0, r.pred_1) for r in E.confusion_pivot(s).collect()}
    assert piv[0.0] == (cm[(0.0, 0.0)], cm[(0.0, 1.0)]) and piv[1.0] == (cm[(1.0, 0.0)], cm[(1.0, 1.0)])


def test_confusion_matrix_unseen_class_pairs(spark):
    df = spark.createDataFrame([(0, 0.0), (2, 1.0)], "label int, prediction double")
    cm = {(r.actual, r.predicted): r.n for r in E.confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[(2.0, 1.0)] == 1 and cm[(1.0, 1.0)] == 0


def test_confusion_matrix_takes_any_number_of_classes(spark):
    df = spark.range(3000).select((F.col("id") % 1500).alias("label"), (F.col("id") * 7 % 1500).alias("prediction"))
    cm = E.confusion_matrix(df)
    assert cm.count() == 1500 * 1500 and cm.agg(F.sum("n")).first()[0] == 3000


def test_confusion_matrix_of_null_groups(spark):
    df = spark.createDataFrame([(None, 0, 0.0), (None, 1, 0.0), ("a", 1, 1.0), ("a", 0, None)], "g string, label int, prediction double")
    cm = {(r.g, r.actual, r.predicted): r.n for r in E.confusion_matrix(df, by="g").collect()}
    assert len(cm) == 8 and cm[(None, 1.0, 0.0)] == 1 and cm[("a", 0.0, 0.0)] == 0 and sum(cm.values()) == 3


def test_confusion_pivot_counts_every_row(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 2.0), (2, 1.0), (None, 0.0), (1, None)], "label int, prediction double")
    piv = {r.actual: (r.pred_0, r.pred_1, r.pred_other) for r in E.confusion_pivot(df).collect()}
    assert piv == {0.0: (1, 0, 0), 1.0: (0, 0, 2), None: (1, 1, 0)}


def test_reduced_predictions_give_the_same_tables(spark, sf_small):
    s = fx.scored_two(spark, sf_small).withColumn("prediction", F.when(F.col("race") != "R", F.col("prediction")))
    reduced = E.reduce_predictions(s, ["uid", "race"], by="model")

    def bag(df):
        return sorted(map(tuple, df.collect()), key=repr)
    assert bag(E.grouping_sets_of(reduced, ["uid", "race"], by="model")) == bag(E.accuracy_grouping_sets(s, ["uid", "race"], by="model"))
    assert bag(E.confusion_of(reduced, by="model")) == bag(E.confusion_matrix(s, by="model"))


@pytest.mark.parametrize("seed", [0, 1])
def test_histogram_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    xs = np.concatenate([rng.random(500), [0.0, 1.0, 0.5, 1 / 3]])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = E.histogram(df, "x", bins=30).orderBy("bin").collect()
    counts, edges = np.histogram(xs, bins=30)
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_lo for r in got] == edges[:-1].tolist()
    assert [r.bin_hi for r in got] == edges[1:].tolist()


def test_histogram_single_value_and_groups(spark):
    df = spark.createDataFrame([("a", 0.7)] * 5 + [("b", 0.1), ("b", 0.3)], "g string, x double")
    got = {(r.g, r.bin): r.n for r in E.histogram(df, "x", bins=10, by="g").collect()}
    counts, _ = np.histogram([0.7] * 5, bins=10)
    assert [got[("a", i)] for i in range(10)] == counts.tolist()
    counts_b, _ = np.histogram([0.1, 0.3], bins=10)
    assert [got[("b", i)] for i in range(10)] == counts_b.tolist()


def _kde_numpy(xs, grid_size, cut=3.0):
    xs = np.asarray(xs, dtype=float)
    h = xs.std(ddof=1) * len(xs) ** (-0.2)
    grid = np.linspace(xs.min() - cut * h, xs.max() + cut * h, grid_size)
    dens = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / h) ** 2).sum(axis=1) / (len(xs) * h * math.sqrt(2 * math.pi))
    return grid, dens


@pytest.mark.parametrize("digits", [2, None])
def test_kde_brute_force_and_integral(spark, digits):
    rng = np.random.default_rng(3)
    xs = rng.beta(2, 5, 400)
    if digits:
        xs = np.round(xs, digits)   # repeated values exercise the weighting
    df = spark.createDataFrame([("m", float(x)) for x in xs], "model string, p double")
    got = E.kde(df, "p", by="model", grid_size=50).orderBy("point").collect()
    grid, dens = _kde_numpy(xs, 50)
    assert np.allclose([r.x for r in got], grid, rtol=0, atol=1e-12)
    assert np.allclose([r.density for r in got], dens, rtol=1e-9, atol=1e-12)
    assert abs(np.trapezoid(dens, grid) - 1.0) < 0.01


def test_kde_zero_spread_gives_no_rows(spark):
    df = spark.createDataFrame([("a", 0.5)] * 4 + [("b", 0.1), ("b", 0.2)], "model string, p double")
    got = E.kde(df, "p", by="model", grid_size=5).collect()
    assert {r.model for r in got} == {"b"} and len(got) == 5
    assert E.kde(df.filter("model = 'a'"), "p", grid_size=5).count() == 0


def test_histogram_counts_sum_to_rows(spark, sf_small):
    s = fx.scored_vector(spark, sf_small)
    from errlens.functions import confidence
    h = E.histogram(s.select(confidence("probability").alias("c")), "c", bins=30)
    assert h.agg(F.sum("n")).first()[0] == s.count()


def test_row_counts(spark, sf_small):
    r = E.row_counts(fx.obs(spark, sf_small)).first()
    assert r.total_rows == r.test_rows + r.train_rows


def test_kde_and_histogram_empty_input(spark):
    df = spark.createDataFrame([], "model string, p double")
    assert E.kde(df, "p", by="model", grid_size=5).count() == 0
    assert E.histogram(df, "p", bins=5).count() == 0
    assert E.histogram(df, "p", bins=5, by="model").count() == 0


def test_kde_with_many_groups(spark, sf_small):
    s = fx.scored(spark, sf_small).select("uid", "p1")
    got = E.kde(s, "p1", by="uid", grid_size=11).collect()
    by_user = {}
    for r in s.collect():
        by_user.setdefault(r.uid, []).append(r.p1)
    assert len({r.uid for r in got}) > 0.9 * len(by_user)
    uid = got[0].uid
    grid, dens = _kde_numpy(by_user[uid], 11)
    mine = sorted((r.point, r.x, r.density) for r in got if r.uid == uid)
    assert np.allclose([m[1] for m in mine], grid) and np.allclose([m[2] for m in mine], dens)


def test_null_group_keys_are_groups(spark):
    df = spark.createDataFrame([(None, float(k) / 7) for k in range(10)] + [("a", float(k)) for k in range(5)], "g string, x double")
    h = E.histogram(df, "x", bins=4, by="g")
    assert {r.g: r.n for r in h.groupBy("g").agg(F.sum("n").alias("n")).collect()} == {None: 10, "a": 5}
    curves = E.kde(df, "x", by="g", grid_size=7).filter("g IS NULL").orderBy("point").collect()
    grid, dens = _kde_numpy([k / 7 for k in range(10)], 7)
    assert np.allclose([r.x for r in curves], grid) and np.allclose([r.density for r in curves], dens)


def test_overlay_scales_to_counts(spark):
    xs = np.random.default_rng(1).random(300)
    got = E.kde(spark.createDataFrame([(float(x),) for x in xs], "x double"), "x", grid_size=40, cut=0.0, counts_bins=30).orderBy("point").collect()
    grid, dens = _kde_numpy(xs, 40, cut=0.0)
    assert np.allclose([r.x for r in got], grid)
    assert np.allclose([r.density for r in got], dens * len(xs) * (xs.max() - xs.min()) / 30)


@pytest.mark.parametrize("make", [lambda d: E.histogram(d, "x", by="g"), lambda d: E.kde(d, "x", by="g", grid_size=5)])
def test_no_unreduced_rows_are_shuffled_by_the_group(spark, make):
    """Every exchange by the group key alone is above an aggregate that reduced the rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") % 50).cast("double").alias("x"))
        plan = make(df)._jdf.queryExecution().sparkPlan().toString()
        full = make(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = full.splitlines()
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert any("HashAggregate" in x or "Aggregate" in x for x in lines[k + 1:k + 8]), line


def _wide(spark, n=4000):
    """Nearly all distinct values in groups of very different spread, one group null, far outliers."""
    x = F.rand(7) * F.when(F.col("id") % 3 == 0, 1e6).when(F.col("id") % 3 == 1, 1e-4).otherwise(1.0)
    return spark.range(n).select(F.when(F.col("id") % 3 < 2, (F.col("id") % 3).cast("string")).alias("g"),
                                 F.when(F.col("id") == 5, 1e9).when(F.col("id") == 7, float("nan")).otherwise(x).alias("v")).cache()


@pytest.mark.parametrize("tolerance", [1e-2, 1e-5, 1e-9, 1e-13])
@pytest.mark.parametrize("by", [None, "g"])
def test_kde_keeps_its_tolerance(spark, tolerance, by):
    df = _wide(spark)
    exact = {(r["g"] if by else 0, r["point"]): r for r in E.kde(df, "v", by=by, grid_size=37).collect()}
    loose = {(r["g"] if by else 0, r["point"]): r for r in E.kde(df, "v", by=by, grid_size=37, tolerance=tolerance).collect()}
    assert exact.keys() == loose.keys() and len(exact) == (111 if by else 37)
    rows = df.filter("v IS NOT NULL AND NOT isnan(v)").groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd")).collect()
    height = {(r["g"] if by else 0): 1 / (r["sd"] * r["n"] ** -0.2 * math.sqrt(2 * math.pi)) for r in rows}
    errors = [abs(loose[k]["density"] - exact[k]["density"]) / height[k[0]] for k in exact]
    assert max(errors) <= tolerance + 1e-14
    if tolerance > 1e-3:
        assert max(errors) > 0
    assert all(loose[k]["x"] == exact[k]["x"] for k in exact)


def test_kde_order_follows_the_tolerance():
    orders = [E.hermite_order(t) for t in (0.5, 1e-2, 1e-4, 1e-8, 1e-14)]
    assert orders == sorted(orders) and orders[-1] < 25
    for bad in (0, 1e-15, 1.0):
        with pytest.raises(ValueError):
            E.hermite_order(bad)
    # He_4 = x^4 - 6 x^2 + 3
    assert E._hermite(5)[4] == [3.0, 0.0, -6.0, 0.0, 1.0]


def _below_first_aggregate(plan):
    """Columns of the exchanges of a plan."""
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("make", [lambda d: E.histogram(d, "v", 10, by="g"), lambda d: E.kde(d, "v", by="g", grid_size=9, tolerance=1e-4),
                                  lambda d: E.histogram(d, "v", 10), lambda d: E.kde(d, "v", grid_size=9, tolerance=1e-4)])
def test_no_value_is_shuffled(spark, make):
    out = make(_wide(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any("_x" in line.split("ENSURE")[0] for line in _below_first_aggregate(plan))
    assert "SortMergeJoin" not in plan or "_x" not in plan.split("SortMergeJoin")[1].split("]")[0]
    out.collect()
    moved = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_x" not in moved


def test_many_groups_take_the_reduced_way(spark, monkeypatch):
    df = _wide(spark)
    want = [sorted(map(str, f(df).collect())) for f in (lambda d: E.histogram(d, "v", 10, by="g"),
                                                        lambda d: E.kde(d, "v", by="g", grid_size=9, tolerance=1e-9, decimals=9))]
    monkeypatch.setattr(E, "FEW_GROUPS", 1)
    got = [sorted(map(str, f(df).collect())) for f in (lambda d: E.histogram(d, "v", 10, by="g"),
                                                       lambda d: E.kde(d, "v", by="g", grid_size=9, tolerance=1e-9, decimals=9))]
    assert got == want
