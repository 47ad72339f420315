"""Property checks with generated inputs (few examples: each one runs Spark jobs)."""

import hashlib

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from errlens.functions import columns as C
from errlens.operators import evaluate as E
from errlens.operators import prep as P

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

floats = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(xs=st.lists(floats, min_size=1, max_size=60), bins=st.integers(min_value=1, max_value=40))
def test_histogram_is_numpy_histogram(spark, xs, bins):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = E.histogram(df, "x", bins=bins).orderBy("bin").collect()
    counts, edges = np.histogram(np.asarray(xs, dtype=float), bins=bins)
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_lo for r in got] == edges[:-1].tolist()


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(-10**12, 10**12), st.text(max_size=8)), min_size=1, max_size=30),
       seed=st.integers(0, 10**6))
def test_stable_bucket_is_md5_rule(spark, rows, seed):
    df = spark.createDataFrame(rows, "a long, b string")
    got = [r[0] for r in df.select(C.stable_bucket(["a", "b"], seed)).collect()]
    want = [int(hashlib.md5(f"{a}:{b}:{seed}".encode()).hexdigest()[:8], 16) % 10000 for a, b in rows]
    assert got == want


@SETTINGS
@given(weights=st.lists(st.floats(min_value=0.01, max_value=5), min_size=1, max_size=5))
def test_split_parts_disjoint_and_covering(spark, weights):
    df = spark.range(300).selectExpr("id", "id * 7 % 13 AS g")
    parts = P.hash_split(df, ["id", "g"], weights, seed=5)
    ids = [sorted(r.id for r in p.collect()) for p in parts]
    flat = sorted(i for part in ids for i in part)
    assert flat == list(range(300))


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3))),
                      min_size=1, max_size=40))
def test_confusion_matrix_dense_and_consistent(spark, pairs):
    df = spark.createDataFrame([(l, None if p is None else float(p)) for l, p in pairs],
                               "label int, prediction double")
    cm = {(r.actual, r.predicted): r.n for r in E.confusion_matrix(df).collect()}
    classes = sorted({float(l) for l, _ in pairs} | {float(p) for _, p in pairs if p is not None})
    assert set(cm) == {(a, b) for a in classes for b in classes}
    scored = [(l, p) for l, p in pairs if p is not None]
    assert sum(cm.values()) == len(scored)
    for a, b in cm:
        assert cm[(a, b)] == sum(1 for l, p in scored if float(l) == a and float(p) == b)
