"""Operator 8 against all pairs, and its SQL."""

import math
from unittest import mock

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from errlens.llm import topk
from errlens.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<double>, id string, v int, dim string, q int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y", 2) for i, v in rows], SCHEMA)


def brute(rows, k, is_query):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, (i, v) in enumerate(good):
        if is_query(i):
            found = [(-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(good) if b != a and len(w) == len(v)]
            found = [(-max(-2 ** 63, min(2 ** 63 - 1, -s)), j) for s, j in found]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


def run(spark, rows, k=3, step=5, **kw):
    got = topk.top_k(frame(spark, rows), F.col("id") % step == 0, k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got)


@pytest.mark.parametrize("dim", [1, 2, 7, 16, 64])
def test_random_vectors_and_ties(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(k, rng.normal(0, 1, dim).tolist()) for k in range(80)]
    rows += [(100 + k, rows[3][1]) for k in range(30)]              # one common vector: ties everywhere
    assert run(spark, rows, block=4, chunk=16) == brute(rows, 3, lambda i: i % 5 == 0)


def test_clustered_vectors_are_pruned_but_right():
    rng = np.random.default_rng(0)
    centre = rng.normal(0, 1, (10, 64)) * 200
    x = np.floor(np.repeat(centre, 200, 0) + rng.normal(0, 5, (2000, 64)))
    ids = np.arange(2000)
    at, got, score = topk.best(x[:20], ids[:20], x, ids, 5)
    dots = x[:20] @ x.T
    for j in range(20):
        order = sorted((i for i in range(2000) if i != j), key=lambda i: (-dots[j, i], i))[:5]
        assert [g for a, g in zip(at, got) if a == j] == order
        assert [s for a, s in zip(at, score) if a == j] == [int(dots[j, i]) for i in order]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, x = rng.normal(0, 50, (5, 30)), rng.normal(3, 50, (40, 30))
    exact, last = q @ x.T, None
    for s in topk.segments(30):
        bound = topk.statistics(q, s) @ topk.statistics(x, s).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or (bound <= last + 1e-6).all()         # finer is never looser
        last = bound


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, [0.5, -0.001]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (6, [1.0, 2.0, 3.0]),
            (10, []), (11, []), (None, [1.0, 1.0]), (7, [-0.5, 0.5]), (7, [-0.5, 0.5]), (8, [1e300, -1e300]), (9, [3e7, 3e7]), (15, [1e12, 0.0])]
    assert run(spark, rows, k=10) == brute(rows, 10, lambda i: i % 5 == 0)


def test_empty_table_and_no_query(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op8_topk"](spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_small}/embeddings.parquet')")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op8_topk']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_repeated_rows_are_candidates_and_agree_with_sql(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(k % 120, rng.normal(0, 1, 4).tolist()) for k in range(200)]
    rows += [(50, rows[0][1])] * 3 + [(7, rows[7][1])] * 40 + [(50, rows[50][1]), (100, rows[50][1])]
    want = brute(rows, 5, lambda i: i % 50 == 0)
    got = topk.top_k(frame(spark, rows), F.col("id") % 50 == 0, 5, block=3, chunk=16).collect()
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got) == want
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE['op8_topk']})").fetchall()) == want


def test_rows_of_one_id_are_spread(spark):
    rows = [(1, [float(k), 1.0]) for k in range(400)]
    assert run(spark, rows + [(5, [1.0, 1.0])], block=4, chunk=32) == brute(rows + [(5, [1.0, 1.0])], 3, lambda i: i % 5 == 0)


def _boxes(parts):
    rows = []
    for n, x in enumerate(parts):
        s = topk._box_statistics(x)
        pad = np.full(2 * topk.FINEST - s.shape[1], np.nan)
        rows.append({"first": n, "last": n, "seq": 0, "low_dim": x.shape[1], "high_dim": x.shape[1], "peak": np.abs(x).max(),
                     "lo": np.r_[s.min(0), pad], "hi": np.r_[s.max(0), pad]})
    return topk.Boxes(rows)


@pytest.mark.parametrize("dim", [1, 2, 9, 30, 64])
def test_boxes_never_hide_a_score(dim):
    rng = np.random.default_rng(dim)
    parts = [np.floor(rng.normal(m, 40, (30, dim))) for m in (-50, 0, 3, 80)]
    q = np.floor(rng.normal(0, 60, (20, dim)))
    top = np.stack([(q @ x.T).max(1) for x in parts], axis=1)
    for floor in (top.min(1), top.max(1)):
        assert _boxes(parts).reach(q, floor)[top >= floor[:, None]].all()
    assert not _boxes(parts).reach(np.ones((2, dim + 1)), np.full(2, -np.inf)).any()      # another length


def test_far_chunks_are_not_visited():
    rng = np.random.default_rng(5)
    centre = np.repeat(rng.choice([-100, 100], (50, 16)), 4, axis=1)
    parts = [np.floor(c + rng.normal(0, 2, (40, 64))) for c in centre]
    q = np.stack([x[0] for x in parts])
    floor = np.array([np.sort(x @ x[0])[-6] for x in parts])
    assert _boxes(parts).reach(q, floor).sum() <= 2 * len(q)


def test_more_chunks_than_boxes_and_mixed_lengths(spark):
    rng = np.random.default_rng(7)
    rows = [(k, rng.normal(0, 1, [64, 64, 3, 0, 33][k % 5]).tolist()) for k in range(150)]
    rows += [(200 + k, rows[0][1]) for k in range(60)]
    want = brute(rows, 3, lambda i: i % 7 == 0)
    assert run(spark, rows, step=7, chunk=20, boxes=2) == want
    assert run(spark, rows, step=7) == want


def test_chunks_of_a_partition_are_bounded():
    x = [[float(k)] * 3 for k in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array([3] * 50, pa.int32()),
                                        pa.array(range(50), pa.int64()), pa.array([False] * 50)], names=["id", "v", "dim", "place", "q"])
    with mock.patch.object(topk.TaskContext, "get", lambda: mock.Mock(partitionId=lambda: 4)):
        for cuts in ([50], [7, 7, 36], [1] * 50):
            starts = np.r_[0, np.cumsum(cuts)]
            out = pa.Table.from_batches(list(topk._cut(2, 40)(batch.slice(s, n) for s, n in zip(starts.tolist(), cuts)))).to_pandas()
            assert out["id"].tolist() == list(range(50)) and set(out["pid"]) == {4}
            assert out.groupby("seq").size().tolist() == [10] * 5                          # a row counts four
            assert out["peak"].notna().sum() == 5
