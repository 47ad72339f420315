"""Operator 2: fingerprints against the definition, components against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from errlens.llm import simhash as S
from tests.llm.conftest import CASES, documents, prose


def fingerprint(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, distance=3):
    """Root (smallest index) of each fingerprint under all-pairs links."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_of_odd_texts():
    odd = ["", "  \n", "a", "A b", "A b C", "the QUICK brown\tfox  jumps\x0b\x0cover " * 5, "é ü ß Ä x\x85y z q w",
           "x" * 100 + " " + "y" * 50 + " zz " + "q" * 70, "\0 \0 a", " lead a b c d", prose(3, 500)]
    assert S.simhash([o.encode() for o in odd]).tolist() == [fingerprint(o) for o in odd]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\né\x0c日", max_size=120), min_size=1, max_size=5))
def test_fingerprints_of_random_texts(texts):
    assert S.simhash([t.encode() for t in texts]).tolist() == [fingerprint(t) for t in texts]


@given(st.integers(1, 6), st.integers(1, 4), st.integers(0, 10 ** 6))
@settings(max_examples=50, deadline=None)
def test_allocation_is_the_cheapest(parts, total, seed):
    from itertools import product
    cost = np.random.default_rng(seed).random((parts, total + 1, 3))
    units = S.allocate(cost, total)
    assert (units.sum(0) == total).all()
    for k in range(3):
        best = min(sum(cost[i, e, k] for i, e in enumerate(u)) for u in product(range(total + 1), repeat=parts) if sum(u) == total)
        assert np.isclose(sum(cost[i, units[i, k], k] for i in range(parts)), best)


def test_near_counts():
    table = np.random.default_rng(1).integers(0, 3, (1, 1 << S.TABLE_BITS))
    near = S.near_counts(table, 3)
    for v in (0, 5, 40000):
        d = np.bitwise_count(np.arange(1 << S.TABLE_BITS) ^ v)
        for t in range(4):
            assert near[0, t, v] == table[0][d <= t].sum()


@pytest.mark.parametrize("parts", [2, 3, 4])
@pytest.mark.parametrize("block", [8, 2048])
def test_no_link_is_lost(spark, monkeypatch, parts, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rng = np.random.default_rng(parts)
    fps = {0, 1, 3, 7, 15, 31}
    for base in rng.integers(0, 2 ** 63, 25).tolist():
        for _ in range(16):
            x = base
            for b in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps, key=lambda x: x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    n, both = S.bit_counts(df)
    assert n == len(fps)
    groups = S.group_bits(n, both, parts)
    assert sorted(b for g in groups for b in g) == list(range(64))
    table = S.value_counts(df, groups)
    crowded = S.crowded_values(df, groups, table)
    for group, (value, count) in zip(groups, crowded):
        all_values, n = np.unique(S.values_of(np.array(fps, np.uint64), group), return_counts=True)
        assert value.tolist() == all_values[n > block].tolist() and count.tolist() == n[n > block].tolist()
    stars = S.connect(S.links(S.candidates(df, groups, table, crowded, 3), 3)).collect()
    root = {r["node"]: r["root"] for r in stars}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    assert [root.get(x, x) for x in signed] == [signed[k] for k in components(fps)]


def test_rows_per_fingerprint_do_not_grow_with_the_corpus():
    fps = np.random.default_rng(5).integers(0, 2 ** 64, 200, dtype=np.uint64)
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    for n in (10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9, 10 ** 10):
        m = S.parts_for(n, 3)
        parts = [x.tolist() for x in np.array_split(np.arange(64), m)]
        table = np.full((m, 1 << S.TABLE_BITS), n >> S.TABLE_BITS)
        made = sum(len(fp) for _, _, fp in S.candidate_rows(parts, table, [none] * m, 3)(fps))
        assert made <= 80 * len(fps)


def test_crowded_value_beside_rare_ones(spark, monkeypatch):
    """A crowded value is split, its neighbours in the same cell are not."""
    monkeypatch.setattr(S, "BLOCK", 4)
    base = 0x0123_4567_89AB_CDEF
    fps = sorted({base ^ (k << 32) for k in range(64)} | {base ^ (1 << 20) ^ (k << 40) for k in range(3)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    parts = [list(range(32)), list(range(32, 64))]
    table = S.value_counts(df, parts)
    crowded = S.crowded_values(df, parts, table)
    assert crowded[0][0].tolist() == [base & 0xFFFFFFFF] and crowded[0][1].tolist() == [64]
    rows = S.candidates(df, parts, table, crowded, 3)
    largest = rows.filter("not probe").groupBy("bucket").count().agg({"count": "max"}).first()[0]
    assert largest <= 12                             # about BLOCK, not 64
    root = {r["node"]: r["root"] for r in S.connect(S.links(rows, 3)).collect()}
    assert [root.get(x, x) for x in fps] == [fps[k] for k in components(fps)]


def test_cases(spark):
    rows = CASES + [(30, prose(9, 400)), (31, prose(9, 400) + " one more"), (32, prose(9, 400).upper())]
    got = S.near_duplicates(documents(spark, rows)).collect()
    fps = [fingerprint(t) for _, t in rows]
    comp = components(fps)
    want = []
    for (i, _), f, c in zip(rows, fps, comp):
        known = [r[0] for r, k in zip(rows, comp) if k == c and r[0] is not None]
        want.append((i, f, min(known) if known else None))
    assert sorted(((r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert S.near_duplicates(documents(spark, [])).count() == 0
