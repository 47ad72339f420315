"""Operator 9: suffix arrays against sorting, removal against all windows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from errlens.llm import suffix_dedup as D
from errlens.llm.suffix_array import suffix_array
from tests.llm.conftest import CASES, documents, prose


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=400, deadline=None)
def test_suffix_array(values):
    text = [*values, 0]
    assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, length=200):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((repr(i), len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out)


def run(spark, rows, **kw):
    got = D.remove_repeats(documents(spark, rows), **kw).collect()
    return sorted((repr(r["id"]), r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got)


def shared_passages():
    r = random.Random(4)
    passage = [prose(50 + k, 60) for k in range(4)]
    rows = []
    for k in range(60):
        parts = [prose(1000 + k, r.randint(5, 60)), r.choice(passage)[r.randint(0, 40):], prose(2000 + k, 30),
                 r.choice(passage)[:r.randint(150, 300)], prose(3000 + k, r.randint(0, 20))]
        rows.append((k, " ".join(parts)))
    edited = prose(77, 500).split()
    for k in range(12):
        copy = list(edited)
        copy[r.randrange(500)] = "EDIT"
        copy[r.randrange(500)] = "EDIT2"
        rows.append((100 + k, " ".join(copy)))
    base = prose(88, 80)
    rows += [(200, base[:198] + "!"), (201, "?" + base[:198]), (202, base[100:299]), (203, base[99:300])]     # around the limit
    rows += [(300, "ab" * 400), (301, "q" * 201), (302, "w" * 200), (303, ("line of text\n" * 40) + prose(5, 10)), (304, "é" * 150 + prose(6, 50) + "é" * 150)]
    return rows


@pytest.mark.parametrize("crowd", [1, 3, D.CROWD])
def test_removal_matches_all_windows(spark, crowd):
    rows = shared_passages()
    assert run(spark, rows, crowd=crowd) == brute(rows)


def test_full_bitmaps_and_small_suffix_arrays(spark, monkeypatch):
    monkeypatch.setattr(D, "SYMBOLS", 50)
    rows = shared_passages()[::2]
    assert run(spark, rows, words=1) == brute(rows)


def test_long_texts_are_scanned_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(D, "STRETCH", 700)
    rows = [(1, prose(1, 900)), (2, prose(2, 300) + prose(1, 900)[500:3000]), (3, "z" * 2500), (4, prose(3, 40))]
    assert run(spark, rows) == brute(rows)


def test_passages_late_in_long_texts():
    r = np.random.default_rng(9)
    passage = prose(60, 90)[:300].encode()
    noise = [r.integers(97, 123, n, np.uint8).tobytes() for n in (4_500_000, 300_000, 3_400_000, 1_200_000)]
    texts = [noise[0] + passage + noise[1], noise[2], noise[3] + passage]       # the last lies after long texts of its slice
    s = D.Scan(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.binary())}))
    assert sorted(set(s.row)) == [0, 1, 2]
    hashes = [D.gram_hashes(np.frombuffer(t, np.uint8), D.GRAM) for t in texts]
    place = s.anchor - s.first + s.start
    assert all(hashes[k][p] == h for k, p, h in zip(s.row.tolist(), place.tolist(), s.hash))
    assert ((s.first <= s.anchor) & (s.anchor + D.GRAM <= s.end)).all()
    inside = [s.hash[(s.row == k) & (s.start < at + 101) & (s.start + s.count > at)] for k, at in ((0, 4_500_000), (2, 1_200_000))]
    assert len(inside[0]) and set(inside[0]) == set(inside[1])


def test_late_repeats_go(spark):
    r = np.random.default_rng(8)
    passage = "<" + prose(61, 90)[:300] + ">"
    noise = [r.integers(97, 123, n, np.uint8).tobytes().decode() for n in (4_500_000, 900)]
    got = {r["id"]: r for r in D.remove_repeats(documents(spark, [(1, noise[0] + passage), (2, passage + noise[1])])).collect()}
    assert [bytes(got[k]["kept"]).decode() for k in (1, 2)] == noise


def test_one_row_of_a_segment_reaches_its_task(spark, monkeypatch):
    edge = [prose(70 + k, 60) for k in range(3)]
    rows = [(k, prose(4000 + k, 20) + " " + prose(64, 90)[:400] + " " + edge[k % 3]) for k in range(90)]
    rows += [(900 + k, prose(64, 90)[20:380] + f" {k}") for k in range(3)]
    seen, compare = [], D.compare_segments

    def spy(segs, key):
        seen.extend(segs.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies")).collect())
        return compare(segs, key)

    monkeypatch.setattr(D, "compare_segments", spy)
    got = D.remove_repeats(documents(spark, rows).repartition(6)).collect()
    assert sorted((repr(r["id"]), r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got) == brute(rows)
    assert {r["n"] for r in seen} == {1} and max(r["copies"] for r in seen) == 30      # of an edge


def test_cases(spark):
    assert run(spark, CASES) == brute(CASES)


def test_text_and_columns(spark):
    rows = [(1, "é" * 120 + prose(1, 60)), (2, "x" + "é" * 120 + prose(1, 60)[:30])]
    out = D.remove_repeats(documents(spark, rows), columns=("h", "spans"), as_text=True)
    assert all("�" not in r["kept"] for r in out.collect())
    assert out.columns.count("spans") == 2


def test_empty_table(spark):
    assert D.remove_repeats(documents(spark, [])).count() == 0
