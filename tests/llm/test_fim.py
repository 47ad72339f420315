"""Operator 12 against plain slicing, its inverse, and its SQL."""

import hashlib
import re

import duckdb
import pyarrow as pa
import pytest

from errlens.llm import fim
from errlens.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import CASES, documents, prose

MORE = [(20, "a<P>b"), (21, "<"), (22, "<S"), (23, "word<<<<word"), (24, "x" * 9000 + " " + "é" * 9000),
        (25, prose(3, 4000)), (25, prose(3, 4000)), (26, "<M"), (27, ">S>M>"), (28, "\x00\r\n ")] + [(100 + k, prose(k, k)) for k in range(150)]


def brute(key, text):
    t = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", t, re.S)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(u), "plain", None, None, t
    if h4 % 100 < 20:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_outputs_equal_plain_slices(spark):
    rows = CASES + MORE
    got = fim.transform(documents(spark, rows), columns=("text", "h", "id")).collect()
    assert len(got) == len(rows)
    names = got[0].__fields__
    assert names.count("id") == 2 and "h" in names          # the document's own column stays beside the operator's
    want = sorted(repr((k, *brute(k, t))) for k, t in rows)
    assert sorted(repr((r[0], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])) for r in got) == want
    assert all(r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest() for r in got)
    assert {r["form"] for r in got} == set(fim.FORMS)


def test_restored_texts_are_the_inputs(spark):
    rows = CASES + MORE
    rule = fim.Rule(sentinels=("\u0001pre", "\u0002suf", "\u0003mid"), plain=0, spm=50, seed="other")
    made = fim.transform(documents(spark, rows), rule)
    back = fim.restore(made, rule).collect()
    assert sorted(repr((r["id"], r["restored"])) for r in back) == sorted(repr((k, t or "")) for k, t in rows)
    assert all(r["restored_sha256"] == hashlib.sha256(r["restored"].encode()).hexdigest() for r in back)


def test_round_trip_keeps_hashes(spark):
    got = fim.round_trip(documents(spark, CASES)).collect()
    assert sorted(r["restored_sha256"] for r in got) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in CASES)


def test_empty_table(spark):
    assert fim.round_trip(documents(spark, [])).collect() == []


def test_broken_outputs_are_errors():
    rule = fim.Rule()
    for out, form in (("<P>a<M>b", "psm"), ("a<P>b<S>c<M>d", "psm"), ("<P>a<S>b<M>c", "spm")):
        with pytest.raises(ValueError):
            fim.found(fim.Texts(pa.array([out])), [form], rule)


def test_sentinels_that_texts_could_run_into_are_refused():
    for bad in (("aa", "b", "c"), ("<P>", "<P>", "<M>"), ("<P", "<PS", "<M"), ("", "b", "c"), ("<P<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.Rule(sentinels=bad)


def test_slices_of_a_batch_and_blocks():
    texts = [None, "ab cd", "", "é1é", "x" * 5000 + "1" + "y" * 5000, "z z"]
    units = fim.Units(fim.Texts(pa.array(["drop", *texts]).slice(1)))
    for d, t in enumerate(texts):
        u = re.findall("[A-Za-z]+|[^A-Za-z]", t or "", re.S)
        assert units.n[d] == len(u)
        at = [units.position(d, k) - int(units.bounds[d]) for k in range(len(u) + 1)]
        assert at == [len("".join(u[:k]).encode()) for k in range(len(u) + 1)]


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op12_fim"](spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op12_fim']})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))
