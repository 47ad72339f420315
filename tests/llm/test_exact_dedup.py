"""Operator 10 against a plain grouping, and its SQL."""

import re
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from errlens.llm import exact_dedup
from errlens.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import CASES, documents, prose


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids)) for i in ids]
    return sorted(out, key=repr), len(groups)


def test_cases_with_tiny_bitmaps(spark):
    rows = CASES + [(20 + k, prose(5, 50)) for k in range(40)] + [(70, prose(5, 50) + "."), (71, "z" + prose(5, 50))]
    want, kept = brute(rows)
    for words in (1, 1 << 10):              # one word of bits: nearly every row comes through to the last level
        got = exact_dedup.dedup(documents(spark, rows), words=words).collect()
        assert sorted(((r["id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == want
        assert sum(r["kept"] for r in got) == kept
        assert all(r["id"] == r["keep_id"] for r in got if r["kept"])


def test_columns_stay_with_their_rows(spark):
    docs = documents(spark, CASES)
    out = exact_dedup.dedup(docs, columns=("doc_id", "text", "h"))
    assert {"doc_id", "text", "h"} <= set(out.columns)
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in out.collect()))) == sorted(map(repr, CASES))


def test_empty_table(spark):
    assert exact_dedup.dedup(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, sf_small):
    df = QUERIES["op10_exact_dedup"](spark, sf_small)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op10_exact_dedup"](spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op10_exact_dedup']})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))
    assert df.agg(F.sum(F.col("kept").cast("int"))).first()[0] < df.count()
