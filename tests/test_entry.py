"""Driver contract: entry, queries and oracle SQL agree at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as se

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) or type(v).__name__.startswith(("float", "int")):
        v = float(v)
        if math.isnan(v):
            return None
        return round(v, 9)
    return v


def _bag(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["month", "accuracy", "total_samples"]


def test_every_query_of_the_library_has_an_oracle():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    own = {name for name in q if name not in se.LLM_QUERIES}
    assert own <= set(o)


@pytest.mark.parametrize("name", sorted(set(se.oracle_sql()) - set(se.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, sf_small, name):
    got = se.queries()[name](spark, sf_small).toPandas()
    want = duck.execute(se.oracle_sql()[name]).df()
    assert _bag(got) == _bag(want)
