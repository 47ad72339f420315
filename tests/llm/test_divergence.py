"""Operator 13 against a loop over terms and groups, and its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from errlens.llm import divergence as D
from errlens.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import WORDS

SCHEMA = "doc_id long, text string, lang string, source string, id string, n long, g int, term string, Lang string, x0 int"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def frame(spark, rows):
    return spark.createDataFrame([(k, t, la, s, "x", 1, 2, "y", "z", 3) for k, (t, la, s) in enumerate(rows)], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, min_docs=30, smooth=5, top=50):
    docs, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = TERM.findall(lowered(text))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        n[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})

        def share(c):
            total = sum(c[t] for t in kept) + smooth * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + smooth) // total for t in kept}

        p, q = {s: share(n[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [("pair", o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, p[s][t] - q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part in (pairs, terms):
                part.sort(key=lambda x: (-x[2], x[1].encode()))
                out += [(lang, s, *x, k) for k, x in enumerate(part[:top] if part is terms else part, 1)]
    return sorted(out)


def corpus(seed=1):
    r = random.Random(seed)
    rows = []
    for k in range(400):
        lang = r.choice(["en", "en", "de", None, ""])
        source = "hot" if r.random() < 0.4 else r.choice(["a", "B", "ä", None, ""])
        own = WORDS if lang else WORDS[:12]
        words = [r.choice(own) + r.choice(["", "", "x", "Ünd", "İ"]) for _ in range(r.choice([0, 1, 5, 60]))]
        rows.append((r.choice([" ", "-", "  ", "3"]).join(w.upper() if r.random() < 0.2 else w for w in words) or None, lang, source))
    rows += [("rare words of this language only", "xx", s) for s in ("a", "b", "c")] + [(None, "en", "silent")]
    return rows + rows[:40]


def result(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_equals_a_loop(spark, monkeypatch):
    rows = corpus()
    want = brute(rows)
    assert {x[2] for x in want} == {"pair", "term"} and any(x[4] == 0 for x in want)
    assert result(D.audit(frame(spark, rows))) == want
    monkeypatch.setattr(D, "COLUMNS", 16)                     # small products; a pure function of the module on the driver
    cells, groups = np.array([[3, 0, 7], [0, 0, 1], [3, 2, 7], [900, 5, 0]] * 30), np.array([40_000, 300, 500])
    p = np.stack([D.shares(cells[:, g] + 5, np.full(len(cells), groups[g])) for g in range(3)], axis=1)
    direct = np.abs(p[:, :, None] - p[:, None, :]).sum(axis=0)
    assert np.array_equal(np.triu(D.priced(cells, groups, 5), 1), np.triu(direct, 1))


def test_parameters_and_small_blocks(spark):
    rows = corpus(2)
    got = D.audit(frame(spark, rows), min_docs=3, smooth=2, top=7, cells_per_block=40)
    assert result(got) == brute(rows, 3, 2, 7)


def test_counters_are_sent_on(spark):
    rows = corpus(3)
    once, often = (D.term_counts(frame(spark, rows).coalesce(1), entries=e) for e in (10 ** 6, 50))
    assert often.count() > 2 * once.count()
    want = sorted(map(tuple, D.kept_cells(once, 3).collect()))
    assert sorted(map(tuple, D.kept_cells(often, 3).collect())) == want
    assert once.agg({"n": "sum"}).first()[0] == sum(len(TERM.findall(lowered(t))) for t, _, _ in rows)


def test_joint_tables_count_every_term(spark):
    rows = corpus(4)
    df = frame(spark, rows)
    cells = D.kept_cells(D.term_counts(df), 30)
    sizes = D.group_sizes(df, cells)
    joint = D.joint_tables(cells, sizes, cells_per_block=60).collect()
    by = {(r["lang"], r["source"], r["term"]): r["n"] for r in cells.collect()}
    kept = defaultdict(set)
    for lang, _, term in by:
        kept[lang].add(term)
    groups = defaultdict(list)
    for r in sizes.orderBy("lang", "g").collect():
        groups[r["lang"]].append(r["source"])
    want = Counter()
    for lang, names in groups.items():
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                for t in kept[lang]:
                    want[lang, a, by.get((lang, a, t), 0), b, by.get((lang, b, t), 0)] += 1
    assert {tuple(r)[:5]: r["terms"] for r in joint} == dict(want)


def test_shares_are_exact():
    r = random.Random(5)
    count = [r.randint(0, 10 ** r.randint(1, 15)) for _ in range(500)]
    whole = [c + r.randint(1, 10 ** r.randint(1, 15)) for c in count]
    got = D.shares(np.array(count), np.array(whole))
    assert got.tolist() == [1 + 10 ** 9 * c // w for c, w in zip(count, whole)]
    assert D.shares(np.array([7]), np.array([7])).tolist() == [10 ** 9 + 1]


@pytest.mark.parametrize("columns", [4, 1024])
def test_products_of_any_width(monkeypatch, columns):
    monkeypatch.setattr(D, "COLUMNS", columns)
    r = np.random.default_rng(6)
    cells = r.poisson(np.geomspace(0.1, 500, 300))[:, None] * r.integers(0, 4, (300, 9))
    whole = cells.sum(axis=0) + 5 * len(cells)
    p = np.stack([D.shares(cells[:, g] + 5, np.full(len(cells), whole[g])) for g in range(9)], axis=1)
    direct = np.abs(p[:, :, None] - p[:, None, :]).sum(axis=0)
    assert np.array_equal(np.triu(D.priced(cells, whole, 5), 1), np.triu(direct, 1))


def test_empty_table_and_no_terms(spark):
    assert D.audit(frame(spark, [])).collect() == []
    rows = [("a b", "en", "s"), (None, "en", "t"), ("", None, None)]
    assert result(D.audit(frame(spark, rows))) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_query_matches_sql(spark):
    at = "/root/testdata/sf0.01"
    df = QUERIES["op13_divergence"](spark, at)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{at}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op13_divergence']})").fetchall()
    got = list(map(tuple, df.collect()))
    assert sorted(got) == sorted(want) and {x[2] for x in got} == {"pair", "term"}
