"""The corpus pipeline, stage by stage, against brute force on each stage's input."""

import re

import numpy as np
import pytest

import corpus_pipeline
from errlens.llm.common import stored
from tests.llm.conftest import prose
from tests.llm.test_simhash import components, fingerprint
from tests.llm.test_suffix_dedup import brute as cut_by_windows


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_small), f"test-{name}"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_are_kept(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, stages, sf_small):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    before, after = rows(stages[0]), rows(stages[1])
    assert after.keys() <= before.keys() and all(after[i] == before[i] for i in after)
    clean = [i for i in before if labels.get(i) == 0]
    assert np.mean([i in after for i in clean]) > 0.97


def test_exact_copies(stages):
    before, after = rows(stages[1]), rows(stages[2])
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]["text"] or ""), i)
    assert set(after) == set(first.values()) and all(after[i] == before[i] for i in after)


def test_near_copies(stages):
    before, after = rows(stages[2]), rows(stages[3])
    ids = sorted(before)
    comp = components([fingerprint(before[i]["text"]) for i in ids])
    assert set(after) == {ids[c] for c in comp}


def test_repeats(stages):
    before, after = rows(stages[3]), rows(stages[4])
    want = {eval(w[0]): w[4].decode("utf-8", "ignore") for w in cut_by_windows([(i, r["text"]) for i, r in before.items()])}
    assert {i: r["text"] for i, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_packing(stages):
    placed = stages[5].collect()
    assert {r["doc_id"] for r in placed} == set(rows(stages[4]))
    fill = {}
    for r in placed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 1024


def test_null_and_repeated_ids(spark, sf_small):
    """Each stage decides per row, not per doc_id."""
    schema = spark.read.parquet(f"{sf_small}/documents.parquet").schema

    def table(rows):
        own = {"text": 1, "doc_id": 0}
        return spark.createDataFrame([tuple(r[own[f.name]] if f.name in own else len(r[1] or "") if f.name == "n_chars" else None for f in schema) for r in rows],
                                     type(schema)([type(f)(f.name, f.dataType, True) for f in schema]))

    def after(name, rows):
        return sorted(((r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)[name](spark, table(rows), sf_small).collect()), key=repr)

    a, b, c, d, e = (prose(600 + k, 400) for k in range(5))
    near = [t.upper() for t in (a, b, c, d)]
    rows = [(1, a), (None, near[0]),                      # the row with an id stays
            (None, b), (None, near[1]),                   # one of two rows without
            (5, c), (5, near[2]),                         # one of two with the same id
            (3, d), (7, near[3]), (7, prose(700, 300)),   # a unique text beside a near copy's id
            (9, e), (9, e), (None, None), (None, "")]
    got = after("simhash_dedup", rows)
    assert len(got) == 7
    assert (1, a) in got and (3, d) in got and (7, prose(700, 300)) in got and (9, e) in got
    assert sum(x in got for x in [(None, b), (None, near[1])]) == sum(x in got for x in [(5, c), (5, near[2])]) == 1
    assert got == after("simhash_dedup", rows[::-1])
    few = [(None, a), (None, b), (5, c), (5, d), (5, d), (7, None)]
    assert after("toxicity", few) == sorted(few, key=repr)
    assert after("exact_dedup", [*few, (8, a), (None, b)]) == sorted([(8, a), (None, b), (5, c), (5, d), (7, None)], key=repr)
    assert after("suffix_dedup", few) == sorted([(None, a), (None, b), (5, c), (5, ""), (5, ""), (7, "")], key=repr)
    placed = corpus_pipeline.pack(spark, table(few), sf_small).collect()
    assert sorted(((r["doc_id"], r["piece"]) for r in placed if r["piece"] == 0), key=repr) == sorted([(i, 0) for i, _ in few], key=repr)


def test_columns_of_any_name_come_back_unchanged(spark, sf_small):
    names = ["id", "score", "spans", "kept", "row_a", "row_b", "root", "h", "x0", "salt", "who", "keep_id", "fp", "t", "size", "_d0", "full", "group_size"]
    rows = [(k, prose(900 + k, 120), *(f"{n}-{k}" for n in names)) for k in range(30)] + [(40, prose(900, 120).upper(), *(f"{n}-40" for n in names))]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, sf_small), f"clash-{name}")
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == (30 if name == "simhash_dedup" else 31)
        for r in got:
            assert tuple(r)[2:] == tuple(f"{n}-{r['doc_id']}" for n in names)
    assert corpus_pipeline.pack(spark, docs, sf_small).count() >= 31


def test_run_gives_the_last_stage(spark, stages, sf_small):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf_small)
    assert got.columns == stages[5].columns
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, stages[5].select(*key).collect()))
