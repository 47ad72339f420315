"""Operator 11 against plain differencing on lists and by what must hold for every result."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from errlens.llm import sharding
from errlens.llm.queries import QUERIES
from tests.llm.conftest import CASES, documents, prose


def plain(sizes, shards):
    """Differencing on lists of (sum, members): the members of each shard."""
    nodes = [(k, sorted([(s, [k])] + [(0, [])] * (shards - 1), key=lambda x: -x[0])) for k, s in enumerate(sizes)]
    made = len(sizes) + 1
    while len(nodes) > 1:
        nodes.sort(key=lambda n: (n[1][-1][0] - n[1][0][0], n[0]))
        a, b = nodes.pop(0)[1], nodes.pop(0)[1]
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))]
        nodes.append((made, sorted(both, key=lambda x: -x[0])))
        made += 1
    return [m for _, m in nodes[0][1]]


def sums(sizes, at, shards):
    return np.bincount(at, weights=sizes, minlength=shards).astype(int)


@pytest.mark.parametrize("n, shards, seed", [(1, 3, 0), (2, 3, 1), (5, 2, 2), (40, 4, 3), (120, 7, 4), (30, 40, 5), (9, 1, 6)])
def test_equals_plain_differencing(n, shards, seed):
    r = random.Random(seed)
    sizes = sorted((r.randint(1, 500) for _ in range(n)), reverse=True)
    at = sharding.differencing(np.array(sizes), shards)
    want = plain(sizes, shards)
    assert sorted(sorted(np.flatnonzero(at == s).tolist()) for s in range(shards)) == sorted(map(sorted, want))


def test_textbook_case():
    # 8, 7, 6, 5, 4 in two parts: differencing ends with 16 and 14, the optimum is 15 and 15
    assert sorted(sums([8, 7, 6, 5, 4], sharding.differencing(np.array([8, 7, 6, 5, 4]), 2), 2)) == [14, 16]


def test_close_to_the_optimum():
    r = random.Random(1)
    for _ in range(20):
        sizes = sorted((r.randint(17, 99) for _ in range(9)), reverse=True)
        best = min(max(sums(sizes, np.array(c), 3)) for c in itertools.product(range(3), repeat=9) if c[0] == 0)
        got = max(sums(sizes, sharding.differencing(np.array(sizes), 3), 3))
        assert best <= got <= best + 25


def test_named_start_is_evened_out():
    r = random.Random(2)
    sizes = np.array(sorted((r.randint(17, 999) for _ in range(400)), reverse=True))
    start = np.array([9000, 0, 300, 4000])
    at = sharding.differencing(sizes, 4, start)
    total = start + sums(sizes, at, 4)
    assert total.max() - total.min() <= 20
    at = sharding.differencing(sizes[:3], 4, np.array([10 ** 6, 0, 0, 0]))
    assert 0 not in at.tolist() and len(set(at.tolist())) == 3


def held(rows, got, shards):
    """Checks every row and returns the bytes of each shard."""
    assert sorted(repr((r["id"], r["size"], r["text_crc32"])) for r in got) == sorted(
        repr((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for k, t in rows)
    slots, by_text, total = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        by_text[r["t"] or ""].add(r["shard"])
        total[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_text.values()) and set(slots) <= set(range(shards))
    return [total[s] for s in range(shards)]


def test_groups_slots_and_balance(spark):
    rows = CASES + [(None, None)] * 300 + [(7, prose(9, 80))] * 100 + [(1000 + k, prose(k, 5 + k % 60)) for k in range(1500)]
    docs = documents(spark, rows).withColumnRenamed("t", "t_")
    for per_task, step in ((50_000, 10_000), (100, 30), (7, 3)):
        got = sharding.shard(docs, shards=8, per_task=per_task, step=step, columns=("text", "size", "id"))
        got = got.toDF("id", "size", "text_crc32", "shard", "slot", "t", "own_size", "own_id").collect()
        assert all(r["own_size"] == 4 for r in got)
        total = held(rows, got, 8)
        assert max(total) - min(total) <= (64 if per_task > 7 else 4000), total


def test_hot_group_has_a_shard_for_itself(spark):
    rows = [(k, "same words again") for k in range(2000)] + [(5000 + k, prose(k, 3)) for k in range(400)]
    got = sharding.shard(documents(spark, rows), shards=5, per_task=90, step=20, columns=("text",))
    total = sorted(held(rows, got.toDF("id", "size", "text_crc32", "shard", "slot", "t").collect(), 5))
    assert total[-1] == 2000 * 32 and total[3] - total[0] <= 64


def test_assignment_ignores_layout(spark):
    rows = [(k, prose(k, 1 + k % 30)) for k in range(600)]
    docs = documents(spark, rows)
    a, b = (sharding.shard(d, shards=6, per_task=50, step=20).select("id", "shard").collect() for d in (docs, docs.repartition(7)))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_empty_table_and_bad_parameters(spark):
    assert sharding.shard(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        sharding.shard(documents(spark, []), overhead=0)


def test_query(spark, sf_small):
    df = QUERIES["op11_sharding"](spark, sf_small)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = [r.asDict() | {"id": r["doc_id"], "t": docs[r["doc_id"]]} for r in df.collect()]
    held(list(docs.items()), got, 40)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
