"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing (operator 11).

A group is all rows of one text; it goes to one shard whole.  The law is
``bytes``: the sizes of the shards are as equal as the groups allow.

Method: every group starts as a partial partition with its bytes in one
place and nothing in the others.  The two partial partitions of largest
spread are combined, the fullest place of one with the emptiest of the
other, until one is left; going back through the combinations gives the
shard of each group (``differencing``).

One task cannot hold all groups, so the groups are worked off in classes,
from large to small: class c has those of at least total / 10,000^(c+1)
bytes, thus at most 10,000 of them in the first one and four classes in
100 TB.  A class is dealt by the hash of the group's key to buckets of
``per_task`` groups.  Each bucket differences its groups together with its
share of the shards as they stand (a partial partition whose places have
names), so that small groups even out what large ones left.  The last
bucket of a class meets the shards as they then stand in full.  The driver
holds one number per shard and the size of each class.

Slots are numbered by a prefix sum of the rows of each written part, so no
shard is gathered.  Rows of a large group are dealt by a salt.

Cases: null text has no bytes and is in one group with empty texts; null or
repeated ids are rows like others; a group larger than a shard's share has
a shard for itself as far as others can leave it; with fewer groups than
shards some shards stay empty; an empty table gives no rows; ties go by the
text's SHA-256, so the shard of a text depends on the texts alone.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from errlens.llm.common import SALTS, pick, stored

PER_TASK = 50_000           # groups of a task
STEP = 10_000               # ratio of the thresholds of two classes
OVERHEAD = 16               # bytes of a row beside its text


def differencing(sizes: np.ndarray, shards: int, start: np.ndarray | None = None) -> np.ndarray:
    """The shard of each size.  ``start`` has what the shards hold already; without it shards have no names."""
    n = len(sizes)
    if not n:
        return np.zeros(0, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap = [(-int(s), k) for k, s in enumerate(sizes)]
    names = np.arange(shards)
    if start is not None and start.max() > start.min():
        names = np.argsort(-start, kind="stable")
        sums[n] = start[names]
        heap.append((-int(start.max() - start.min()), n))
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    first = n + 1

    def places(node: int) -> np.ndarray:
        if node < n:
            v = np.zeros(shards, np.int64)
            v[0] = sizes[node]
            return v
        return sums.pop(node)

    while len(heap) > 1:
        a = heapq.heappop(heap)[1]
        b = heap[0][1]
        both = places(a) + places(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        node = first + len(merged)
        sums[node] = both
        merged.append((a, b, order.astype(np.int32)))
        heapq.heapreplace(heap, (int(both[-1]) - int(both[0]), node))
    # from the last combination back: the shard of each place of a node
    at: dict[int, np.ndarray] = {heap[0][1]: np.arange(shards)}
    out = np.empty(n + 1, np.int64)
    for k in range(len(merged) - 1, -1, -1):
        a, b, order = merged[k]
        own = np.empty(shards, np.int64)
        own[order] = at.pop(first + k)
        for node, shard in ((a, own), (b, own[::-1])):
            if node < n:
                out[node] = shard[0]
            else:
                at[node] = shard
    if n in at:                                # places of the named one get their names back
        back = np.empty(shards, np.int64)
        back[at[n]] = names
        return back[out[:n]]
    return out[:n] if merged else np.zeros(n, np.int64)


def _assign(members: DataFrame, shards: int, held: list[int], of: int | None) -> DataFrame:
    """``key``, ``bytes``, ``shard`` of the groups of each ``bucket``, which starts from its share of ``held``.

    ``of``: the bytes by which ``held`` is shared out; None for all of it.
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("bytes", "descending"), ("key", "ascending")]))
        sizes = table.column("bytes").to_numpy()
        own = int(sizes.sum())
        start = np.array([x if of is None else x * own // of for x in held], np.int64)
        return pa.table({"key": table.column("key"), "bytes": table.column("bytes"),
                         "shard": pa.array(differencing(sizes, shards, start), pa.int32())})

    return members.groupBy("bucket").applyInArrow(run, "key binary, bytes long, shard int")


def assign(groups: DataFrame, shards: int, per_task: int = PER_TASK, step: int = STEP) -> DataFrame:
    """``key``, ``shard`` of groups given as ``key`` (binary, distinct) and ``bytes`` (long, positive)."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    least = [max(1, -(-total // step))]
    while least[-1] > 1:
        least.append(max(1, -(-total // step ** (len(least) + 1))))
    kind = F.lit(len(least) - 1)
    for c in range(len(least) - 1, -1, -1):
        kind = F.when(F.col("bytes") >= least[c], F.lit(c)).otherwise(kind)
    classed = groups.withColumn("class", kind)
    found = {r["class"]: r for r in classed.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()}
    held = [0] * shards
    done: list[DataFrame] = []
    for c in sorted(found):
        buckets = -(-found[c]["n"] // per_task)
        members = classed.filter(F.col("class") == c).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        for these, of in ((F.col("bucket") > 0, found[c]["bytes"]), (F.col("bucket") == 0, None)):
            if of is not None and buckets == 1:
                continue
            part = stored(_assign(members.filter(these), shards, held, of), "shard-assigned")
            for r in part.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():
                held[r["shard"]] += r["bytes"]
            done.append(part.select("key", "shard"))
    if not done:
        return groups.select("key", F.lit(0).alias("shard"))
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def shard(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD,
          per_task: int = PER_TASK, step: int = STEP, columns: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless within the shard), one row per row of ``df``.

    ``columns`` names columns of ``df`` that stay with their rows.
    """
    if overhead < 1 or shards < 1:
        raise ValueError("overhead and shards are at least one")
    own = {f"x{k}": c for k, c in enumerate(columns)}
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = pick(df, id=id_col, text=text_col, **own).select(
        "id", (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"), *own)
    rows = stored(rows, "shard-rows")
    part = rows.groupBy("key", "salt").agg(F.sum("size").alias("bytes"))
    groups = stored(part.groupBy("key").agg(F.sum("bytes").alias("bytes")), "shard-groups")
    found = assign(groups, shards, per_task, step)
    salted = part.select("key", "salt").join(found, "key")
    placed = (rows.join(salted, ["key", "salt"]).drop("key", "salt")
              .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    placed = stored(placed, "shard-placed")
    upto = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    base = counts.select("part", "shard", (F.sum("n").over(upto) - F.col("n")).alias("base"))
    numbered = placed.withColumn("k", F.row_number().over(Window.partitionBy("part", "shard").orderBy("at")))
    return (numbered.join(base, ["part", "shard"])
            .select("id", "size", "text_crc32", "shard", (F.col("base") + F.col("k") - 1).alias("slot"), *own).withColumnsRenamed(own))
