"""SimHash near-duplicate detection (operator 2).

Fingerprint: 64 bits from the XXH64 hashes of all word shingles of a text,
hashed many at a time on the text's bytes.

Links: distinct fingerprints are joined by the generalised pigeonhole
principle.

* Correlated bits are grouped into the same part (from the bit
  co-occurrence counts of all distinct fingerprints).
* With ``m`` parts and distance ``k``, thresholds ``t_i >= -1`` with sum
  ``k - m + 1`` lose no link.  Each fingerprint gets its own thresholds by
  dynamic programming over estimated candidate counts, taken from counts of
  all part values, so a crowded value is skipped (-1) where another part is
  cheaper.
* A fingerprint probes all values within ``t_i`` of its part ``i``;
  candidates are verified on all 64 bits.

Whole part values of more than BLOCK fingerprints are counted exactly, and
their buckets split into blocks of index rows times lanes of probe rows; a
value that is not crowded has one bucket, however full its 16-bit cell is.
At most 2^18 values a part can be that crowded, so beyond half a billion
fingerprints a block has up to n / 2^18 rows.  A task holds the index rows of
one bucket and streams its probes.  Of the verified links only a spanning
forest leaves the task.  Components come from alternating
large-star / small-star rounds over tables in the shared folder; hot nodes
are salted.

Cases: null and empty texts, and texts without a word, have fingerprint
zero and are linked like any other; fewer words than a shingle give one
shingle of all words; ids may be null (never the smallest unless all are)
or repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errlens.llm.common import group_stats, out_batch, pick, salt, settled, stored, text_batches

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCK = 2048               # index rows of a bucket that one task compares at once
TABLE_BITS = 16            # part values are counted by this many bits
CROWDED_BITS = 18          # at most 2^18 crowded values a part
PAIRS = 1 << 20            # pairs compared in one numpy step

# XXH64 primes (fixed values of the public algorithm)
P1, P2, P3, P4, P5 = map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161,
                                     9650029242287828579, 2870177450012600261))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


# ---------------------------------------------------------------- fingerprints

def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(buf: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of every slice ``buf[start:start + size]``; ``buf`` has 8 spare bytes at its end."""
    words = np.ndarray((len(buf) - 7,), "<u8", buf.data, 0, (1,))
    lane_seeds = [np.uint64((seed + k) % (1 << 64)) for k in (int(P1) + int(P2), int(P2), 0, -int(P1))]
    seed = np.uint64(seed)
    acc = np.full(len(start), seed + P5, np.uint64)
    at, left = start.astype(np.int64), size.astype(np.int64)

    def mix(a: np.ndarray, lane: np.ndarray) -> np.ndarray:
        return _rotl(a + lane * P2, 31) * P1

    long = np.flatnonzero(left >= 32)
    if len(long):
        lanes = [np.full(len(long), v, np.uint64) for v in lane_seeds]
        live = np.arange(len(long))
        while len(live):
            who = long[live]
            for k in range(4):
                lanes[k][live] = mix(lanes[k][live], words[at[who] + 8 * k])
            at[who] += 32
            left[who] -= 32
            live = live[left[who] >= 32]
        v = sum(_rotl(x, r) for x, r in zip(lanes, (1, 7, 12, 18)))
        for x in lanes:
            v = (v ^ mix(np.zeros(len(long), np.uint64), x)) * P1 + P4
        acc[long] = v
    acc += size.astype(np.uint64)
    zero = np.uint64(0)
    who = np.flatnonzero(left >= 8)
    while len(who):
        k = mix(zero, words[at[who]])
        acc[who] = _rotl(acc[who] ^ k, 27) * P1 + P4
        at[who] += 8
        left[who] -= 8
        who = who[left[who] >= 8]
    who = np.flatnonzero(left >= 4)
    if len(who):
        half = words[at[who]] & np.uint64(0xFFFFFFFF)
        acc[who] = _rotl(acc[who] ^ (half * P1), 23) * P2 + P3
        at[who] += 4
        left[who] -= 4
    who = np.flatnonzero(left >= 1)
    while len(who):
        acc[who] = _rotl(acc[who] ^ (buf[at[who]].astype(np.uint64) * P5), 11) * P1
        at[who] += 1
        left[who] -= 1
        who = who[left[who] >= 1]
    acc ^= acc >> np.uint64(33)
    acc *= P2
    acc ^= acc >> np.uint64(29)
    acc *= P3
    acc ^= acc >> np.uint64(32)
    return acc


def simhash(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    n_docs = len(texts)
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    white = _WHITE[raw]
    stop = np.zeros(len(raw), bool)               # white space right after a word
    stop[1:] = white[1:] & ~white[:-1]
    words_to = np.cumsum(stop)[ends - 1]          # words up to each text's end
    keep = ~white | stop
    buf = _LOWER[raw[keep]]
    gap = stop[keep]
    buf[gap] = 0x20
    buf = np.concatenate([buf, np.zeros(8, np.uint8)])
    word_end = np.flatnonzero(gap)
    word_start = np.r_[0, word_end[:-1] + 1][:len(word_end)]
    n_words = np.diff(np.r_[0, words_to])
    n_sh = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    out = np.zeros(n_docs, np.uint64)
    have = np.flatnonzero(n_sh)
    if not len(have):
        return out
    first = np.cumsum(n_sh) - n_sh
    doc = np.repeat(np.arange(n_docs), n_sh)
    word = (words_to - n_words)[doc] + np.arange(len(doc)) - first[doc]
    last = word + np.minimum(n_words[doc], shingle) - 1
    start = word_start[word]
    h = xxh64(buf, start, word_end[last] - start)
    ones = np.zeros((len(have), 64), np.int64)
    step = 1 << 16
    for k in range(0, len(h), step):              # bounded unpacking
        part = h[k:k + step]
        d = doc[k:k + step]
        cut = np.r_[0, np.flatnonzero(np.diff(d)) + 1]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[np.searchsorted(have, d[cut])] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    set_ = 2 * ones > n_sh[have][:, None]
    out[have] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 columns: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``fp`` (the 64 bits as a signed long), and the named ``columns`` of ``df`` as ``x0``, ``x1``, ..."""
    own = {f"x{k}": c for k, c in enumerate(columns)}
    rows = pick(df, id=id_col, text=text_col, **own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield out_batch(id=b.column("id"), fp=simhash(texts, shingle).view(np.int64), **{x: b.column(x) for x in own})

    kind = {n: rows.schema[n].dataType.simpleString() for n in ("id", *own)}
    more = "".join(f", {x} {kind[x]}" for x in own)
    return rows.mapInArrow(settled(run), f"id {kind['id']}, fp long{more}")


# ---------------------------------------------------------------- generalised pigeonhole

def _bits_of(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have bits i and j set (64 x 64, summed over all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _bits_of(b.column("fp").to_numpy().copy()).astype(np.float64)
            total += x.T @ x
            n += len(x)
        if n:
            yield out_batch(cell=np.arange(4097, dtype=np.int32), n=np.r_[total.reshape(-1), n].astype(np.int64))

    got = dict(fps.select("fp").mapInArrow(settled(run), "cell int, n long").groupBy("cell").agg(F.sum("n")).collect())
    if not got:
        return 0, np.zeros((64, 64))
    flat = np.array([got[k] for k in range(4097)], np.float64)
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal size, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free = list(range(64))
    parts = []
    for k in range(m):
        size = len(free) // (m - k)
        sub = corr[np.ix_(free, free)]
        part = [free[int(np.argmax(sub.sum(1)))]]
        while len(part) < size:
            rest = [b for b in free if b not in part]
            part.append(rest[int(np.argmax(corr[np.ix_(rest, part)].mean(1)))])
        parts.append(sorted(part))
        free = [b for b in free if b not in part]
    return parts


def values_of(fp: np.ndarray, part: list[int]) -> np.ndarray:
    """The bits of a part as a number."""
    v = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(part):
        v |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return v


def value_counts(fps: DataFrame, parts: list[list[int]]) -> np.ndarray:
    """How many fingerprints have each value of the first TABLE_BITS bits of each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(parts), 1 << TABLE_BITS), np.int64)
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for i, part in enumerate(parts):
                total[i] += np.bincount(values_of(fp, part[:TABLE_BITS]).astype(np.int64), minlength=1 << TABLE_BITS)
        at = np.flatnonzero(total)
        yield out_batch(cell=at.astype(np.int32), n=total.reshape(-1)[at])

    counts = fps.select("fp").mapInArrow(settled(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(len(parts) << TABLE_BITS, np.int64)       # bounded: parts x 65,536 cells
    got = counts.toPandas()
    table[got["cell"].to_numpy()] = got["n"].to_numpy()
    return table.reshape(len(parts), -1)


def crowded_values(fps: DataFrame, parts: list[list[int]], table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each part the whole values (ascending) that crowd a bucket, with their exact counts.

    A crowded value has more than BLOCK and more than n / 2^CROWDED_BITS
    fingerprints, so there are at most 2^CROWDED_BITS of them; only values
    in cells as full as that are counted.
    """
    least = max(BLOCK, int(table[0].sum()) >> CROWDED_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for i, part in enumerate(parts):
                who = table[i][values_of(fp, part[:TABLE_BITS]).astype(np.int64)] > least
                if who.any():
                    value, n = np.unique(values_of(fp[who], part), return_counts=True)
                    yield out_batch(part=np.full(len(value), i, np.int32), value=value.view(np.int64), n=n.astype(np.int64))

    got = (fps.select("fp").mapInArrow(settled(run), "part int, value long, n long").groupBy("part", "value")
           .agg(F.sum("n").alias("n")).filter(F.col("n") > least).toPandas())
    out = []
    for i in range(len(parts)):
        mine = got[got["part"] == i]
        value, n = mine["value"].to_numpy(np.int64).view(np.uint64), mine["n"].to_numpy(np.int64)
        order = np.argsort(value)
        out.append((value[order], n[order]))
    return out


def counts_of(value: np.ndarray, crowded: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact count of each crowded value, 0 for the others."""
    known, n = crowded
    if not len(known):
        return np.zeros(len(value), np.int64)
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    return np.where(known[at] == value, n[at], 0)


def near_counts(table: np.ndarray, reach: int) -> np.ndarray:
    """[part, t, value]: fingerprints whose part value is within t bits."""
    bits = TABLE_BITS
    cells = np.arange(table.shape[1])

    def around(x: np.ndarray) -> np.ndarray:
        return sum(x[:, cells ^ (1 << b)] for b in range(bits))

    shells = [table.astype(np.float64)]
    for t in range(1, reach + 1):
        inner = shells[t - 2] * (bits - t + 2) if t > 1 else 0
        shells.append((around(shells[t - 1]) - inner) / t)
    return np.cumsum(np.stack(shells, 1), axis=1)


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Units (threshold + 1) for each part so that they sum to ``total`` at least cost.

    ``cost[part, units, row]``; returns [part, row].
    """
    m, _, n = cost.shape
    best = np.full((total + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((m, total + 1, n), np.int8)
    for i in range(m):
        new = np.full((total + 1, n), np.inf)
        for s in range(total + 1):
            for e in range(s + 1):
                c = best[s - e] + cost[i, e]
                better = c < new[s]
                new[s][better] = c[better]
                choice[i, s][better] = e
        best = new
    units = np.zeros((m, n), np.int64)
    left = np.full(n, total)
    for i in reversed(range(m)):
        units[i] = choice[i, left, np.arange(n)]
        left -= units[i]
    return units


def parts_for(n: int, distance: int) -> int:
    """Number of parts with the least expected probes and comparisons for ``n`` fingerprints."""
    def cost(m: int) -> float:
        width, total = 64 / m, distance - m + 1
        radius = [total // m + (k < total % m) for k in range(m)]
        probes = sum(sum(_choose(width, j) for j in range(r + 1)) for r in radius)
        return n * (probes + m) + n * n * probes / 2.0 ** width / 16
    return min(range(2, distance + 2), key=cost) if distance else 1


def _choose(n: float, k: int) -> float:
    out = 1.0
    for j in range(k):
        out *= (n - j) / (j + 1)
    return out


def _bucket(part: int, value: np.ndarray, block: np.ndarray, lane: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (value ^ (np.uint64(part + 1) << np.uint64(58))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h = (h + block.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + lane.astype(np.uint64) * P4) * P2
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _spread(fp: np.ndarray, n: np.ndarray, seed: np.uint64) -> np.ndarray:
    return (((fp * P1 + seed) >> np.uint64(33)) % np.maximum(n, 1).astype(np.uint64)).astype(np.int64)


def candidate_rows(parts: list[list[int]], table: np.ndarray, crowded: list[tuple[np.ndarray, np.ndarray]],
                   distance: int, block: int = BLOCK) -> Callable[[np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The function from fingerprints to their index and probe rows: ``bucket``, ``probe``, ``fp``."""
    near = near_counts(table, distance)
    widths = [len(p) for p in parts]
    thin = [2.0 ** max(0, w - TABLE_BITS) for w in widths]
    total = distance + 1

    def rows_of(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        value = [values_of(fp, p) for p in parts]
        cell = [values_of(fp, p[:TABLE_BITS]).astype(np.int64) for p in parts]
        own = [counts_of(v, c) for v, c in zip(value, crowded)]
        cost = np.zeros((len(parts), total + 1, len(fp)))
        for i, w in enumerate(widths):
            signatures = 0.0
            for t in range(total):
                signatures += _choose(w, t)
                cost[i, t + 1] = np.maximum(near[i, t, cell[i]] / thin[i], own[i]) + 8 * signatures
        units = allocate(cost, total)
        for i, w in enumerate(widths):
            blocks = np.maximum(-(-own[i] // block), 1)  # of index rows, and as many lanes of probes
            for rows in (np.flatnonzero(blocks == b) for b in np.unique(blocks)):
                b = int(blocks[rows[0]])
                for lane in range(b):                    # an index row goes to one block in every lane
                    yield _bucket(i, value[i][rows], _spread(fp[rows], blocks[rows], P3), np.full(len(rows), lane)), np.zeros(len(rows), bool), fp[rows]
            for t in range(int(units[i].max(initial=0))):
                who = np.flatnonzero(units[i] > t)
                for flip in combinations(range(w), t):
                    mask = np.uint64(sum(1 << b for b in flip))
                    probe = value[i][who] ^ mask
                    here = (probe & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
                    blocks = np.where(table[i][here] > 0, np.maximum(-(-counts_of(probe, crowded[i]) // block), 1), 0)
                    for b in range(int(blocks.max(initial=0))):
                        go = blocks > b
                        lane = _spread(fp[who[go]], blocks[go], P4)
                        yield _bucket(i, probe[go], np.full(int(go.sum()), b), lane), np.ones(int(go.sum()), bool), fp[who[go]]

    return rows_of


def candidates(fps: DataFrame, parts: list[list[int]], table: np.ndarray, crowded: list[tuple[np.ndarray, np.ndarray]],
               distance: int) -> DataFrame:
    """``bucket``, ``probe`` (0 index row, 1 probe row), ``fp``."""
    # bounded: 2^16 counts and at most 2^18 values a part
    shipped, block = fps.sparkSession.sparkContext.broadcast((table, crowded)), BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = candidate_rows(parts, *shipped.value, distance, block)
        for b in batches:
            for bucket, probe, fp in rows_of(b.column("fp").to_numpy().view(np.uint64)):
                yield out_batch(bucket=bucket, probe=probe, fp=np.ascontiguousarray(fp).view(np.int64))

    return fps.select("fp").mapInArrow(settled(run), "bucket long, probe boolean, fp long")


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of the links u-v."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new[a], new[b]):
            break
        label = new
    far = new != np.arange(len(nodes))
    return nodes[far], nodes[new[far]]


def _compare(bucket: np.ndarray, probe: np.ndarray, fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of whole buckets, sorted by bucket with index rows first."""
    first = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1]
    size = np.diff(np.r_[first, len(bucket)])
    index_rows = np.add.reduceat((~probe).astype(np.int64), first)
    group = np.repeat(np.arange(len(first)), size)
    who = np.flatnonzero(probe & (index_rows[group] > 0))
    n = index_rows[group[who]]
    upto = np.cumsum(n)
    k = 0
    while k < len(who):
        e = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS, "right")))
        m = n[k:e]
        left = np.repeat(who[k:e], m)
        right = np.repeat(first[group[who[k:e]]], m) + np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        x = fp[left] ^ fp[right]
        hit = (np.bitwise_count(x) <= distance) & (x != 0)
        if hit.any():
            yield _forest(fp[left[hit]].view(np.int64), fp[right[hit]].view(np.int64))
        k = e


def links(cands: DataFrame, distance: int) -> DataFrame:
    """``a``, ``b``: edges that span the verified links (a > b)."""
    dealt = cands.repartition("bucket").sortWithinPartitions("bucket", "probe")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []               # index rows of the bucket that the next batch may go on with
        for b in batches:
            rows = [b.column("bucket").to_numpy(), b.column("probe").to_numpy(zero_copy_only=False), b.column("fp").to_numpy().view(np.uint64)]
            rows = [np.concatenate(x) for x in zip(held, rows)] if held else rows
            if len(rows[0]):
                for u, v in _compare(*rows, distance):
                    yield out_batch(a=u, b=v)
                open_ = (rows[0] == rows[0][-1]) & ~rows[1]
                held = [x[open_] for x in rows]

    return dealt.mapInArrow(settled(run), "a long, b long").distinct()


def connect(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: components of the edges (a > b), by large-star / small-star rounds."""
    edges, mark = stored(edges, "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == mark:
            break
        mark = now
        both = edges.union(edges.select("b", "a")).toDF("a", "id").withColumn("salt", salt(F.col("id")))
        low = group_stats(both, ["a"], "id").select("a", "salt", F.least("a", "lowest").alias("m"))
        large = (both.join(low, ["a", "salt"]).filter("id > a").select(F.col("id").alias("a"), F.col("m").alias("id"))
                 .distinct().withColumn("salt", salt(F.col("id"))))
        low = group_stats(large, ["a"], "id").select("a", "salt", F.col("lowest").alias("m"))
        small = large.join(low, ["a", "salt"])
        edges = stored(small.select(F.explode(F.array(F.struct(F.col("id").alias("a"), F.col("m").alias("b")),
                                                      F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                       .select("e.a", "e.b").filter("a > b").distinct(), "edges")
    return edges.toDF("node", "root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, columns: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``fp``, ``component_id`` (smallest id reachable), ``root``, one row per row of ``df``.

    ``root`` is a fingerprint that names the component, also where ids are
    null or repeat.  ``columns`` names columns of ``df`` that stay with their
    rows.
    """
    own = {f"x{k}": c for k, c in enumerate(columns)}
    rows = stored(fingerprints(df, id_col, text_col, shingle, columns)
                  .withColumn("salt", salt(F.monotonically_increasing_id())), "fingerprints")
    groups = stored(group_stats(rows, ["fp"], "id").select("fp", "salt", "lowest"), "fingerprint-groups")
    fps = stored(groups.groupBy("fp").agg(F.min("lowest").alias("lowest")), "distinct-fingerprints")
    n, both = bit_counts(fps)
    parts = group_bits(n, both, parts_for(n, distance))
    table = value_counts(fps, parts)
    stars = connect(links(candidates(fps, parts, table, crowded_values(fps, parts, table), distance), distance))
    members = stars.union(stars.select("root", "root").distinct()).toDF("fp", "root")
    members = members.join(fps, "fp").withColumnRenamed("lowest", "id").withColumn("salt", salt(F.col("fp")))
    low = group_stats(members, ["root"], "id").select("root", "salt", F.col("lowest").alias("component_id"))
    component = members.join(low, ["root", "salt"]).select("fp", "root", "component_id")
    resolved = (groups.join(component, "fp", "left")
                .select("fp", "salt", F.coalesce("component_id", "lowest").alias("component_id"), F.coalesce("root", "fp").alias("root")))
    return rows.join(resolved, ["fp", "salt"]).select("id", "fp", "component_id", "root", *own).withColumnsRenamed(own)


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id (null last), with all columns of ``df``.

    Rows are told apart by id and 128 bits of all their columns, so no text
    is stored again; of equal rows one stays.  Column names are left as they
    are and may be any.
    """
    names = [f"_d{k}" for k in range(len(df.columns))]
    rows = df.toDF(*names)
    own, text = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    marked = rows.withColumns({"row_a": F.xxhash64(*names), "row_b": F.xxhash64(F.lit(1), *names)})
    key = [own, "row_a", "row_b"]
    found = near_duplicates(marked, own, text, shingle, distance, columns=("row_a", "row_b"))
    who = F.struct(F.col("id").isNull().alias("none"), "id", "row_a", "row_b")
    found = stored(found.withColumn("who", who).withColumn("salt", salt(F.col("row_a"))), "near-copies")
    first = found.join(group_stats(found, ["root"], "who").select("root", "salt", "lowest"), ["root", "salt"])
    stays = F.col("who").eqNullSafe(F.col("lowest"))
    others = first.filter(~stays).select(F.col("id").alias(own), "row_a", "row_b").distinct()
    equal = first.filter(stays).groupBy(F.col("id").alias(own), "row_a", "row_b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    equal = stored(equal, "equal-rows")

    def among(some: DataFrame, kind: str) -> DataFrame:
        on = [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
        return marked.alias("d").join(some.alias("r"), on, kind)

    if equal.isEmpty():
        rest = among(others, "left_anti").select(*names)
    else:
        rest = among(others.union(equal), "left_anti").select(*names).union(among(equal, "left_semi").dropDuplicates(key).select(*names))
    return rest.toDF(*df.columns)
