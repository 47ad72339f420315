"""Removal of long repeated byte strings (operator 9).

Every byte covered by a string of ``LENGTH`` bytes that also starts
anywhere else goes.  Strings are found by suffix arrays (``suffix_array``,
linear grouping construction), dealt to tasks so that each is bounded:

1. Anchors.  Each window of ``LENGTH`` bytes has an anchor: the first of its
   ``GRAM``-byte grams with the smallest hash.  Equal windows have equal
   anchors at the same place.  A run of windows with one anchor occurrence is
   a segment, a run of at most ``LENGTH - GRAM + 1`` windows.  Equal windows
   can only lie in segments of the same anchor, at the same place relative
   to it, so anchors deal the work to tasks without losing a match.
2. Anchors that occur once are dropped (a fixed-size bitmap of repeated
   anchors; a false hit costs work only).  Segments that occur twice or more
   as a whole are covered as a whole: they are counted by content hash, per
   salt, so copies of a document in any number are reduced before they meet.
3. An anchor with different segments needs more: its segments are reduced to
   one row for each content, the bytes of these go to one task, are cut into blocks aligned to the anchor, and the
   blocks are the symbols of a text whose suffix array is built.  Suffixes
   that share enough blocks are neighbours there; the bytes left and right of
   those blocks are then compared exactly for every window.
4. Anchors with more than ``CROWD`` distinct segments (a passage that very
   many documents share, each with other neighbours) are split: their windows
   are counted by a 128-bit hash, per salt.
5. The covered ranges of a document are merged and cut out.

Matches never cross documents.  Content hashes are 64-bit sums over random
bytes, compared within one anchor hash only.

Cases: null and empty texts, and texts shorter than ``LENGTH``, are kept
whole; rows that repeat a text of ``LENGTH`` bytes or more repeat all its
strings, so all copies are removed; ids may be null or repeat (rows are told
apart by id and text hash; equal rows are cut alike); an empty table gives
an empty result.  Very long texts are scanned in overlapping stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errlens.llm.common import group_stats, out_batch, pick, salt, settled, stored, text_batches
from errlens.llm.exact_dedup import _among, _survivors
from errlens.llm.pretokens import _power_tables
from errlens.llm.suffix_array import suffix_array

LENGTH = 200
GRAM = 48
BLOCK = 25                  # bytes of a symbol
CROWD = 8192                # distinct segments of an anchor that one task takes
WORDS = 1 << 17             # longs in a bitmap
STRETCH = 1 << 20           # bytes scanned at once
TASKS = 1024                # scan tasks whose copies of a segment are reduced together
SYMBOLS = 1 << 16           # symbols of one suffix array, about
_PLACE = np.uint64((1 << 22) - 1)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_STEP = 0xD1342543DE82EF95
_RANDOM = np.random.default_rng(20240101).integers(1, 2 ** 63, (2, 256)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SIDES = np.random.default_rng(5).integers(1, 2 ** 63, LENGTH).astype(np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- segments

def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _M1 + (b ^ (b >> np.uint64(31)))
    h *= _M2
    return h


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at each place (``gram`` = 32 + 16), where they fit."""
    powers = {1: _RANDOM[0][x]}
    k = 1
    while 2 * k <= gram:
        h = powers[k]
        powers[2 * k] = _join(h[:-k], h[k:]) if len(h) > k else h[:0]
        k *= 2
    out, size = powers[k], k
    for k in sorted((p for p in powers if p < size), reverse=True):
        if size + k <= gram:
            tail = powers[k]
            n = max(0, len(x) - size - k + 1)
            out = _join(out[:n], tail[size:size + n])
            size += k
    return out ^ (out >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        h = np.minimum(h[:-k], h[k:]) if len(h) > k else h[:0]
        k *= 2
    rest = width - k
    return np.minimum(h[:len(h) - rest], h[rest:]) if rest and len(h) > rest else (h if not rest else h[:0])


def range_hashes(x: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    up, down = _power_tables(len(x) + 1)
    total = np.empty(len(x) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_RANDOM[which][x] * up[:len(x)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return h ^ (h >> np.uint64(32))


def segments(x: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of texts laid end to end: first window, number of windows, anchor place, anchor hash."""
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    if len(x) < LENGTH:
        return none
    h = gram_hashes(x, GRAM)
    if len(h) - 1 > _PLACE:
        raise ValueError(f"{len(h)} places do not fit the low bits of a key")
    key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(key, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
    # a window may not pass the end of its text
    room = np.repeat(doc_end, np.diff(np.r_[0, doc_end]))[:len(anchor)]
    ok = np.arange(len(anchor)) + LENGTH <= room
    p = np.flatnonzero(ok)
    if not len(p):
        return none
    a = anchor[p]
    cut = np.r_[0, np.flatnonzero((np.diff(p) > 1) | (np.diff(a) != 0)) + 1]
    first = p[cut]
    count = np.diff(np.r_[cut, len(p)])
    return first, count, a[cut], h[a[cut]]


class Scan:
    """Segments of the rows of a batch: places are within the row's text."""

    def __init__(self, batch: pa.RecordBatch):
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        pieces, row, base = [], [], []
        for r, t in enumerate(texts):
            for k in range(0, max(len(t) - LENGTH + 1, 0), STRETCH):
                pieces.append(t[k:k + STRETCH + LENGTH - 1])
                row.append(r)
                base.append(k)
        self.x = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces]).astype(np.int64)
        # places of an anchor are numbered within a few stretches, so that they fit the low bits of a key
        cut = np.flatnonzero(np.diff(ends // STRETCH)) + 1
        found = []
        for i, j in zip(np.r_[0, cut], np.r_[cut, len(ends)]):
            a = int(ends[i - 1]) if i else 0
            first, count, anchor, hash_ = segments(self.x[a:ends[j - 1] if j else 0], ends[i:j] - a)
            found.append((first + a, count, anchor + a, hash_))
        self.first, self.count, self.anchor, self.hash = (np.concatenate(c) for c in zip(*found))
        piece = np.searchsorted(ends, self.first, "right")
        self.row = np.array(row, np.int64)[piece] if len(piece) else piece
        self.start = self.first - (np.r_[0, ends[:-1]][piece] - np.array(base, np.int64)[piece] if len(piece) else 0)
        self.end = self.first + self.count + LENGTH - 1
        # the place of the anchor is part of a segment's identity
        self.content = range_hashes(self.x, self.first, self.end) ^ ((self.anchor - self.first).astype(np.uint64) * _M2) if len(self.first) else self.hash


def _scans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Scan]]:
    for b in text_batches(batches, STRETCH):
        scan = Scan(b)
        if len(scan.first):
            yield b, scan


def _key(rows: DataFrame) -> str:
    return f"id {rows.schema['id'].dataType.simpleString()}, h long"


def all_segments(rows: DataFrame) -> DataFrame:
    """``id``, ``h``, ``anchor``, ``content``, ``start``, ``count``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in _scans(batches):
            at = pa.array(s.row)
            yield out_batch(id=b.column("id").take(at), h=b.column("h").take(at), anchor=s.hash.view(np.int64),
                            content=s.content.view(np.int64), start=s.start, count=s.count.astype(np.int32))

    return rows.mapInArrow(settled(run), _key(rows) + ", anchor long, content long, start long, count int")


def _bitmap(df: DataFrame, words: int, col: str = "anchor") -> np.ndarray:
    """Fixed-size bitmap of the ``anchor`` (or other hash) values of ``df`` (for tasks)."""
    at = F.pmod(F.col(col), F.lit(64 * words))
    cells = (df.select(F.shiftright(at, 6).alias("word"), F.pmod(at, F.lit(64)).cast("int").alias("b"))
             .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b"))).alias("bits"))).toPandas()
    out = np.zeros(words, np.int64)
    out[cells["word"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _in(bitmap: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    at = np.mod(anchors.view(np.int64), 64 * len(bitmap))
    return (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


# ---------------------------------------------------------------- suffix arrays

def repeated_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) pairs whose bytes another segment of the group has at the same place.

    Segment k is ``data[start[k]:end[k]]``, its anchor ``left[k]`` bytes in.
    """
    need = (LENGTH - BLOCK + 1) // BLOCK                # whole blocks inside every window
    first = -(left // BLOCK)
    stop = (end - start - left) // BLOCK
    n = np.maximum(stop - first, 0)
    seg = np.repeat(np.arange(len(start)), n)
    block = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first[seg]
    place = start[seg] + left[seg] + block * BLOCK
    rows = np.empty((len(seg), BLOCK + 12), np.uint8)
    rows[:, :BLOCK] = data[place[:, None] + np.arange(BLOCK)]
    rows[:, BLOCK:BLOCK + 8] = group[seg].astype(np.int64).view(np.uint8).reshape(-1, 8)
    rows[:, BLOCK + 8:] = block.astype(np.int32).view(np.uint8).reshape(-1, 4)
    _, symbol = np.unique(np.ascontiguousarray(rows).view(f"V{BLOCK + 12}").reshape(-1), return_inverse=True)
    # text: the blocks of each segment, then a separator (1); the end is the unique smallest symbol (0)
    spot = np.arange(len(seg)) + seg
    text = np.ones(len(seg) + len(start) + 1, np.int64)
    text[-1] = 0
    text[spot] = symbol + 2
    owner = np.full(len(text), -1)
    owner[spot] = np.arange(len(seg))
    sa = suffix_array(text)
    # neighbours that share the first `need` symbols
    same = np.ones(len(sa) - 1, bool)
    whole = np.ones(len(sa), bool)
    last = len(text) - 1
    for k in range(need):
        s = text[np.minimum(sa + k, last)]
        same &= s[1:] == s[:-1]
        whole &= s > 1
    same &= whole[1:] & whole[:-1]
    run = np.cumsum(np.r_[True, ~same]) - 1
    shared = np.bincount(run)[run] > 1
    who = owner[sa[shared]]                             # block numbers
    run = run[shared].astype(np.uint64)
    out_seg, out_win = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if not len(who):
        return out_seg[0], out_win[0]
    s, at = seg[who], place[who]
    tail = LENGTH - need * BLOCK
    for o in range(BLOCK):
        begin = at - o
        fits = np.flatnonzero((begin >= start[s]) & (begin + LENGTH <= end[s]))
        if not len(fits):
            continue
        b = begin[fits]
        side = np.concatenate([np.arange(o), np.arange(o + need * BLOCK, LENGTH)])
        bytes_ = data[b[:, None] + side]
        for turn in range(8):
            h = ((bytes_.astype(np.uint64) + np.uint64(1)) * np.roll(_SIDES, turn)[:tail]).sum(1, dtype=np.uint64) * _M1
            h = (h ^ (h >> np.uint64(32))) + run[fits] * _M2
            order = np.argsort(h, kind="stable")
            equal = h[order][1:] == h[order][:-1]
            exact = (bytes_[order][1:] == bytes_[order][:-1]).all(1) & (run[fits][order][1:] == run[fits][order][:-1])
            if (equal == exact).all():
                break
        hit = np.zeros(len(fits), bool)
        hit[order[1:][exact]] = True
        hit[order[:-1][exact]] = True
        out_seg.append(s[fits[hit]])
        out_win.append(b[hit] - start[s[fits[hit]]])
    return np.concatenate(out_seg), np.concatenate(out_win)


def _ranges(seg: np.ndarray, win: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows of a segment, as byte ranges within it."""
    order = np.lexsort((win, seg))
    seg, win = seg[order], win[order]
    cut = np.r_[0, np.flatnonzero((np.diff(seg) != 0) | (np.diff(win) > 1)) + 1]
    stop = np.r_[cut[1:], len(seg)] - 1
    return seg[cut], win[cut], win[stop] + LENGTH


def compare_segments(segs: DataFrame, key: str) -> DataFrame:
    """``id``, ``h``, ``s``, ``e``: repeated ranges inside segments whose anchor has different segments.

    ``segs`` has one row for each (anchor, content), see ``distinct_segments``.
    """
    dealt = segs.repartition("anchor").sortWithinPartitions("anchor", "content")

    def flush(groups: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(groups).combine_chunks()
        anchor, copies = t.column("anchor").to_numpy(), t.column("copies").to_numpy()
        group = np.cumsum(np.r_[True, np.diff(anchor) != 0]) - 1
        at = np.flatnonzero(np.bincount(group)[group] > 1)
        copies, group = copies[at], group[at]
        if not len(at):
            return
        part = t.take(pa.array(at))
        blobs = part.column("bytes").to_pylist()
        end = np.cumsum([len(b) for b in blobs]).astype(np.int64)
        start = np.r_[0, end[:-1]]
        data = np.frombuffer(b"".join(blobs) + bytes(BLOCK), np.uint8)
        seg, win = repeated_windows(data, start, end, part.column("lead").to_numpy().astype(np.int64), group)
        alone = copies[seg] == 1                        # segments with copies are covered as a whole
        if alone.any():
            seg, s, e = _ranges(seg[alone], win[alone])
            at = pa.array(seg)
            base = part.column("start").to_numpy()[seg]
            yield out_batch(id=part.column("id").take(at).combine_chunks(), h=part.column("h").take(at).combine_chunks(), s=base + s, e=base + e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            # cut where the anchor changes once enough is held
            k = 0
            anchor = b.column("anchor").to_numpy()
            length = np.cumsum(np.asarray(pc.binary_length(b.column("bytes"))) // BLOCK + 2)
            border = np.flatnonzero(np.diff(anchor)) + 1
            if held and b.num_rows and held[-1].column("anchor")[-1].as_py() != anchor[0]:
                border = np.r_[0, border]
            for c in border.tolist():
                here = size + (int(length[c - 1]) if c else 0) - (int(length[k - 1]) if k else 0)
                if here >= SYMBOLS:
                    if c > k:
                        held.append(b.slice(k, c - k))
                    yield from flush(held)
                    held, size, k = [], 0, c
            if k < b.num_rows:
                held.append(b.slice(k))
                size += int(length[-1]) - (int(length[k - 1]) if k else 0)
        if held:
            yield from flush(held)

    return dealt.mapInArrow(settled(run), key + ", s long, e long")


def segments_with_bytes(rows: DataFrame, mixed: np.ndarray, crowded: np.ndarray, repeated: np.ndarray, again: bool) -> DataFrame:
    """Segments of anchors with several distinct segments, with their bytes.

    With ``again`` those whose content may occur twice or more (``repeated``);
    a batch gives each content once, and a task its bytes once or seldom more
    often.  Otherwise those that occur once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple[int, int]] = set()
        for b, s in _scans(batches):
            pick_ = np.flatnonzero(_in(mixed, s.hash) & ~_in(crowded, s.hash) & (_in(repeated, s.content) == again))
            if not len(pick_):
                continue
            pair = np.stack([s.hash[pick_], s.content[pick_]], 1).view("V16").reshape(-1)
            _, first, copies = np.unique(pair, return_index=True, return_counts=True)
            k = pick_[first]
            data = s.x.tobytes()
            blobs = [data[i:j] for i, j in zip(s.first[k].tolist(), s.end[k].tolist())]
            if again:
                # a content given before still counts, without its bytes
                if len(given) > 500_000:
                    given.clear()
                names = list(zip(s.hash[k].tolist(), s.content[k].tolist()))
                blobs = [None if n in given else x for n, x in zip(names, blobs)]
                given.update(names)
            at = pa.array(s.row[k])
            yield out_batch(id=b.column("id").take(at), h=b.column("h").take(at), anchor=s.hash[k].view(np.int64),
                            content=s.content[k].view(np.int64), start=s.start[k], lead=(s.anchor[k] - s.first[k]).astype(np.int32),
                            copies=copies.astype(np.int64), bytes=pa.array(blobs, pa.binary()))

    return rows.mapInArrow(settled(run), _key(rows) + ", anchor long, content long, start long, lead int, copies long, bytes binary")


def distinct_segments(rows: DataFrame, mixed: np.ndarray, crowded: np.ndarray, repeated: np.ndarray) -> DataFrame:
    """One row for each (anchor, content) of ``segments_with_bytes``, with the number of its copies.

    Contents that may repeat are reduced per block of scan tasks, with
    map-side combine, then over the blocks; the others are alone as they are.
    """
    alone = segments_with_bytes(rows, mixed, crowded, repeated, False)
    many = segments_with_bytes(rows, mixed, crowded, repeated, True).withColumn("block", F.floor(F.spark_partition_id() / F.lit(TASKS)))
    # id, h and start are of use where the content has one row only
    for keys in (["anchor", "content", "block"], ["anchor", "content"]):
        many = many.groupBy(*keys).agg(*(F.first(c).alias(c) for c in ("id", "h", "start", "lead")), F.sum("copies").alias("copies"), F.max("bytes").alias("bytes"))
    return alone.unionByName(many.select(*alone.columns))


def crowded_windows(rows: DataFrame, crowded: np.ndarray) -> DataFrame:
    """``id``, ``h``, ``start``, ``w1``, ``w2``: every window of crowded anchors with its 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in _scans(batches):
            k = np.flatnonzero(_in(crowded, s.hash))
            if not len(k):
                continue
            n = s.count[k]
            seg = np.repeat(k, n)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            p = s.first[seg] + step
            at = pa.array(s.row[seg])
            yield out_batch(id=b.column("id").take(at), h=b.column("h").take(at), start=s.start[seg] + step,
                            w1=range_hashes(s.x, p, p + LENGTH, 0).view(np.int64), w2=range_hashes(s.x, p, p + LENGTH, 1).view(np.int64))

    return rows.mapInArrow(settled(run), _key(rows) + ", start long, w1 long, w2 long")


# ---------------------------------------------------------------- operator

def repeated_ranges(rows: DataFrame, words: int = WORDS, crowd: int = CROWD) -> DataFrame:
    """``id``, ``h``, ``s``, ``e``: byte ranges that repeated strings cover (they may overlap)."""
    found = stored(all_segments(rows), "segments")
    again = _survivors(found.select("anchor"), ["anchor"], words)
    some = stored(found.filter(_among(again, ["anchor"], words)).withColumn("salt", salt(F.col("id"), F.col("h"), F.col("start"))), "segments-again")
    counts = stored(group_stats(some, ["anchor", "content"], "start").select("anchor", "content", "salt", "group_size"), "segment-counts")
    twice = counts.filter("group_size > 1").select("anchor", "content", "salt")
    whole = (some.join(twice, ["anchor", "content", "salt"])
             .select("id", "h", F.col("start").alias("s"), (F.col("start") + F.col("count") + (LENGTH - 1)).alias("e")))
    kinds = (counts.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("x")).groupBy("anchor")
             .agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"))
    kinds = stored(kinds, "mixed-anchors")
    mixed, crowded = _bitmap(kinds, words), _bitmap(kinds.filter(F.col("kinds") > crowd), words)
    repeated = _bitmap(twice, words, "content")
    inside = compare_segments(distinct_segments(rows, mixed, crowded, repeated), _key(rows))
    ranges = whole.unionByName(inside)
    if crowded.any():
        windows = stored(crowded_windows(rows, crowded).withColumn("salt", salt(F.col("id"), F.col("h"), F.col("start"))), "crowded-windows")
        again = group_stats(windows, ["w1", "w2"], "start").filter("group_size > 1").select("w1", "w2", "salt")
        ranges = ranges.unionByName(windows.join(again, ["w1", "w2", "salt"]).select("id", "h", F.col("start").alias("s"), (F.col("start") + LENGTH).alias("e")))
    return ranges


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, crowd: int = CROWD,
                   columns: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``spans`` (start, end of the removed runs), ``kept``, one row per row of ``df``.

    ``kept`` holds the bytes that stay, or with ``as_text`` those as text
    without the rest of characters that were cut through.  ``columns`` names
    columns of ``df`` that stay with their rows.
    """
    extra = {f"x{k}": c for k, c in enumerate(columns)}
    rows = pick(df, id=id_col, text=text_col, **extra).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ranges = repeated_ranges(rows.select("id", "h", "text"), words, crowd)
    per_doc = (ranges.distinct().groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))
               .select(F.col("id").alias("id2"), F.col("h").alias("h2"), "spans"))
    both = rows.join(per_doc, F.col("h").eqNullSafe(F.col("h2")) & F.col("id").eqNullSafe(F.col("id2")), "left").drop("h", "h2", "id2")
    span = pa.struct([("s", pa.int64()), ("e", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, 4 << 20):
            kept, spans, removed, size = [], [], [], []
            for t, ranges_ in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist()):
                merged: list[list[int]] = []
                for r in ranges_ or ():
                    if merged and r["s"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["e"])
                    else:
                        merged.append([r["s"], r["e"]])
                edges = [0, *(v for m in merged for v in m), len(t)]
                kept.append(b"".join(t[i:j] for i, j in zip(edges[::2], edges[1::2])))
                spans.append([{"s": i, "e": j} for i, j in merged])
                size.append(len(t))
                removed.append(len(t) - len(kept[-1]))
            yield out_batch(id=b.column("id"), **{x: b.column(x) for x in extra}, n_bytes=np.array(size, np.int64),
                            n_removed=np.array(removed, np.int64), spans=pa.array(spans, pa.list_(span)), kept=pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary()))

    id_type = rows.schema["id"].dataType.simpleString()
    more = "".join(f"{x} {rows.schema[x].dataType.simpleString()}, " for x in extra)
    out = both.mapInArrow(settled(cut), f"id {id_type}, {more}n_bytes long, n_removed long, spans array<struct<s:long,e:long>>, kept {'string' if as_text else 'binary'}")
    return out.withColumnsRenamed(extra)
