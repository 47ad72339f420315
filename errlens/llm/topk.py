"""Exact top-k search by inner product (operator 8).

Method: multi-resolution segment statistics.  At resolution r a vector is
cut into r segments, each with its length, mean and standard deviation.
The squared distance of two vectors is at least
``sum len * ((mean difference)^2 + (deviation difference)^2)``, and the
inner product is ``(|q|^2 + |x|^2 - distance^2) / 2``, so every lower bound
of a distance is an upper bound of a score.  A query goes from coarse to
fine: vectors whose bound is below the k-th best exact score found so far
are dropped, finer statistics are taken for the rest, and the exact product
only for the survivors.

Components are ``floor(scale * x)``, integers, so exact scores are exact.

How the work is dealt:

1. Vectors are range-partitioned by (length, signs of the segment means,
   place in the written table), so chunks hold vectors that resemble each
   other, and a vector that many rows repeat spans many chunks.  A chunk has
   a bounded number of components.
2. Each query meets its own chunk first.  Its k-th best score there is a
   floor that its k best of all reach.
3. Each chunk has a box: the range of each statistic over its vectors.  A
   query is sent only to chunks whose box allows a score of its floor or
   more; at most about ``BOXES`` boxes go to the tasks, each for one chunk, or
   for neighbouring chunks where there are more.
4. Queries stream past the chunk, which alone is held.  A chunk is copied
   once for each ``LANE`` query components, so for a fixed query set the rows
   shuffled grow linearly with the vectors.  Every (query, chunk) gives at
   most k rows; a window takes the k best.

Cases: vectors that are null, or hold a null or non-finite component, take
no part; vectors of different length are never compared; an empty vector
scores 0 with others; ties go to the smaller id; rows with a null id take
no part; a row that repeats an id or a whole row is a row like others, as
query and as candidate, and only the query's own row is not its candidate;
scores beyond 64 bits are cut to the 64-bit range; an empty table or one
without queries gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from errlens.llm.common import out_batch, pick, settled, stored, tasks_for

SCALE = 256
CHUNK = (1 << 19, 1 << 22)  # components of a chunk: at least, at most
LANE = 1 << 26              # components of the queries that one task streams
BOXES = 1 << 14
FINEST = 16                 # segments of the statistics that boxes and signs are taken from
_SLICE = 4096               # rows of an output batch
_SAFE = 2.0 ** 52


def segments(dim: int) -> list[np.ndarray]:
    """Segment starts at each resolution, coarse to fine, while segments hold two components or more."""
    out, r = [], 1
    while r <= dim // 2:
        out.append(np.arange(r) * dim // r)
        r *= 4
    return out


def statistics(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``sqrt(len) * mean`` and ``sqrt(len) * deviation`` of each segment, so that bounds are dot products."""
    size = np.diff(np.r_[starts, x.shape[1]])
    mean = np.add.reduceat(x, starts, axis=1) / size
    dev = np.sqrt(np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, starts, axis=1) / size)
    return np.concatenate([mean, dev], axis=1) * np.sqrt(np.r_[size, size])


def _box_statistics(x: np.ndarray) -> np.ndarray:
    """Statistics at the finest resolution of at most ``FINEST`` segments; no columns for vectors of one component or none."""
    levels = [s for s in segments(x.shape[1]) if len(s) <= FINEST]
    return statistics(x, levels[-1]) if levels else np.zeros((len(x), 0))


def _exact(query: np.ndarray, peak: float | np.ndarray, dim: int) -> np.ndarray:
    """Are the products of each query with vectors of components up to ``peak`` exact in doubles?"""
    return np.maximum(np.abs(query).max(axis=1, initial=0).reshape(-1, *([1] * np.ndim(peak))), peak) ** 2 * max(dim, 1) < _SAFE


class Chunk:
    """Vectors of one length, by ascending id, with their statistics at every resolution."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, own: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.x, self.ids, self.own = x[order], ids[order], own[order]
        self.dim = x.shape[1]
        self.peak = np.abs(x).max(initial=0)
        self.levels = self.longest = None

    def _prepare(self) -> None:
        if self.levels is None:
            self.levels = [(s, statistics(self.x, s)) for s in segments(self.dim)]
            self.longest = np.linalg.norm(self.x, axis=1).max(initial=0)

    def best(self, query: np.ndarray, query_own: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[list, list, list]:
        """The k best for each query, of those that reach its floor: positions of queries, ids, scores."""
        floor = np.full(len(query), -np.inf) if floor is None else floor
        exact = _exact(query, self.peak, self.dim)
        found = ([], [], [])
        if exact.any():
            self._prepare()
            levels = [(statistics(np.where(exact[:, None], query, 0), s), own) for s, own in self.levels]
            # |q||x| bounds the rounding error of the statistics
            slack = 1e-9 * np.linalg.norm(query, axis=1) * (self.longest + 1)
        if not exact.all():
            big = [[int(v) for v in row] for row in self.x]
        for j in range(len(query)):
            live = np.flatnonzero(self.own != query_own[j])
            if exact[j]:
                live, value = self._refine(live, query[j], [(q[j], s) for q, s in levels], k, floor[j], slack[j])
            else:
                mine = [int(v) for v in query[j]]
                value = [max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(mine, big[i])))) for i in live.tolist()]
                few = sorted(range(len(value)), key=lambda i: -value[i])[:k]        # ids ascend: ties by id
                live, value = live[few], [value[i] for i in few]
            found[0].extend([j] * len(live))
            found[1].extend(self.ids[live].tolist())
            found[2].extend(value)
        return found

    def _refine(self, live, query, levels, k, floor, slack) -> tuple[np.ndarray, list[int]]:
        for q, s in levels:
            bound = s[live] @ q
            if len(live) > k:
                # the k vectors of the highest bounds give a score that the k-th best reaches at least
                top = live[np.argpartition(-bound, k - 1)[:k]]
                floor = max(floor, (self.x[top] @ query).min())
            live = live[bound >= floor - slack]
            if not len(live):
                return live, []
        score = self.x[live] @ query
        if len(live) > k:
            few = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
            few = few[np.argsort(-score[few], kind="stable")[:k]]                   # ids ascend: ties by id
            live, score = live[few], score[few]
        return live, score.astype(np.int64).tolist()


def best(query: np.ndarray, query_own: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int,
         x_own: np.ndarray | None = None) -> tuple[list, list, list]:
    """The k best of one chunk for each query: positions of queries, ids, scores.

    A vector whose ``x_own`` (its id unless given) is the query's is left out.
    """
    return Chunk(x, x_id, x_id if x_own is None else x_own).best(query, query_own, k)


class Boxes:
    """Ranges of the statistics of chunks, and which of them can hold a score of a query's floor."""

    def __init__(self, rows: list):
        self.first, self.last, self.seq = (np.array([r[n] for r in rows], np.int64) for n in ("first", "last", "seq"))
        self.dims = np.array([(r["low_dim"], r["high_dim"]) for r in rows], np.int64).reshape(len(rows), 2)
        self.peak = np.array([r["peak"] for r in rows], np.float64)
        self.lo, self.hi = (np.array([r[n] for r in rows], np.float64).reshape(len(rows), 2 * FINEST) for n in ("lo", "hi"))

    def reach(self, query: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Queries x boxes: may the box hold a vector of the query's length that scores its floor?"""
        dim, q = query.shape[1], _box_statistics(query)
        near = (self.dims[:, 0] <= dim) & (dim <= self.dims[:, 1])
        out = np.broadcast_to(near, (len(query), len(near))).copy()
        width = q.shape[1]
        tight = np.flatnonzero(near & (self.dims[:, 0] == self.dims[:, 1]))         # vectors of one length
        if not width or not len(tight):
            return out
        lo, hi = self.lo[tight, :width], self.hi[tight, :width]
        bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
        longest = np.sqrt((np.maximum(np.abs(lo), np.abs(hi)) ** 2).sum(1))
        slack = 1e-9 * np.linalg.norm(query, axis=1)[:, None] * (longest + 1)
        out[:, tight] = (bound >= floor[:, None] - slack) | ~_exact(query, self.peak[tight], dim)
        return out


def _floor(c: Column) -> Column:
    """Floor as double: Spark's own floor gives a long, which large values do not fit."""
    return F.when(F.abs(c) < 2.0 ** 53, F.floor(c).cast("double")).otherwise(c)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _of_length(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of each vector length: length, rows, vectors."""
    dims = b.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        part = b if (dims == dim).all() else b.filter(pa.array(dims == dim))
        yield dim, part, _matrix(part.column("v"), dim)


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``signs``: a bit for each segment whose mean is positive; vectors beyond exact doubles have a bit of their own."""
    for b in batches:
        for dim, part, x in _of_length(b):
            means = _box_statistics(x)
            means = means[:, :means.shape[1] // 2]
            key = (means > 0) @ (1 << np.arange(means.shape[1], dtype=np.int64)) if means.shape[1] else np.zeros(len(x), np.int64)
            yield out_batch(**{n: part.column(n) for n in part.schema.names}, signs=key + (~_exact(x, 0.0, dim)).astype(np.int64) * (1 << FINEST))


def _cut(k: int, limit: int):
    """Task over one range partition: cut into chunks, with floors of the queries; the first row of a chunk has its box."""
    def chunk_rows(rows: pa.RecordBatch, pid: int, seq: int) -> Iterator[pa.RecordBatch]:
        lead = True
        lows, highs, peak = np.full(2 * FINEST, np.nan), np.full(2 * FINEST, np.nan), 0.0
        parts = list(_of_length(rows))
        for dim, part, x in parts:
            s = _box_statistics(x)
            if s.shape[1] and len(parts) == 1:
                lows[:s.shape[1]], highs[:s.shape[1]] = s.min(0), s.max(0)
            peak = max(peak, float(np.abs(x).max(initial=0)))
        for dim, part, x in parts:
            ids, place, q = (part.column(n).to_numpy(zero_copy_only=False) for n in ("id", "place", "q"))
            floor = np.full(len(ids), -np.inf)
            asked = np.flatnonzero(q)
            if len(asked):
                at, _, score = Chunk(x, ids, place).best(x[asked], place[asked], k)
                at, score = np.array(at, np.int64), np.array(score, np.float64)
                full = np.flatnonzero(np.bincount(at, minlength=len(asked)) == k)
                lowest = np.full(len(asked), np.inf)
                np.minimum.at(lowest, at, score)
                floor[asked[full]] = lowest[full]
            low, high, peaks = ([None] * len(ids) for _ in range(3))
            if lead:
                low[0], high[0], peaks[0], lead = lows.tolist(), highs.tolist(), peak, False
            yield out_batch(**{n: part.column(n) for n in ("id", "v", "dim", "place", "q")}, pid=np.full(len(ids), pid, np.int32),
                            seq=np.full(len(ids), seq, np.int32), floor=floor, lo=pa.array(low, pa.list_(pa.float64())),
                            hi=pa.array(high, pa.list_(pa.float64())), peak=pa.array(peaks, pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq, size, held = TaskContext.get().partitionId(), 0, 0, []
        for b in batches:
            ends = size + np.cumsum(b.column("dim").to_numpy().astype(np.int64) + 1)
            start = 0
            while start < b.num_rows:
                # up to the row that fills the chunk, one at least
                stop = max(int(np.searchsorted(ends, limit, side="right")), start + (not held))
                if stop > start:
                    held.append(b.slice(start, stop - start))
                if stop < b.num_rows:
                    yield from chunk_rows(_joined(held), pid, seq)
                    held, seq = [], seq + 1
                    ends = ends - (ends[stop - 1] if stop else size)
                start = stop
            size = int(ends[-1]) if b.num_rows else size
        if held:
            yield from chunk_rows(_joined(held), pid, seq)
    return run


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _send(boxes: Boxes):
    """Task over queries: a row for each chunk that a query must meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 20) // max(1, len(boxes.seq)))
        for b in batches:
            for _, part, x in _of_length(b):
                for start in range(0, len(x), step):
                    floor = part.column("floor").to_numpy()[start:start + step]
                    row, box = np.nonzero(boxes.reach(x[start:start + step], floor))
                    width = boxes.last[box] - boxes.first[box] + 1
                    ends = np.cumsum(width)
                    total = int(ends[-1]) if len(ends) else 0
                    for s in range(0, total, _SLICE):
                        n = np.arange(s, min(total, s + _SLICE))
                        pair = np.searchsorted(ends, n, side="right")
                        rows = part.take(pa.array(start + row[pair]))
                        yield out_batch(pid=(boxes.first[box[pair]] + n - (ends - width)[pair]).astype(np.int32),
                                        seq=boxes.seq[box[pair]].astype(np.int32), kind=np.ones(len(n), np.int32),
                                        **{c: rows.column(c) for c in ("dim", "id", "place", "v", "floor")})
    return run


def _meet(k: int):
    """Task over chunks, each followed by its queries: the k best of the chunk for each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, chunks = None, [], None
        for b in batches:
            pid, seq, kind = (b.column(n).to_numpy() for n in ("pid", "seq", "kind"))
            cuts = np.flatnonzero((np.diff(pid) != 0) | (np.diff(seq) != 0) | (np.diff(kind) != 0)) + 1
            for s, e in zip(np.r_[0, cuts].tolist(), np.r_[cuts, b.num_rows].tolist()):
                if s == e:
                    continue
                part = b.slice(s, e - s)
                if now != (pid[s], seq[s]):
                    now, held, chunks = (pid[s], seq[s]), [], None
                if kind[s] == 0:
                    held.append(part)
                    continue
                if chunks is None:
                    chunks = {dim: Chunk(x, *(rows.column(n).to_numpy() for n in ("id", "place")))
                              for dim, rows, x in _of_length(_joined(held))} if held else {}
                    held = []
                for dim, rows, q in _of_length(part):
                    if dim in chunks:
                        own, place = rows.column("id").to_numpy(), rows.column("place").to_numpy()
                        at, ids, scores = chunks[dim].best(q, place, k, rows.column("floor").to_numpy())
                        yield out_batch(query_id=own[at], place=place[at], id=np.array(ids, np.int64), score=np.array(scores, np.int64))
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, block: int | None = None, chunk: int | None = None, boxes: int = BOXES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id``, ``score``; ``is_query`` is a condition on ``id`` (an integer).

    ``chunk`` vectors make a chunk and ``block`` queries a stream past it;
    unless given, they follow from the vectors' lengths, ``CHUNK`` and ``LANE``.
    """
    spark = vectors.sparkSession
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    usable = (pick(vectors, id=id_col, v=vector_col).withColumn("id", F.col("id").cast("long"))
              .withColumn("v", F.col("v").cast("array<double>")).filter("id IS NOT NULL AND v IS NOT NULL").filter(finite)
              .select("id", F.transform("v", lambda c: _floor(c * F.lit(float(scale)))).alias("v"))
              .withColumn("dim", F.size("v")).withColumn("q", F.coalesce(is_query, F.lit(False)))
              .withColumn("place", F.monotonically_increasing_id()))
    fields = "id long, v array<double>, dim int, q boolean, place long"
    usable = stored(usable.mapInArrow(settled(_signs), fields + ", signs long"), "vectors")
    # a row counts its components and one more
    n, total, asked = usable.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("dim") + 1), F.lit(0)),
                                 F.coalesce(F.sum(F.when(F.col("q"), F.col("dim") + 1)), F.lit(0))).first()
    mean = -(-total // max(n, 1))
    size = chunk * mean if chunk else min(max(total // (4 * tasks_for(spark)), CHUNK[0]), CHUNK[1])
    size, lane = max(size, 1), max(block * mean if block else LANE, 1)
    parts, lanes = max(1, -(-total // size)), max(1, -(-asked // lane))
    fields = "id long, v array<double>, dim int, place long, q boolean, pid int, seq int, floor double, lo array<double>, hi array<double>, peak double"
    # ranges are cut by a sample, so a range may be larger than the mean; one of over twice the mean is more than one chunk
    ranges = usable.repartitionByRange(parts, "dim", "signs", "place").sortWithinPartitions("dim", "signs", "place")
    chunks = stored(ranges.mapInArrow(settled(_cut(k, 2 * size)), fields), "chunks")

    parts = (chunks.agg(F.max("pid")).first()[0] or 0) + 1
    group = F.floor(F.col("pid") / F.lit(-(-parts // boxes)))
    ends = [f(F.get(n, F.lit(i))) for n, f in (("lo", F.min), ("hi", F.max)) for i in range(2 * FINEST)]
    box = (chunks.groupBy(group.alias("g"), "seq")
           .agg(F.min("pid").alias("first"), F.max("pid").alias("last"), F.min("dim").alias("low_dim"), F.max("dim").alias("high_dim"),
                F.max("peak").alias("peak"), F.array(*ends[:2 * FINEST]).alias("lo"), F.array(*ends[2 * FINEST:]).alias("hi")).collect())
    fields = "pid int, seq int, kind int, dim int, id long, place long, v array<double>, floor double"
    sent = chunks.filter("q").select("dim", "id", "place", "v", "floor").mapInArrow(settled(_send(Boxes(box))), fields)
    sent = sent.withColumn("lane", F.pmod(F.xxhash64("place"), F.lit(lanes)).cast("int"))
    held = (chunks.select("pid", "seq", F.lit(0).alias("kind"), "dim", "id", "place", "v", F.lit(None).cast("double").alias("floor"))
            .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))))
    dealt = (held.unionByName(sent).repartitionById(parts * lanes, (F.col("pid") * lanes + F.col("lane")).cast("int"))
             .sortWithinPartitions("lane", "pid", "seq", "kind").select("pid", "seq", "kind", "dim", "id", "place", "v", "floor"))
    partial = dealt.mapInArrow(settled(_meet(k)), "query_id long, place long, id long, score long")
    by = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
