"""Best-fit packing of tokenised documents (operator 1).

Method: bounded-space best fit.  A packer keeps a fixed number of
open bins; a bitset (one integer) has a bit for each amount of free space
that some open bin has.  A piece goes to the open bin with the least
sufficient free space, found with one shift and one lowest-bit step.  If
none fits, a bin is opened; when all places are taken, the fullest open bin
closes first.

Documents longer than a sequence are cut: the first piece takes the
remainder, all others fill a sequence each.  Pieces (not ids) are dealt to
packers by a hash of id, piece and place in the written table, so rows of a
null or hot id go to all of them.  Every packer reads its pieces longest
first, so short pieces come when there are gaps for them; its bound seldom
binds then.

Cases: null and empty texts still have their end token, one piece of one
token; ids may be null or repeat (rows are kept apart by their own place in
the sort); an empty table gives an empty result; a piece is never longer
than a sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errlens.llm.bpe import _binaries, encode_texts
from errlens.llm.common import out_batch, pick, settled, stored, text_batches, texts_of

CAPACITY = 1024
OPEN_BINS = 1 << 16
PIECES_PER_PACKER = 100_000


def pieces(df: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids``: the token ids of every document, cut at the capacity."""
    rows = pick(df, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            ids, ends = encode_texts(texts_of(b), path)
            with_end = np.insert(ids, ends, np.uint32(end_id))
            n = np.diff(np.r_[0, ends]) + 1
            first = np.cumsum(n) - n
            count = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = (n - (count - 1) * capacity)[doc]
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            yield out_batch(id=b.column("id").take(pa.array(doc)), piece=piece.astype(np.int32), start=start, length=length,
                            ids=_binaries(with_end, first[doc] + start + length))

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(settled(run), f"id {id_type}, piece int, start long, length long, ids binary")


class Packer:
    """Open bins of one packer, found by their free space."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.room = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece."""
        fit = self.bits >> length
        if fit:
            space = length + (fit & -fit).bit_length() - 1
            b = self._take(space)
        else:
            if self.open == self.room:
                self._take((self.bits & -self.bits).bit_length() - 1)    # the fullest closes
                self.open -= 1
            b, space = self.made, self.capacity
            self.made += 1
            self.open += 1
        left = space - length
        if left:
            self.free[left].append(b)
            self.bits |= 1 << left
        else:
            self.open -= 1
        return b, self.capacity - space

    def _take(self, space: int) -> int:
        bins = self.free[space]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << space)
        return b


def pack(items: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         per_packer: int = PIECES_PER_PACKER) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``id``, ``piece``, ``length`` (1 to ``capacity``)."""
    items = stored(items, "pack-items")
    packers = max(1, -(-items.count() // per_packer))
    dealt = (items.withColumn("deal", F.xxhash64("id", "piece", F.monotonically_increasing_id()))
             .repartition(packers, "deal").sortWithinPartitions(F.desc("length"), "deal", "id", "piece", "start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [packer.place(k) for k in b.column("length").to_pylist()]
            seq, offset = (np.array(placed, np.int64).reshape(-1, 2)).T
            keep = {n: b.column(n) for n in b.schema.names if n != "deal"}
            yield out_batch(**keep, sequence_id=base + seq, offset=np.ascontiguousarray(offset))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return dealt.mapInArrow(settled(run), f"{fields}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length``, ``ids`` of each packed sequence, from placed pieces that carry ``ids``."""
    members = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), members.alias("m"))
            .select("sequence_id", "length",
                    F.aggregate("m", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
