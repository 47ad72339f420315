"""Fill-in-the-middle transformation over piece tables (operator 12).

Method: every document of a batch is a row of a piece table.  A piece is a
descriptor (buffer, start, length) over one of two buffers that are never
changed: the batch's own text bytes and the joined sentinels.

* Cutting splits the one descriptor of a document into prefix, middle and
  suffix; no text is copied.  Token positions come from a bit per byte that
  starts a token and counts per block (rank and select), so a text of any
  length needs about two bytes per byte beside itself.
* An arrangement (plain, psm, spm) is a permutation of the six descriptors
  prefix, middle, suffix and the three sentinels.
* Restoring finds the sentinels of an output, makes descriptors over the
  output and applies the inverse permutation.
* Hashes are fed descriptor by descriptor; an output is only joined where
  its text is asked for.

Work is narrow: no shuffle, and a task holds one bounded slice of texts, or
one text where that alone is larger.

Cases: null text is empty and plain; a text that contains a sentinel is
plain, so the sentinels of an output are its own; a null id draws like an
empty one; equal ids draw equal positions; an empty table gives no rows;
columns are taken by exact name, so further ones cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from errlens.llm.common import out_batch, pick, text_batches

BLOCK = 4096                # bytes of a rank block
PREFIX, MIDDLE, SUFFIX, P, S, M = range(6)
FORMS = ("plain", "psm", "spm")
ORDER = np.array([[PREFIX, MIDDLE, SUFFIX, P, S, M],        # sentinels of a plain document are empty
                  [P, PREFIX, S, SUFFIX, M, MIDDLE],
                  [S, SUFFIX, P, PREFIX, M, MIDDLE]])
INVERSE = np.argsort(ORDER, axis=1)
TEXT, MARKS = 0, 1
PIECE = np.dtype([("buffer", np.int8), ("start", np.int64), ("length", np.int64)])


@dataclass(frozen=True)
class Rule:
    """How documents are cut and arranged.

    ``plain`` of 100 documents stay as they are; ``spm`` of 100 of the
    others put the suffix first.  ``seed`` is hashed with the id.
    """

    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    plain: int = 10
    spm: int = 20
    seed: str = "1"

    def __post_init__(self) -> None:
        for s in self.sentinels:
            if not s or "".join(self.sentinels).count(s[0]) != sum(x[0] == s[0] for x in self.sentinels):
                raise ValueError(f"sentinels {self.sentinels}: a first character may occur nowhere else in them, "
                                 "or a text could run into a sentinel")
        if any(a != b and a.startswith(b) for a in self.sentinels for b in self.sentinels) or len(set(self.sentinels)) < 3:
            raise ValueError(f"sentinels {self.sentinels}: none may begin another")

    @property
    def marks(self) -> list[bytes]:
        return [s.encode() for s in self.sentinels]


# ---------------------------------------------------------------- buffers

class Texts:
    """The bytes of a batch's texts as one immutable buffer, and the bounds of each text."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
        base, end = int(at[0]), int(at[-1])
        self.raw = data.slice(base, end - base).to_pybytes() if data is not None and end > base else b""
        self.bytes = np.frombuffer(self.raw, np.uint8)
        self.bounds = at - base

    def __len__(self) -> int:
        return len(self.bounds) - 1


class Units:
    """Starts of the tokens ``[A-Za-z]+|[^A-Za-z]`` of all texts, by rank and select."""

    def __init__(self, texts: Texts):
        b, self.bounds = texts.bytes, texts.bounds
        letter = ((b | 32) - np.uint8(97)) < 26
        self.lead = (b & 0xC0) != 0x80
        goes_on = np.zeros(len(b), bool)
        goes_on[1:] = letter[1:] & letter[:-1]
        goes_on[self.bounds[:-1][self.bounds[:-1] < len(b)]] = False
        self.start = self.lead & ~goes_on
        counts = np.add.reduceat(self.start, np.arange(0, len(b), BLOCK), dtype=np.int64) if len(b) else np.zeros(0, np.int64)
        self.upto = np.r_[0, np.cumsum(counts)]
        before = [self.rank(x) for x in self.bounds.tolist()]
        self.first = before[:-1]
        self.n = np.diff(before)

    def rank(self, byte: int) -> int:
        """Token starts before a byte."""
        k = byte // BLOCK
        return int(self.upto[k]) + int(np.count_nonzero(self.start[k * BLOCK:byte]))

    def position(self, doc: int, unit: int) -> int:
        """Byte at which a unit of a document starts; its end for the number of its units."""
        if unit == self.n[doc]:
            return int(self.bounds[doc + 1])
        r = self.first[doc] + unit
        k = int(np.searchsorted(self.upto, r, "right")) - 1
        return k * BLOCK + int(np.flatnonzero(self.start[k * BLOCK:(k + 1) * BLOCK])[r - int(self.upto[k])])

    def chars(self, start: int, length: int) -> int:
        return int(np.count_nonzero(self.lead[start:start + length]))


# ---------------------------------------------------------------- piece tables

def draws(seed: str, key: int | str | None) -> tuple[int, int, int, int]:
    """The four 32-bit draws of a document."""
    d = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(d[k:k + 4], "big") for k in (0, 4, 8, 12))


def cut(texts: Texts, units: Units, keys: list, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Piece table (documents x 6, in the order of the constants) and form of each document."""
    table = np.zeros((len(texts), 6), PIECE)
    form = np.zeros(len(texts), np.int64)
    marks = rule.marks
    at = np.r_[0, np.cumsum([len(m) for m in marks])]
    for d in range(len(texts)):
        lo, hi = int(texts.bounds[d]), int(texts.bounds[d + 1])
        h1, h2, h3, h4 = draws(rule.seed, keys[d])
        if lo == hi or h3 % 100 >= 100 - rule.plain or any(texts.raw.find(m, lo, hi) >= 0 for m in marks):
            table[d, PREFIX] = (TEXT, lo, hi - lo)
            continue
        n = int(units.n[d]) + 1
        a, b = sorted((units.position(d, h1 % n), units.position(d, h2 % n)))
        form[d] = 2 if h4 % 100 < rule.spm else 1
        table[d, PREFIX] = (TEXT, lo, a - lo)
        table[d, MIDDLE] = (TEXT, a, b - a)
        table[d, SUFFIX] = (TEXT, b, hi - b)
        for k, kind in enumerate((P, S, M)):
            table[d, kind] = (MARKS, at[k], len(marks[k]))
    return table, form


def arranged(table: np.ndarray, orders: np.ndarray, form: np.ndarray) -> np.ndarray:
    """The descriptors of each document in the order of its form."""
    return np.take_along_axis(table, orders[form], axis=1)


def found(texts: Texts, form: list[str], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Piece table of outputs, in output order, and form of each."""
    table = np.zeros((len(texts), 6), PIECE)
    kinds = np.array([FORMS.index(f) for f in form], np.int64)
    for d, k in enumerate(kinds.tolist()):
        lo, hi = int(texts.bounds[d]), int(texts.bounds[d + 1])
        if not k:
            table[d, 0] = (TEXT, lo, hi - lo)
            continue
        order = [rule.marks[x - P] for x in ORDER[k].tolist() if x >= P]
        starts = [lo]
        for mark in order:
            starts.append(texts.raw.find(mark, starts[-1], hi))
            if starts[-1] < 0:
                raise ValueError(f"an output of form {FORMS[k]} has no {mark!r}")
        if starts[1] != lo:
            raise ValueError(f"an output of form {FORMS[k]} does not begin with {order[0]!r}")
        ends = [*starts[2:], hi]
        for j, (s, mark, e) in enumerate(zip(starts[1:], order, ends)):
            table[d, 2 * j] = (TEXT, s, len(mark))
            table[d, 2 * j + 1] = (TEXT, s + len(mark), e - s - len(mark))
    return table, kinds


def digest(pieces: list, buffers: list[memoryview]) -> str:
    """SHA-256 of the bytes that the descriptors name, in order."""
    h = hashlib.sha256()
    for buffer, start, length in pieces:
        if length:
            h.update(buffers[buffer][start:start + length])
    return h.hexdigest()


def joined(table: np.ndarray, buffers: list[memoryview]) -> pa.Array:
    """The text that each document's descriptors name."""
    ends = np.r_[0, np.cumsum(table["length"].sum(axis=1))]
    data = b"".join(buffers[b][s:s + n] for b, s, n in table.ravel().tolist() if n)
    return pa.LargeStringArray.from_buffers(len(table), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


# ---------------------------------------------------------------- jobs

def _carried(df: DataFrame, id_col: str, text_col: str, columns: tuple[str, ...], **more: str) -> tuple[DataFrame, dict[str, str]]:
    own = {f"x{k}": c for k, c in enumerate(columns)}
    return pick(df, id=id_col, text=text_col, **more, **own), own


def transform(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
              columns: tuple[str, ...] = (), text: bool = True) -> DataFrame:
    """``id``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, ``output_sha256`` and ``output``, one row per document.

    ``text=False`` leaves ``output`` out: its hash is still that of the whole
    output.  ``columns`` stay with their rows.
    """
    rows, own = _carried(df, id_col, text_col, columns)
    marks = memoryview(b"".join(rule.marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            texts = Texts(b.column("text"))
            units = Units(texts)
            table, form = cut(texts, units, b.column("id").to_pylist(), rule)
            chars = [[units.chars(s, n) if k else None for k, (_, s, n) in zip(form.tolist(), table[:, part].tolist())]
                     for part in (PREFIX, MIDDLE)]
            table = arranged(table, ORDER, form)
            buffers = [memoryview(texts.raw), marks]
            cols = {"id": b.column("id"), "n": pa.array(units.n.astype(np.int64)), "form": pa.array([FORMS[k] for k in form]),
                    "prefix_chars": pa.array(chars[0], pa.int64()), "middle_chars": pa.array(chars[1], pa.int64()),
                    "output_sha256": pa.array([digest(x, buffers) for x in table.tolist()], pa.string())}
            if text:
                cols["output"] = joined(table, buffers)
            yield out_batch(**cols, **{x: b.column(x) for x in own})

    kinds = {"id": rows.schema["id"].dataType, "n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(),
             "middle_chars": T.LongType(), "output_sha256": T.StringType()} | ({"output": T.StringType()} if text else {})
    schema = T.StructType([T.StructField(n, t) for n, t in kinds.items()] + [T.StructField(x, rows.schema[x].dataType) for x in own])
    return rows.mapInArrow(run, schema).withColumnsRenamed(own)


def restore(df: DataFrame, rule: Rule = Rule(), id_col: str = "id", output_col: str = "output", form_col: str = "form",
            columns: tuple[str, ...] = (), text: bool = True) -> DataFrame:
    """``id``, ``restored_sha256`` and ``restored``, rebuilt from output and form alone.

    An output whose sentinels are missing or in another order is an error.
    """
    rows, own = _carried(df, id_col, output_col, columns, form=form_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            texts = Texts(b.column("text"))
            table, form = found(texts, b.column("form").to_pylist(), rule)
            table = arranged(table, INVERSE, form)[:, :P]
            buffers = [memoryview(texts.raw)]
            cols = {"id": b.column("id"), "restored_sha256": pa.array([digest(x, buffers) for x in table.tolist()], pa.string())}
            if text:
                cols["restored"] = joined(table, buffers)
            yield out_batch(**cols, **{x: b.column(x) for x in own})

    kinds = {"id": rows.schema["id"].dataType, "restored_sha256": T.StringType()} | ({"restored": T.StringType()} if text else {})
    schema = T.StructType([T.StructField(n, t) for n, t in kinds.items()] + [T.StructField(x, rows.schema[x].dataType) for x in own])
    return rows.mapInArrow(run, schema).withColumnsRenamed(own)


def round_trip(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``transform`` and ``restore`` in one pass, with the hashes of both texts."""
    made = transform(df, rule, id_col, text_col)
    keep = ("n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return restore(made, rule, columns=keep, text=False)
