"""Byte-pair encoding and decoding (operator 6).

Method: a segment tree over the ranks of adjacent pairs.  A leaf holds
``rank * leaves + position`` of its pair, or a value above all ranks if the
pair does not merge, an inner node the smaller of its children, so the
root yields the leftmost lowest-rank merge.  A merge changes three leaves,
each mended with logarithmically many steps, until the root holds no
mergeable pair.  Trees of the same size are worked on together: one numpy
step does the next merge of thousands of pre-tokens.  Long pre-tokens take
the same tree one at a time on Python lists.

A text is split into pre-tokens (``pretokens``), each distinct one is
encoded once per worker while it stays in a bounded memory of encoded
pre-tokens, and ids are gathered per text.

Cases: null and empty texts have no ids and decode to the empty text;
special strings in a text are their own ids (the library's default);
texts of any length are taken whole; repeated rows are encoded each.  The
id column may be null and may repeat.  An empty table gives an empty one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from errlens.llm import pretokens as PT
from errlens.llm.common import out_batch, pick, settled, text_batches, texts_of

NONE = np.int64(1) << 62
LONG = 256                 # leaves from which a pre-token is merged alone
# How a byte-level vocabulary file normalises and splits texts (fixed value).
BYTE_LEVEL = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
KEEP = 400_000             # distinct pre-tokens that a worker remembers
KEEP_CHARS = 1 << 25        # and their characters


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Merges:
    """Vocabulary, pair ranks and merged ids of a BPE model in the tokenizers JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.layout = (spec.get("normalizer"), spec.get("pre_tokenizer"))
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials = tuple(t["content"] for t in spec["added_tokens"])
        self.special_ids = [t["id"] for t in spec["added_tokens"]]
        symbols = byte_symbols()
        self.byte_id = np.array([self.vocab[s] for s in symbols], np.int64)
        self.last_id = np.array([self.vocab[s + self.suffix] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self._index(left << 20 | right)
        self.rank_of = {(a, b): k for k, (a, b) in enumerate(zip(left.tolist(), right.tolist()))}
        back = {s: b for b, s in enumerate(symbols)}
        table: list[bytes] = [b""] * (max([*self.vocab.values(), *self.special_ids]) + 1)
        for word, k in self.vocab.items():
            table[k] = bytes(back[c] for c in word) if all(c in back for c in word) else word.encode()
        for word, k in zip(self.specials, self.special_ids):
            table[k] = word.encode()
        self.bytes_len = np.array([len(x) for x in table], np.int64)
        self.bytes_at = np.r_[0, np.cumsum(self.bytes_len)[:-1]]
        self.bytes_all = np.frombuffer(b"".join(table), np.uint8)

    def _index(self, keys: np.ndarray) -> None:
        """Open addressing over pair keys, filled round by round."""
        self._bits = np.uint64(64 - 18)
        size = 1 << 18
        self._slot_key = np.full(size, -1, np.int64)
        self._slot_rank = np.full(size, NONE, np.int64)
        rank = np.arange(len(keys))
        at = self._home(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self._slot_key[at] < 0)
            slot, who = np.unique(at[free], return_index=True)
            who = free[who]
            self._slot_key[slot], self._slot_rank[slot] = keys[who], rank[who]
            rest = np.ones(len(keys), bool)
            rest[who] = False
            keys, rank, at = keys[rest], rank[rest], (at[rest] + 1) % size

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._bits).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge."""
        keys = left << 20 | right
        at = self._home(keys)
        out = np.where(self._slot_key[at] == keys, self._slot_rank[at], NONE)
        open_ = np.flatnonzero((out == NONE) & (self._slot_key[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at = at if len(at) == len(open_) else at[open_]
            at = (at + 1) % len(self._slot_key)
            k = keys[open_]
            found = self._slot_key[at] == k
            out[open_[found]] = self._slot_rank[at[found]]
            go = ~found & (self._slot_key[at] >= 0)
            open_, at = open_[go], at[go]
        return out

    # ------------------------------------------------------------ encoding

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        n = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(n) - n
        sym = self.byte_id[raw]
        sym[start + n - 1] = self.last_id[raw[start + n - 1]]
        count = n.copy()
        leaves = np.where(n > 1, 1 << np.ceil(np.log2(np.maximum(n - 1, 1))).astype(np.int64), 0)
        merged_away = np.zeros(len(sym), bool)
        for c in np.unique(leaves[leaves > 0]).tolist():
            who = np.flatnonzero(leaves == c)
            step = (1 << 17) // c if c < LONG else 1
            for group in (who[i:i + step] for i in range(0, len(who), step)):
                if c < LONG:
                    alive, got = self._merge_many(sym, start[group], n[group], c)
                else:
                    alive, got = self._merge_one(sym[start[group[0]]:start[group[0]] + n[group[0]]].tolist(), c)
                cell = start[group][:, None] + np.arange(alive.shape[1])
                inside = np.arange(alive.shape[1]) < n[group][:, None]
                sym[cell[inside]] = got[inside]
                merged_away[cell[inside]] = ~alive[inside]
                count[group] = alive.sum(1)
        return sym[~merged_away].astype(np.uint32), count

    def _merge_many(self, sym, start, n, c):
        w, width = len(n), c + 1
        col = np.arange(width)
        inside = col < n[:, None]
        s = np.where(inside, sym[np.minimum(start[:, None] + col, len(sym) - 1)], -1)
        alive = inside.copy()
        nxt = np.where(col + 1 < n[:, None], col + 1, -1)
        prv = np.broadcast_to(col - 1, (w, width)).copy()
        tree = np.full((w, 2 * c), NONE, np.int64)
        has = nxt[:, :c] >= 0
        rank = np.full((w, c), NONE, np.int64)
        rank[has] = self.ranks(s[:, :c][has], s[:, 1:c + 1][has])
        tree[:, c:] = np.where(rank == NONE, NONE, rank * c + col[:c])
        level = c
        while level > 1:
            level //= 2
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        flat, fs, fn, fp, fa = tree.reshape(-1), s.reshape(-1), nxt.reshape(-1), prv.reshape(-1), alive.reshape(-1)
        row = np.arange(w)
        while True:
            top = flat[row * (2 * c) + min(1, 2 * c - 1)] if c > 1 else flat[row * 2 + 1]
            go = top < NONE
            if not go.any():
                return alive, s
            row, top = row[go], top[go]
            base, node = row * width, row * (2 * c)
            left = top % c
            right = fn[base + left]
            after = fn[base + right]
            fs[base + left] = self.merged[top // c]
            fa[base + right] = False
            fn[base + left] = after
            more = after >= 0
            fp[base[more] + after[more]] = left[more]
            before = fp[base + left]
            lead = before >= 0
            leaf = np.concatenate([left, right, before[lead]])
            tnode = np.concatenate([node, node, node[lead]])
            val = np.full(len(leaf), NONE, np.int64)
            k = np.flatnonzero(more)
            r = self.ranks(fs[base[k] + left[k]], fs[base[k] + after[k]])
            val[k] = np.where(r == NONE, NONE, r * c + left[k])
            b, l_, p = base[lead], left[lead], before[lead]
            r = self.ranks(fs[b + p], fs[b + l_])
            val[2 * len(left):] = np.where(r == NONE, NONE, r * c + p)
            ok = leaf < c
            at, tnode = leaf[ok] + c, tnode[ok]
            flat[tnode + at] = val[ok]
            while len(at) and at[0] > 1:
                at = at >> 1
                child = tnode + 2 * at
                flat[tnode + at] = np.minimum(flat[child], flat[child + 1])

    def _merge_one(self, sym: list[int], c: int):
        n, none = len(sym), int(NONE)
        rank, merged = self.rank_of.get, self.merged
        tree = [none] * (2 * c)
        for j in range(n - 1):
            r = rank((sym[j], sym[j + 1]))
            if r is not None:
                tree[c + j] = r * c + j
        for k in range(c - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        nxt, prv, alive = list(range(1, n)) + [-1], list(range(-1, n - 1)), [True] * n

        def put(j: int, v: int) -> None:
            k = c + j
            tree[k] = v
            while k > 1:
                k >>= 1
                v = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == v:
                    break
                tree[k] = v

        while tree[1] < none:
            r, j = divmod(tree[1], c)
            right = nxt[j]
            after = nxt[right]
            sym[j] = int(merged[r])
            alive[right] = False
            nxt[j] = after
            if right < c:
                put(right, none)
            new = rank((sym[j], sym[after])) if after >= 0 else None
            if after >= 0:
                prv[after] = j
            put(j, none if new is None else new * c + j)
            p = prv[j]
            if p >= 0:
                new = rank((sym[p], sym[j]))
                put(p, none if new is None else new * c + p)
        return np.array([alive]), np.array([sym], np.int64)

    # ------------------------------------------------------------ decoding

    def decode_ids(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids end to end."""
        n = self.bytes_len[ids]
        first = np.cumsum(n) - n
        return self.bytes_all[np.repeat(self.bytes_at[ids] - first, n) + np.arange(int(n.sum()))]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


class Encoded:
    """Distinct pre-tokens encoded so far; forgotten when there are too many, or too long ones."""

    def __init__(self, model: Merges):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.known = PT.Known()
        self.ids = np.empty(1 << 16, np.uint32)
        self.at = np.empty(1 << 16, np.int64)
        self.n = np.empty(1 << 16, np.int64)
        self.used = 0

    def slots(self, tokens: PT.Tokens) -> np.ndarray:
        """Slot of each distinct pre-token of the batch."""
        if len(self.known) and (len(self.known) + len(tokens) > KEEP or self.known.chars > KEEP_CHARS):
            self._clear()
        base = len(self.known)
        slot, new = self.known.numbers(tokens)
        if len(new):
            words = tokens.strings(new)
            special = tokens.cps[tokens.first[new]].astype(np.int64) - PT.SPECIAL
            plain = np.flatnonzero(special < 0)
            n = np.ones(len(new), np.int64)
            ids, n[plain] = self.model.encode_words([words[k].encode() for k in plain.tolist()]) if len(plain) else (np.empty(0, np.uint32), n[plain])
            at = np.cumsum(n) - n
            flat = np.empty(int(n.sum()), np.uint32)
            own = np.repeat(special >= 0, n)
            flat[~own] = ids
            flat[own] = [self.model.special_ids[k] for k in special[special >= 0].tolist()]
            self.ids = _room(self.ids, self.used + len(flat))
            self.ids[self.used:self.used + len(flat)] = flat
            self.at, self.n = _room(self.at, base + len(new)), _room(self.n, base + len(new))
            self.at[slot[new]], self.n[slot[new]] = self.used + at, n
            self.used += len(flat)
        return slot


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if len(a) >= n:
        return a
    out = np.empty(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


@lru_cache(maxsize=2)
def _encoded(path: str) -> Encoded:
    model = merges(path)
    if model.layout != BYTE_LEVEL:
        raise ValueError(f"{path} normalises or splits texts in another way than byte-level vocabularies: {model.layout}")
    return Encoded(model)


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte-level ids of all texts end to end, and the end of each text among them."""
    memory = _encoded(path)
    tokens = PT.Tokens(texts, PT.byte_level_starts, memory.model.specials)
    if not len(tokens.word):
        return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
    slot = memory.slots(tokens)[tokens.word]
    n = memory.n[slot]
    end = np.cumsum(n)
    ids = memory.ids[np.repeat(memory.at[slot] - (end - n), n) + np.arange(int(end[-1]))]
    per_text = np.bincount(tokens.text, weights=n, minlength=len(texts)).astype(np.int64)
    return ids, np.cumsum(per_text)


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of slices of ``values`` (ends count its items)."""
    size = values.dtype.itemsize
    offsets = np.r_[0, ends * size].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``ids`` (little-endian unsigned 32-bit), one row per row of ``df``."""
    rows = pick(df, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            ids, ends = encode_texts(texts_of(b), path)
            yield out_batch(id=b.column("id"), ids=_binaries(ids, ends))

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(settled(run), f"id {id_type}, ids binary")


def decode(df: DataFrame, path: str) -> DataFrame:
    """Adds ``text`` to a frame of ``id``, ``ids``; bytes that are no UTF-8 become U+FFFD."""
    rows = pick(df, id="id", ids="ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(path)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                each = [np.frombuffer(x or b"", np.uint32) for x in part.column("ids").to_pylist()]
                flat = np.concatenate(each)
                raw = model.decode_ids(flat).tobytes()
                size = np.r_[0, np.cumsum(model.bytes_len[flat])]
                ends = size[np.cumsum([len(x) for x in each])]
                cuts = zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())
                yield out_batch(id=part.column("id"), ids=part.column("ids"),
                                text=pa.array([raw[s:e].decode("utf-8", "replace") for s, e in cuts], pa.string()))

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(settled(run), f"id {id_type}, ids binary, text string")
