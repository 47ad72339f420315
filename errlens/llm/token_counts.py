"""Token counts without ids (operator 7).

Method: the pre-tokens of a batch of texts are sorted by hash, so the
per-document frequencies are (document, distinct pre-token, count) cells;
the pieces of each distinct pre-token are counted once, those counts are
joined to the cells by the pre-token's index, and ``frequency x pieces`` is
summed per document.  No id list is made for any document.  A worker
remembers counted pre-tokens up to a bound, so a pre-token is counted again
only by another worker or after it was forgotten.

Cases: null and empty texts have zero bytes and zero tokens; special
strings in a text count as one token each; a vocabulary file that normalises
or splits in another way is refused; texts of any length are taken
whole; ids may be null or repeat, one output row per input row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errlens.llm import pretokens as PT
from errlens.llm.bpe import Merges, merges
from errlens.llm.common import out_batch, pick, settled, text_batches, texts_of

# How a word-level vocabulary file normalises and splits texts (fixed value).
WORD_LEVEL = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)
KEEP = 500_000              # pre-tokens that a worker remembers
KEEP_CHARS = 1 << 25        # and their characters
_SPACES = regex.compile(r"\p{White_Space}+")


def normalise(text: str) -> str:
    """NFC, runs of white space to one blank, lower case character by character."""
    text = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
    return text.replace("Σ", "σ").lower()   # no word-final sigma: lower case without context


class Counted:
    """Pieces of the distinct pre-tokens seen so far; forgotten when there are too many, or too long ones."""

    def __init__(self, model: Merges):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.known = PT.Known()
        self.pieces = np.empty(0, np.int64)

    def of(self, tokens: PT.Tokens) -> np.ndarray:
        if len(self.known) + len(tokens) > KEEP or self.known.chars > KEEP_CHARS:
            self._clear()
        number, new = self.known.numbers(tokens)
        if len(new):
            n = np.ones(len(new), np.int64)             # special strings
            plain = np.flatnonzero(tokens.cps[tokens.first[new]] < PT.SPECIAL)
            if len(plain):
                n[plain] = self.model.encode_words([w.encode() for w in tokens.strings(new[plain])])[1]
            self.pieces = np.r_[self.pieces, n]
        return self.pieces[number]


@lru_cache(maxsize=2)
def _counted(path: str) -> Counted:
    model = merges(path)
    if model.layout != WORD_LEVEL:
        raise ValueError(f"{path} normalises or splits texts in another way than word-level vocabularies: {model.layout}")
    return Counted(model)


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text under a word-level vocabulary."""
    memory = _counted(path)
    tokens = PT.Tokens(texts, PT.word_level_starts, memory.model.specials, normalise)
    if not len(tokens.word):
        return np.zeros(len(texts), np.int64)
    pieces = memory.of(tokens)
    cell, frequency = np.unique(tokens.text * len(pieces) + tokens.word, return_counts=True)
    doc, word = np.divmod(cell, len(pieces))
    return np.bincount(doc, weights=frequency * pieces[word], minlength=len(texts)).astype(np.int64)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens``."""
    rows = pick(df, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            size = pc.fill_null(pc.binary_length(b.column("text")), 0)
            yield out_batch(id=b.column("id"), n_bytes=size.cast(pa.int64()), n_tokens=count_texts(texts_of(b), path))

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(settled(run), f"id {id_type}, n_bytes long, n_tokens long")


def over(df: DataFrame, limit: int) -> DataFrame:
    return df.withColumn("over_limit", F.col("n_tokens") > limit)
