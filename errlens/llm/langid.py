"""Language identification (operator 4).

Method: averaged hashed subword embeddings with a linear softmax.  Byte
n-grams (2, 3 and 4 bytes of the lower-cased text, white space runs as one
blank) are hashed to ``BUCKETS`` rows of an embedding; a text is the mean
of its rows, and a linear softmax gives the languages.  Embeddings and
softmax are trained together by stochastic gradient descent in numpy.  The
model is linear after the mean, so for scoring embeddings and softmax fold
into one table of logits per bucket, summed over whole texts.

Calibration: one temperature, and a rejection threshold, both from training
rows that the descent did not see; ``rejected`` marks texts whose score is
below the score that all but ``REJECT`` of the right ones reach.

Training sample: at most ``SAMPLE`` documents per language and ``TOTAL`` in
all (the smallest hashes of the id), each whole.  The tasks turn a text into
its grams; of a text with more than ``GRAMS`` of them that many are drawn
over the whole text, so the driver holds at most ``TOTAL * GRAMS`` numbers
of two bytes.  This bounds fitting only; every text is scored whole.

Cases: a null text or one without a letter is ``und`` with score 0; null
languages are no training rows; with no training row every text is ``und``;
ids may be null or repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from errlens.llm.common import out_batch, pick, stored, text_batches, texts_of

SAMPLE = 1500               # training documents of a language
TOTAL = 30_000              # of all languages together, one of each at least
GRAMS = 4096                # grams of a training document
BITS = 15
BUCKETS = 1 << BITS
WIDTH = 16
REJECT = 0.01
UNKNOWN = "und"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    table: np.ndarray | None = None         # [bucket, language] logits
    bias: np.ndarray | None = None
    temperature: float = 1.0
    threshold: float = 0.0


def grams(data: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3 and 4 bytes: places where a gram starts that stays within its text, and the buckets."""
    x = data.astype(np.uint32)
    n = len(x)
    room = np.repeat(ends, np.diff(np.r_[0, ends])) - np.arange(n)
    a = np.concatenate([x, np.zeros(3, np.uint32)])
    value, out = a[:n], []
    for size, factor in ((2, 2654435761), (3, 2246822519), (4, 3266489917)):
        value = (value << np.uint32(8)) | a[size - 1:n + size - 1]
        at = np.flatnonzero(room >= size)
        out.append((at, (value[at] * np.uint32(factor)) >> np.uint32(32 - BITS)))
    return out


def grams_of(text: bytes) -> np.ndarray:
    """Buckets of all grams of one text (one blank before it; an empty text has the blank's own bucket)."""
    g = np.concatenate([k for _, k in grams(*fold([text]))])
    return g if len(g) else np.zeros(1, np.uint32)


def fold(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of all texts end to end, each after one blank, runs of blanks as one; and each text's end."""
    raw = _FOLD[np.frombuffer(b" " + b" ".join(texts), np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    keep[np.r_[0, ends[:-1]]] = True
    return raw[keep], np.cumsum(keep)[ends - 1]


def train(gram: list[np.ndarray], y: np.ndarray, langs: list[str], epochs: int = 4, rate: float = 0.5, seed: int = 3) -> Model:
    """Model from the gram buckets of texts and their languages (indices of ``langs``)."""
    rng = np.random.default_rng(seed)
    k = len(langs)
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    w, b = rng.normal(0, 0.1, (WIDTH, k)), np.zeros(k)
    held = np.arange(len(gram)) % 5 == 0 if len(gram) >= 50 else np.zeros(len(gram), bool)
    rows = np.flatnonzero(~held)
    balance = len(rows) / (k * np.maximum(np.bincount(y[rows], minlength=k), 1))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(rows):
            g = gram[i]
            g = g[rng.integers(0, len(g), min(len(g), 400))]
            mean = emb[g].mean(0)
            z = mean @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= step * min(balance[y[i]], 5.0)
            back = w @ p
            w -= np.outer(mean, p)
            b -= p
            np.subtract.at(emb, g, back * (16.0 / len(g)))      # rows of a mean get small gradients: scaled steps
    model = Model(langs, np.asfortranarray(emb @ w), b)
    check = np.flatnonzero(held) if held.any() else rows
    z = np.stack([model.table[gram[i]].mean(0) + b for i in check]) if len(check) else np.zeros((0, k))
    if len(check):
        def loss(t: float) -> float:
            s = z / t
            s -= s.max(1, keepdims=True)
            return float(-(s[np.arange(len(s)), y[check]] - np.log(np.exp(s).sum(1))).mean())
        model.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=loss)
        p = softmax(z / model.temperature)
        right = p.max(1)[p.argmax(1) == y[check]]
        model.threshold = float(np.quantile(right, REJECT)) if len(right) else 0.0
    return model


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def score(model: Model, texts: list[str]) -> np.ndarray:
    """Probabilities [text, language]."""
    data, ends = fold([t.encode() for t in texts])
    total, count = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    for at, bucket in grams(data, ends):
        text = np.searchsorted(ends, at, "right")
        first = np.flatnonzero(np.r_[True, np.diff(text) > 0]) if len(at) else at
        own = text[first]
        count[own] += np.diff(np.r_[first, len(at)])
        for k in range(len(model.langs)):
            total[own, k] += np.add.reduceat(model.table[:, k][bucket], first) if len(at) else 0
    mean = total / np.maximum(count, 1)[:, None]
    return softmax((mean + model.bias) / model.temperature)


def fit(docs: DataFrame, is_train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on rows with a language for which ``is_train`` (a condition on ``id``) holds."""
    rows = (pick(docs, id=id_col, text=text_col, lang=lang_col).filter("text IS NOT NULL AND lang IS NOT NULL").filter(is_train)
            .withColumn("h", F.xxhash64("id")))
    total = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    n_langs = total.count()
    if not n_langs:
        return Model()
    each = max(1, min(SAMPLE, TOTAL // n_langs))
    # one scan of the texts for all languages: rows with one of the smallest hashes, about four times as many as wanted
    share = F.least(F.lit(1.0), 4 * each / F.col("n")) * F.lit(2.0 ** 64) - F.lit(2.0 ** 63)
    near = rows.join(total.select("lang", share.alias("upto")), "lang").filter(F.col("h") <= F.col("upto"))
    first = Window.partitionBy("lang").orderBy("h", "id", F.xxhash64("text"))
    some = near.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= each).select("lang", "k", "text")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            out = []
            for t in texts_of(b):
                g = grams_of(t.encode())
                if len(g) > GRAMS:
                    g = g[np.sort(np.random.default_rng(len(g)).choice(len(g), GRAMS, replace=False))]
                out.append(g.astype(np.uint16).tobytes())
            yield out_batch(lang=b.column("lang"), k=b.column("k"), grams=pa.array(out, pa.binary()))

    found = some.mapInArrow(buckets, "lang string, k int, grams binary").toArrow().sort_by([("lang", "ascending"), ("k", "ascending")])
    langs = sorted(set(found.column("lang").to_pylist()))
    at = {v: k for k, v in enumerate(langs)}
    order = np.random.default_rng(1).permutation(found.num_rows)
    sample, own = found.column("grams").to_pylist(), found.column("lang").to_pylist()
    return train([np.frombuffer(sample[i], np.uint16) for i in order], np.array([at[own[i]] for i in order]), langs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score``, ``rejected``, one row per row of ``docs``."""
    rows = pick(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, 1 << 19):
            texts = texts_of(b)
            letters = np.array([any(map(str.isalpha, t)) for t in texts])
            if model.langs:
                p = score(model, texts)
                top = np.where(letters, p.max(1), 0.0)
                lang = [model.langs[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1).tolist(), letters.tolist())]
            else:
                top, lang = np.zeros(len(texts)), [UNKNOWN] * len(texts)
            yield out_batch(id=b.column("id"), lang_pred=lang, score=top, rejected=top < model.threshold)

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double, rejected boolean")
