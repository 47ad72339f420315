"""Toxic spans and document scores (operator 3).

Method: a linear-chain conditional random field over the words of a text,
with two tags (other, toxic).

* Training sample: at most ``SAMPLE`` toxic and ``SAMPLE`` clean documents
  (the smallest hashes of the id), with their whole texts.  This bounds
  fitting only; executors read the texts, and the driver gets the lexicon,
  labelled windows and features of the sample.
* Labelled tokens: a word is labelled toxic if it stands in a toxic
  document and one of its forms (the word, its 4 and 5 letter openings) is
  strongly tied to toxic documents; all other words are labelled other.
* Weights of forms and tag transitions are fitted on windows of labelled
  tokens by stochastic gradient steps on the conditional likelihood, with
  forward-backward expectations, in numpy.
* Scoring: forward-backward over the whole chain of every text.  Words
  without a weighted form add only the bias, so a stretch of k such words
  is the k-th power of one 2x2 matrix and only the other words are visited;
  the marginals are those of the full chain.
* The marginals of a text (largest, expected number, share of words) make
  the document score through a logistic fit on the sample, and spans are
  runs of words with a marginal of one half or more, with character offsets.

Cases: null and empty texts, and texts without words, get the score of a
text without toxic words; rows with a null label are no training rows;
with no toxic or no clean training row every score is that class's share
(0 if there are no rows at all); ids may be null or repeat; texts of any
length are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errlens.llm.common import low_hashes, out_batch, pick, settled, stored, text_batches, texts_of

SAMPLE = 2500               # training documents of each class, at most
WINDOW = 21                 # labelled tokens of a training window
HITS = 8                    # windows of a training text around words of the lexicon
CHANCE = -11.0              # log of the chance above which a form is no sign
KEEP = 300_000              # distinct words whose weight a worker remembers
WORD = re.compile(r"[^\W\d_]+")


def forms(word: str) -> tuple[str, ...]:
    return ("w:" + word, "4:" + word[:4], "5:" + word[:5])


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    trans: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])
    doc: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0, 0.0])
    constant: float | None = None


# ---------------------------------------------------------------- fitting

def minima(words: list[str]) -> list[int]:
    """Minima of the hashed 3-word shingles of a text under several salts."""
    h = np.array([zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))], np.uint64)
    return [int((h * np.uint64(salt) % np.uint64(4294967291)).min()) for salt in (2654435761, 2246822519, 3266489917, 668265263, 374761393, 1640531527)]


def families(docs: list[list[int]]) -> list[int]:
    """Copies and near copies of the sample in one family: shared ``minima``."""
    parent = list(range(len(docs)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    first: dict[tuple, int] = {}
    for k, low in enumerate(docs):
        for key in enumerate(low):
            parent[root(k)] = root(first.setdefault(key, k))
    return [root(k) for k in range(len(docs))]


def tied(a: int, b: int, n: list[int]) -> bool:
    """Whether a form in ``a`` toxic and ``b`` clean of ``n`` (clean, toxic) families is tied to toxic ones beyond chance."""
    if a < 3 or a / n[1] <= 8 * b / n[0]:
        return False
    share = n[1] / sum(n)
    # log of the chance that a of a + b documents are toxic
    return lgamma(a + b + 1) - lgamma(a + 1) - lgamma(b + 1) + a * np.log(share) + b * np.log(1 - share) < CHANCE


def lexicon(docs: list[tuple[list[str], int]]) -> set[str]:
    """Forms that stand in more toxic documents, and fewer clean ones, than chance gives.

    Counted once per family of near copies, which share their rare words.
    """
    members: tuple[dict[int, set[str]], dict[int, set[str]]] = ({}, {})
    for (words, y), f in zip(docs, families([minima(w) for w, _ in docs])):
        members[y].setdefault(f, set()).update(x for w in set(words) for x in forms(w))
    seen = [Counter(x for forms_ in m.values() for x in forms_) for m in members]
    return {f for f, a in seen[1].items() if tied(a, seen[0][f], [len(m) for m in members])}


def sample_lexicon(train: DataFrame, family: dict[int, int], n: list[int]) -> list[str]:
    """``lexicon`` of the stored sample, counted over whole texts by Spark; only the forms reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            seen = {(x, y, family[k]) for k, y, t in zip(b.column("k").to_pylist(), b.column("y").to_pylist(), texts_of(b))
                    for w in set(words_of(t)) for x in forms(w)}
            if seen:
                form, y, f = zip(*seen)
                yield out_batch(form=form, y=np.array(y, np.int32), family=np.array(f, np.int64))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([tied(a, c, n) for a, c in zip(b.column("a").to_pylist(), b.column("b").to_pylist())], pa.bool_())).select(["form"])

    counts = (train.select("k", "y", "text").mapInArrow(settled(run), "form string, y int, family long").distinct()
              .groupBy("form").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b")).filter("a >= 3"))
    return sorted(r["form"] for r in counts.mapInArrow(keep, "form string").collect())


def chain(emission: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals [s, t, tag] and pair expectations [s, a, b] of windows with emissions [s, t, tag]."""
    s, t, _ = emission.shape
    e, m = np.exp(emission), np.exp(trans)
    fwd, bwd = np.empty((t, s, 2)), np.ones((t, s, 2))
    fwd[0] = e[:, 0]
    fwd[0] /= fwd[0].sum(1, keepdims=True)
    for k in range(1, t):
        fwd[k] = (fwd[k - 1] @ m) * e[:, k]
        fwd[k] /= fwd[k].sum(1, keepdims=True)
    for k in range(t - 2, -1, -1):
        bwd[k] = (bwd[k + 1] * e[:, k + 1]) @ m.T
        bwd[k] /= bwd[k].sum(1, keepdims=True)
    marginal = fwd * bwd
    marginal /= marginal.sum(2, keepdims=True)
    pairs = np.zeros((s, 2, 2))
    for k in range(t - 1):
        x = fwd[k][:, :, None] * m * (bwd[k + 1] * e[:, k + 1])[:, None, :]
        pairs += x / x.sum((1, 2), keepdims=True)
    return marginal.transpose(1, 0, 2), pairs


def windows_of(words: list[str], index: dict[str, int], seed: int) -> list[list[list[int]]]:
    """Windows of a text, around its words with a form of ``index`` and two words by chance: the forms at each place.

    Of more than ``HITS`` such words, that many are drawn over the whole text.
    """
    own = {w: [index[f] for f in forms(w) if f in index] for w in set(words)}
    hits = [k for k, w in enumerate(words) if own[w]]
    rng = np.random.default_rng((7, seed))
    if len(hits) > HITS:
        hits = sorted(rng.choice(hits, HITS, replace=False).tolist())
    out = []
    for c in [*hits, *(rng.integers(0, len(words), 2) if words else [])]:
        a = max(0, min(int(c) - WINDOW // 2, len(words) - WINDOW))
        part = [own[w] for w in words[a:a + WINDOW]]
        out.append(part + [[]] * (WINDOW - len(part)))
    return out


def fit_tagger(names: list[str], windows: list[tuple[list[list[int]], int]], rounds: int = 30, rate: float = 0.3, seed: int = 7) -> Model:
    """CRF weights of the forms ``names`` from windows and the classes of their texts."""
    rng = np.random.default_rng(seed)
    cells = [(row, k, f) for row, (part, _) in enumerate(windows) for k, fs in enumerate(part) for f in fs]
    tags = [[int(bool(fs) and y == 1) for fs in part] for part, y in windows]
    model = Model(bias=-4.0)
    if not windows:
        return model
    y = np.array(tags)
    cell = np.array(cells, np.int64).reshape(-1, 3)
    cell = cell[np.argsort(cell[:, 0], kind="stable")]
    w, bias, trans = np.zeros(len(names)), -4.0, np.zeros((2, 2))
    grow = [np.full(len(names), 1e-6), 1e-6, np.full((2, 2), 1e-6)]
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 256):
            rows = np.sort(order[k:k + 256])
            own = cell[np.isin(cell[:, 0], rows)]
            at = np.searchsorted(rows, own[:, 0])
            emission = np.zeros((len(rows), WINDOW, 2))
            emission[:, :, 1] = bias
            np.add.at(emission, (at, own[:, 1], 1), w[own[:, 2]])
            marginal, pairs = chain(emission, trans)
            miss = y[rows] - marginal[:, :, 1]
            gw = np.zeros(len(names))
            np.add.at(gw, own[:, 2], miss[at, own[:, 1]])
            gw = gw / len(rows) - 1e-4 * w
            gb = miss.sum() / len(rows)
            real = np.zeros((2, 2))
            np.add.at(real, (y[rows][:, :-1], y[rows][:, 1:]), 1)
            gt = (real - pairs.sum(0)) / len(rows)
            gt[0, 0] = 0
            grow[0] += gw * gw
            grow[1] += gb * gb
            grow[2] += gt * gt
            w += rate * gw / np.sqrt(grow[0])
            bias += rate * gb / np.sqrt(grow[1])
            trans += rate * gt / np.sqrt(grow[2])
    model.weights = {f: float(w[k]) for k, f in enumerate(names)}
    model.bias, model.trans = float(bias), trans.tolist()
    return model


def fit_documents(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400, penalty: float = 1e-2) -> np.ndarray:
    """Weighted logistic fit by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (y - p)) - penalty * b
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + (penalty + 1e-6) * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


# ---------------------------------------------------------------- tagging

class Tagger:
    """Marginals of whole texts under a model."""

    def __init__(self, model: Model):
        self.model = model
        self.step = np.exp(np.array(model.trans) + np.array([0.0, model.bias]))
        self.powers = [np.eye(2)]
        while len(self.powers) < 4096:                   # long stretches: the direction has settled
            p = self.powers[-1] @ self.step
            self.powers.append(p / p.sum())
            if np.abs(self.powers[-1] - self.powers[-2]).max() < 1e-15:
                break
        self.known: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        get = self.model.weights.get
        w = get("w:" + word, 0.0) + get("4:" + word[:4], 0.0) + get("5:" + word[:5], 0.0)
        if len(self.known) >= KEEP:
            self.known.clear()
        self.known[word] = w
        return w

    def _gap(self, k: int) -> np.ndarray:
        return self.powers[min(k, len(self.powers) - 1)]

    def marginals(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        """Words with a weight, and the probability of the toxic tag at each."""
        known, weigh = self.known.get, self._weight
        at, weight = [], []
        for k, w in enumerate(map(known, words)):
            if w is None:
                w = weigh(words[k])
            if w:
                at.append(k)
                weight.append(w)
        n = len(at)
        if not n:
            return at, np.empty(0)
        # a step into word k multiplies by trans, bias and the word's own weight
        fwd = np.empty((n, 2))
        state, last = np.array([1.0, np.exp(self.model.bias)]), 0
        for j, k in enumerate(at):
            state = state @ self._gap(k - last)
            state = state * [1.0, np.exp(min(weight[j], 50.0))]
            state /= state.sum()
            fwd[j], last = state, k
        bwd = np.empty((n, 2))
        state, last = np.ones(2), len(words) - 1
        for j in range(n - 1, -1, -1):
            state = self._gap(last - at[j]) @ state
            state /= state.sum()
            bwd[j], last = state, at[j]
            state = state * [1.0, np.exp(min(weight[j], 50.0))]
        both = fwd * bwd
        return at, both[:, 1] / both.sum(1)

    def features(self, words: list[str], p: np.ndarray) -> list[float]:
        return [1.0, float(p.max(initial=0)), float(np.log1p(p.sum())), float(p.sum() / max(len(words), 1)) * 10]

    def score(self, x: list[float]) -> float:
        if self.model.constant is not None:
            return self.model.constant
        return float(1 / (1 + np.exp(-np.clip(np.dot(x, self.model.doc), -30, 30))))

    def spans(self, text: str, at: list[int], p: np.ndarray) -> list[tuple[int, int, float]]:
        """Character offsets and mean probability of runs of toxic words."""
        hot = {k: float(v) for k, v in zip(at, p) if v >= 0.5}
        if not hot:
            return []
        out: list[list] = []
        last = max(hot)
        # lower case may change the length of a text, so offsets come from the text as it is
        for k, m in enumerate(WORD.finditer(text)):
            if k > last:
                break
            if k in hot:
                if out and out[-1][3] == k - 1:
                    out[-1][1], out[-1][3] = m.end(), k
                    out[-1][2].append(hot[k])
                else:
                    out.append([m.start(), m.end(), [hot[k]], k])
        return [(s, e, sum(v) / len(v)) for s, e, v, _ in out]


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)] if not text.isascii() else WORD.findall(text.lower())


def fit(docs: DataFrame, labels: DataFrame, is_train: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Fit on labelled rows for which ``is_train`` (a condition on ``id``) holds."""
    marked = (pick(labels, id=id_col, y=label_col).filter("id IS NOT NULL AND y IS NOT NULL").filter(is_train)
              .groupBy("id").agg(F.max("y").cast("int").alias("y")))
    total = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = pick(docs, id=id_col, text=text_col)
    some = None
    for y in (0, 1):
        few = marked.filter((F.col("y") == y) & low_hashes("id", total.get(y, 0), SAMPLE)).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        some = few if some is None else some.union(few)
    rows = texts.join(F.broadcast(some), "id").select(F.col("y").cast("boolean").cast("int").alias("y"), F.coalesce("text", F.lit("")).alias("text"))
    # the whole texts of at most 2 * SAMPLE ids, which the driver never holds; k names a row
    train = stored(rows.withColumn("k", F.monotonically_increasing_id()).withColumn("h", F.xxhash64("text")), "toxicity-sample")

    def low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            yield out_batch(k=b.column("k"), y=b.column("y"), low=pa.array([minima(words_of(t)) for t in texts_of(b)], pa.list_(pa.int64())))

    sample = train.select("k", "y", "text").mapInArrow(low, "k long, y int, low array<long>").collect()
    n = Counter(r["y"] for r in sample)
    if not n[0] or not n[1]:
        return Model(constant=float(bool(n[1])))
    family = dict(zip((r["k"] for r in sample), families([r["low"] for r in sample])))
    names = sample_lexicon(train, family, [len({family[r["k"]] for r in sample if r["y"] == c}) for c in (0, 1)])
    index = {f: k for k, f in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            found = [windows_of(words_of(t), index, h % (1 << 64)) for t, h in zip(texts_of(b), b.column("h").to_pylist())]
            yield out_batch(h=b.column("h"), y=b.column("y"), windows=pa.array(found, pa.list_(pa.list_(pa.list_(pa.int32())))))

    parts = train.select("h", "y", "text").mapInArrow(cut, "h long, y int, windows array<array<array<int>>>").collect()
    parts.sort(key=lambda r: (r["h"], r["y"]))                          # the fit does not depend on the order of rows
    model = fit_tagger(names, [(w, r["y"]) for r in parts for w in r["windows"]])
    del parts

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in text_batches(batches):
            words = [words_of(t) for t in texts_of(b)]
            yield out_batch(h=b.column("h"), y=b.column("y"), x=pa.array([tagger.features(w, tagger.marginals(w)[1]) for w in words], pa.list_(pa.float64())))

    scored = sorted(train.select("h", "y", "text").mapInArrow(weigh, "h long, y int, x array<double>").collect(), key=lambda r: (r["h"], r["y"]))
    x = np.array([r["x"] for r in scored])
    y = np.array([r["y"] for r in scored], float)
    share = {c: total.get(c, 0) / max(n[c], 1) for c in (0, 1)}        # the classes' shares of all training rows
    weight = np.where(y == 1, share[1], share[0])
    model.doc = fit_documents(x, y, weight / weight.mean()).tolist()
    return model


def tag(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``score`` and ``spans`` (start, end, probability), one row per row of ``docs``.

    ``columns`` names columns of ``docs`` that stay with their rows.
    """
    own = {f"x{k}": c for k, c in enumerate(columns)}
    rows = pick(docs, id=id_col, text=text_col, **own)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in text_batches(batches):
            score, spans = [], []
            for t in texts_of(b):
                words = words_of(t)
                at, p = tagger.marginals(words)
                score.append(tagger.score(tagger.features(words, p)))
                spans.append([dict(zip(("start", "end", "p"), s)) for s in tagger.spans(t, at, p)])
            yield out_batch(id=b.column("id"), score=score, spans=pa.array(spans, pa.list_(span)), **{x: b.column(x) for x in own})

    kind = {n: rows.schema[n].dataType.simpleString() for n in ("id", *own)}
    more = "".join(f", {x} {kind[x]}" for x in own)
    return (rows.mapInArrow(settled(run), f"id {kind['id']}, score double, spans array<struct<start:int,end:int,p:double>>{more}")
            .withColumnsRenamed(own))
