"""Label, sample and split.

The stable forms (``hash_sample``, ``hash_split``, ``holdout``) compare a
32-bit hash of each row's own key values with a share of the hash range, so
they are narrow (no shuffle), reproducible under any partitioning, and the
training job and a later scoring job agree on which rows were held out.
Samples and splits hash with a purpose of their own, so a split of a sample
is independent of it under any seeds.  With ``bucket_col`` an existing
bucket in ``[0, BUCKETS)`` decides instead.  The Spark-native
``bernoulli_sample`` / ``random_split`` are kept for parity with code that
uses ``sample`` / ``randomSplit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errlens.functions.columns import HASH_RANGE, binarize, stable_bucket, stable_hash

BUCKETS = 10_000


def with_label(df: DataFrame, source: str = "stress", threshold: float = 2,
               out: str = "label", null_label: str = "one") -> DataFrame:
    """Add a binary label (``source <= threshold`` → 0, else 1).

    ``null_label='one'`` keeps the rule as is (a null source becomes 1);
    ``'drop'`` removes rows whose source is null.
    """
    if null_label == "drop":
        df = df.filter(F.col(source).isNotNull())
    elif null_label != "one":
        raise ValueError("null_label must be 'one' or 'drop'")
    return df.withColumn(out, binarize(source, threshold))


def with_bucket(df: DataFrame, keys: Sequence[str], seed: int = 42, out: str = "bucket") -> DataFrame:
    return df.withColumn(out, stable_bucket(list(keys), seed, BUCKETS))


def _position(keys: Sequence[str], seed: int, purpose: str, bucket_col: str | None) -> tuple[Column, int]:
    """What places a row, and the size of its range."""
    if bucket_col:
        return F.col(bucket_col), BUCKETS
    return stable_hash(list(keys), seed, purpose), HASH_RANGE


def _edge(share: float, size: int) -> int:
    """The place below which a share of the range lies; buckets must have such a place."""
    at = share * size
    if size == BUCKETS and abs(at - round(at)) > 1e-6:
        raise ValueError(f"{BUCKETS} buckets have no share of {share}; hash the keys instead")
    return int(round(at))


def _bounds(weights: Sequence[float], size: int) -> list[int]:
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    acc, out = 0.0, [0]
    for w in weights:
        acc += w / total
        out.append(_edge(acc, size))
    out[-1] = size
    return out


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2),
               seed: int = 42, bucket_col: str | None = None) -> list[DataFrame]:
    """Disjoint parts covering all rows, one per weight.

    With ``bucket_col`` an existing bucket column is used instead of
    hashing ``keys``.
    """
    b, size = _position(keys, seed, "split", bucket_col)
    edges = _bounds(weights, size)
    parts = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        # omit the always-true bounds so the hash is evaluated once per filter
        cond = [c for c in ((b >= lo) if lo > 0 else None, (b < hi) if hi < size else None)
                if c is not None]
        parts.append(df.filter(cond[0] & cond[1]) if len(cond) == 2 else
                     df.filter(cond[0]) if cond else df)
    return parts


def split_part(keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2),
               names: Sequence[str] = ("train", "test"), seed: int = 42,
               bucket_col: str | None = None) -> Column:
    """The name of the ``hash_split`` part each row falls in, as a column.

    Same bounds as :func:`hash_split`; lets one pass handle every part
    (e.g. ``groupBy(split_part(...))``) instead of one filtered scan per part.
    """
    if len(names) != len(weights):
        raise ValueError("one name per weight")
    b, size = _position(keys, seed, "split", bucket_col)
    edges = _bounds(weights, size)
    expr = F.lit(names[-1])
    for name, hi in reversed(list(zip(names[:-1], edges[1:-1]))):
        expr = F.when(b < hi, F.lit(name)).otherwise(expr)
    return expr


def holdout(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
            bucket_col: str | None = None) -> DataFrame:
    """The test part of ``hash_split(df, keys, (1-f, f), seed)``, re-selected
    from the full table without keeping the training part."""
    return hash_split(df, keys, (1 - test_fraction, test_fraction), seed, bucket_col)[1]


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42,
                bucket_col: str | None = None) -> DataFrame:
    """Rows whose stable hash lies below ``fraction`` of its range.

    The exact rows are fixed by content, not by partition layout.
    """
    b, size = _position(keys, seed, "sample", bucket_col)
    return df.filter(b < F.lit(_edge(fraction, size)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's seeded Bernoulli sample without replacement (approximate size;
    rows depend on the input layout)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's ``randomSplit`` (disjoint, covering; layout-dependent)."""
    return df.randomSplit(list(weights), seed)
