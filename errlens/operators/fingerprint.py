"""Fingerprints of a split, so that scoring can prove its hold-out is unseen.

A later job selects the hold-out again by keys, seed and share.  With
another seed, other keys or another file it would score training rows as
unseen without a word.  Training therefore saves the number of its rows and
a digest of them; the later job compares before it scores.

The digest is that of a multiset: each row's text (every column with its
length, so no two rows have one text) is hashed with md5 and the hash's four
32-bit lanes are summed.  Order, partitions and files do not matter, copies
count, and the digests of two parts add up to that of their union.

One pass over the input compares.  Rows meet in at most 4 x 4096 groups
(map-side combine) whose sums stay in 64 bits; their totals are decimals, so
no number of rows overflows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.operators.prep import split_part
from errlens.sources.readers import table_from_rows
from errlens.sources.tables import replace, resolve

LANES = 4
_GROUPS = 4096
_SCHEMA = ("keys array<string>, columns array<string>, seed long, test_fraction double, bucket_col string, "
           "rows long, lanes array<decimal(38,0)>")


class SplitMismatch(ValueError):
    """The hold-out asked for is not the one that training left out."""


@dataclass(frozen=True)
class Fingerprint:
    """How a training part was selected, and the count and digest of its rows over ``columns``."""
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    seed: int
    test_fraction: float
    rows: int
    lanes: tuple[int, ...]
    bucket_col: str | None = None

    def in_training(self) -> Column:
        """Whether a row belongs to the training part, by the rule that selected it."""
        return split_part(self.keys, (1 - self.test_fraction, self.test_fraction), ("train", "test"), self.seed, self.bucket_col) == "train"


def row_text(columns: Sequence[str]) -> Column:
    """All columns of a row with their lengths; null is a dash."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat_ws(",", *(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def digests(df: DataFrame, columns: Sequence[str], by: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` and ``lane0`` to ``lane3`` (decimal) of each group ``by``; one row without groups."""
    by = by or {}
    lanes = [f"lane{k}" for k in range(LANES)]
    hashed = df.select(*(c.alias(n) for n, c in by.items()), F.md5(row_text(columns)).alias("_md5"))
    wide = hashed.select(*by, *(F.conv(F.substring("_md5", 8 * k + 1, 8), 16, 10).cast("bigint").alias(n) for k, n in enumerate(lanes)))
    part = (wide.groupBy(*by, F.pmod(F.col("lane0"), F.lit(_GROUPS)).alias("_g"))
            .agg(F.count(F.lit(1)).alias("rows"), *(F.sum(n).alias(n) for n in lanes)))
    zero = F.lit(0)
    return part.groupBy(*by).agg(F.coalesce(F.sum("rows"), zero.cast("bigint")).alias("rows"),
                                 *(F.coalesce(F.sum(F.col(n).cast("decimal(28,0)")), zero.cast("decimal(38,0)")).alias(n) for n in lanes))


def digest_text() -> Column:
    """The lanes of :func:`digests` as one string."""
    return F.concat_ws("-", *(F.col(f"lane{k}").cast("string") for k in range(LANES)))


def fingerprint(train: DataFrame, keys: Sequence[str], columns: Sequence[str] = (), seed: int = 42, test_fraction: float = 0.2,
                bucket_col: str | None = None) -> Fingerprint:
    """Of a training part that was selected by ``keys``, ``seed`` and ``test_fraction``; ``columns`` defaults to the keys."""
    columns = tuple(columns) or tuple(keys)
    r = digests(train, columns).first()
    return Fingerprint(tuple(keys), columns, seed, test_fraction, r["rows"], tuple(int(r[f"lane{k}"]) for k in range(LANES)), bucket_col)


def save(spark: SparkSession, fp: Fingerprint, path: str) -> None:
    from decimal import Decimal
    row = (list(fp.keys), list(fp.columns), fp.seed, fp.test_fraction, fp.bucket_col, fp.rows, [Decimal(x) for x in fp.lanes])
    replace(spark, path, table_from_rows(spark, [row], _SCHEMA).coalesce(1).write.parquet)


def load(spark: SparkSession, path: str) -> Fingerprint:
    r = spark.read.parquet(resolve(spark, path)).first()
    return Fingerprint(tuple(r["keys"]), tuple(r["columns"]), r["seed"], r["test_fraction"], r["rows"], tuple(int(x) for x in r["lanes"]), r["bucket_col"])


def compare(df: DataFrame, fp: Fingerprint, keys: Sequence[str] | None = None, seed: int | None = None,
            test_fraction: float | None = None, bucket_col: str | None = None, whole: bool = True) -> DataFrame:
    """One row: what a hold-out of ``df`` has in common with the training part of ``fp``.

    The hold-out is selected by ``keys``, ``seed`` and ``test_fraction``
    (those of ``fp`` unless given); ``whole=False`` takes ``df`` itself as
    the hold-out.  ``training_rows`` are the rows of ``df`` that the saved
    rule puts into training, ``same_training`` says whether they are the
    rows that were trained on, ``seen`` counts hold-out rows among them and
    ``left_out`` rows that are in neither part.  ``ok``: no row is seen, and
    for a whole input the training rows are the same and none is left out.
    """
    trained = fp.in_training()
    if whole:
        f = fp.test_fraction if test_fraction is None else test_fraction
        held = split_part(keys or fp.keys, (1 - f, f), ("train", "test"), fp.seed if seed is None else seed,
                          bucket_col or (None if keys else fp.bucket_col)) == "test"
    else:
        held = F.lit(True)
    parts = digests(df, fp.columns, {"trained": trained, "held": held})

    def total(c: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0))

    t, h = F.col("trained"), F.col("held")
    same = total("rows", t) == F.lit(fp.rows)
    for k, lane in enumerate(fp.lanes):
        same = same & (total(f"lane{k}", t) == F.lit(str(lane)).cast("decimal(38,0)"))
    found = parts.agg(total("rows", t).cast("bigint").alias("training_rows"), same.alias("same_training"),
                      total("rows", h).cast("bigint").alias("holdout_rows"), total("rows", t & h).cast("bigint").alias("seen"),
                      total("rows", ~t & ~h).cast("bigint").alias("left_out"))
    ok = F.col("seen") == 0
    return found.withColumn("ok", ok & F.col("same_training") & (F.col("left_out") == 0) if whole else ok)


def check(df: DataFrame, fp: Fingerprint, **how) -> None:
    """Raise :class:`SplitMismatch` unless :func:`compare` finds the hold-out unseen and the input unchanged."""
    r = compare(df, fp, **how).first()
    if r["ok"]:
        return
    said = []
    if how.get("whole", True) and not r["same_training"]:
        said.append(f"the input is not the one that was trained on: its training part has {r['training_rows']} rows "
                    f"({'other ones' if r['training_rows'] == fp.rows else f'{fp.rows} were trained on'})")
    if r["seen"]:
        said.append(f"{r['seen']} of {r['holdout_rows']} rows to be scored were trained on")
    if how.get("whole", True) and r["left_out"]:
        said.append(f"{r['left_out']} rows were neither trained on nor are they scored")
    raise SplitMismatch("; ".join(said))
