"""Column-level building blocks.

Each function takes and returns :class:`pyspark.sql.Column` objects (or
column names) so it composes inside ``select``/``withColumn`` and stays in
whole-stage codegen.  No Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binarize(col: ColumnOrName, threshold: float = 2) -> Column:
    """Ordinal → binary label: ``col <= threshold`` gives 0, anything else 1.

    A null input is not ``<= threshold`` and therefore becomes 1; the result
    is a non-null int.
    """
    return F.when(_c(col) <= F.lit(threshold), F.lit(0)).otherwise(F.lit(1))


def correct(label: ColumnOrName = "label", prediction: ColumnOrName = "prediction") -> Column:
    """``CAST(label = prediction AS INT)``; null when either side is null."""
    return (_c(label) == _c(prediction)).cast("int")


def month_key(day: ColumnOrName) -> Column:
    """``yyyyMMdd`` (int or string) → ``yyyyMM`` string (first six characters)."""
    return F.substring(_c(day).cast("string"), 1, 6)


def month_label(month: ColumnOrName) -> Column:
    """``yyyyMM`` → ``yyyy-MM``: split after the fourth character."""
    m = _c(month).cast("string")
    return F.concat(F.substr(m, F.lit(1), F.lit(4)), F.lit("-"), F.substr(m, F.lit(5)))


def stable_bucket(keys: list[ColumnOrName], seed: int = 42, modulus: int = 10000) -> Column:
    """Deterministic bucket in ``[0, modulus)`` from row content.

    ``md5("k1:k2:...:seed")``, first 8 hex digits as an integer, mod
    ``modulus``.  It depends only on the row's own values, so a split made
    with it is the same for any input partitioning and in any engine that
    has md5 (unlike ``randomSplit``, which depends on partition layout).
    """
    text = F.concat_ws(":", *[_c(k).cast("string") for k in keys], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(modulus))


HASH_RANGE = 1 << 32


def stable_hash(keys: list[ColumnOrName], seed: int = 42, purpose: str = "") -> Column:
    """Deterministic 32-bit value from row content.

    ``md5("k1:k2:...:seed:purpose")``, first 8 hex digits as an integer.
    Different purposes (a sample, a split) give unrelated values of the same
    row and seed.
    """
    text = F.concat_ws(":", *[_c(k).cast("string") for k in keys], F.lit(str(seed)), F.lit(purpose))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def vector_column(*cols: ColumnOrName) -> Column:
    """Dense ML vector from numeric columns (JVM-side)."""
    return array_to_vector(F.array(*[_c(c).cast("double") for c in cols]))


def class_probability(probability: ColumnOrName = "probability", cls: int = 1) -> Column:
    """Probability of one class out of an ML probability vector."""
    return vector_to_array(_c(probability)).getItem(cls)


def confidence(probability: ColumnOrName = "probability") -> Column:
    """Confidence of a prediction = the largest class probability."""
    return F.array_max(vector_to_array(_c(probability)))


def threshold_decision(p1: ColumnOrName, threshold: float = 0.5) -> Column:
    """Class 1 when the class-1 probability is above the threshold, else 0."""
    return F.when(_c(p1) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def coerce_numeric(col: ColumnOrName) -> Column:
    """String → double; values that are not numbers become null."""
    return _c(col).try_cast("double")


def percent_text(fraction: ColumnOrName, decimals: int = 1) -> Column:
    """``0.1234`` → ``'12.3%'`` (``decimals`` digits after the point)."""
    return F.format_string(f"%.{decimals}f%%", (_c(fraction) * F.lit(100.0)).cast("double"))


def short_id(col: ColumnOrName, n: int = 4, suffix: str = "...") -> Column:
    """First ``n`` characters followed by ``suffix``."""
    return F.concat(F.substring(_c(col), 1, n), F.lit(suffix))


def param_value(params: ColumnOrName, names: list[str]) -> Column:
    """Integer value of a named parameter in ``'Name:12, Other:3'`` text.

    ``names`` lists the spellings of one parameter (``['Trees', 'T']``).  A
    missing parameter gives null.
    """
    alt = "|".join(names)
    text = F.regexp_extract(_c(params), f"(?:^|[ ,])(?:{alt}):([0-9]+)", 1)
    return F.when(text == "", F.lit(None).cast("int")).otherwise(text.cast("int"))
