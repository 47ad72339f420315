"""Fixture views over the driver's ``lineitem`` table.

``obs`` has the shape of the observation table (user, day, ordinal target,
five numeric and two categorical features) so every operator runs on the
given data; ``scored`` replaces a trained model by a fixed rule so that
evaluation operators have an SQL-computable answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.functions.columns import binarize, stable_bucket, vector_column
from errlens.operators.features import FeatureSpec

SEED = 42
TEST_FROM = 8000  # buckets 8000..9999 are the 20 % hold-out

SPLIT_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
OBS_COLUMNS = ["uid", "day", "stress", "f1", "f2", "f3", "f4", "f5", "gender", "race", "bucket"]
# Sort order of the canonical training layout (every column of obs, the
# integer bucket first).  ``train.prepare`` lays out only the columns the
# model sees, so it keeps the feature columns of this list in this order.
LAYOUT_KEYS = ["bucket", "day", "stress", "f1", "f2", "f3", "f4", "f5", "gender", "race", "uid"]
NUMERIC = ("f1", "f2", "f3", "f4", "f5")
CATEGORICAL = ("gender", "race")
SPEC = FeatureSpec(numeric=NUMERIC, categorical=CATEGORICAL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation-shaped view of ``lineitem`` (see FIXTURES.md §6)."""
    return obs_from_lineitem(table(spark, sf_dir, "lineitem"))


def obs_from_lineitem(li: DataFrame) -> DataFrame:
    """Row-wise derivation of ``obs``; works on a batch or a streaming frame."""
    return li.select(
        F.md5(F.col("l_suppkey").cast("string")).alias("uid"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("day"),
        F.least(F.lit(5), F.floor((F.col("l_quantity") - 1) / 10).cast("int") + 1).alias("stress"),
        F.col("l_quantity").alias("f1"), F.col("l_extendedprice").alias("f2"),
        F.col("l_discount").alias("f3"), F.col("l_tax").alias("f4"),
        F.col("l_linenumber").cast("double").alias("f5"),
        F.col("l_linestatus").alias("gender"), F.col("l_returnflag").alias("race"),
        stable_bucket(SPLIT_KEYS, SEED).alias("bucket"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` with a label whose rule differs between the parts.

    Training rows have ``stress <= 2`` as class 0, hold-out rows
    ``stress <= 3``.  A model that learned the training rows is right on the
    hold-out exactly where both rules agree, which SQL can work out and
    which is not all rows; one that saw hold-out rows is right elsewhere.
    """
    label = F.when(F.col("bucket") < TEST_FROM, binarize("stress", 2)).otherwise(binarize("stress", 3))
    return obs(spark, sf_dir).withColumn("label", label)


# Rules of the staged grid: class 1 above the first number up to the second
# and above the third, another rule for each part.
BANDS = {"train": (8, 20, 33), "validation": (8, 20, 30), "test": (10, 20, 33)}
THREE_PARTS = (0.6, 0.2, 0.2)


def banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` in three parts with a label in bands of ``f1``.

    One stump, one tree of depth two and many stumps get different shares of
    the bands right, so the accuracies of a grid differ; the rules of the
    parts differ too, so a model that saw another part is right elsewhere.
    """
    f1, bucket = F.col("f1"), F.col("bucket")

    def rule(a: int, b: int, c: int):
        return F.when((f1 > c) | ((f1 > a) & (f1 <= b)), 1).otherwise(0)

    label = (F.when(bucket < 6000, rule(*BANDS["train"])).when(bucket < TEST_FROM, rule(*BANDS["validation"]))
             .otherwise(rule(*BANDS["test"])))
    return obs(spark, sf_dir).withColumn("label", label)


def noisy(spark: SparkSession, sf_dir: str, share: float = 0.1) -> DataFrame:
    """``obs`` with ``stress <= 2`` as class 0 and a fixed share of labels flipped by content (bench)."""
    flip = stable_bucket(["uid", "day", "f1", "f2", "f3", "f4", "f5"], 5) < F.lit(int(share * 10_000))
    rule = binarize("stress", 2)
    return obs(spark, sf_dir).withColumn("label", F.when(flip, 1 - rule).otherwise(rule))


def scored(spark: SparkSession, sf_dir: str, holdout: bool = True) -> DataFrame:
    """Rows (the hold-out, or all) scored by a fixed rule: ``p1 = f1 / 51``, class 1 above 0.5."""
    o = obs(spark, sf_dir)
    if holdout:
        o = o.filter(F.col("bucket") >= TEST_FROM)
    p1 = F.col("f1") / 51
    return o.select("uid", "day", "race",
                    binarize("stress", 2).alias("label"),
                    F.when(p1 <= 0.5, 0).otherwise(1).cast("double").alias("prediction"),
                    p1.alias("p1"))


def scored_vector(spark: SparkSession, sf_dir: str, holdout: bool = True) -> DataFrame:
    """``scored`` with an ML probability vector ``[1 - p1, p1]``."""
    return scored(spark, sf_dir, holdout).withColumn("probability", vector_column(1 - F.col("p1"), "p1"))


def scored_two(spark: SparkSession, sf_dir: str, holdout: bool = True) -> DataFrame:
    """Two fixed rules as two 'models' in one long table (``model`` first).

    ``rule_a``: p1 = f1/51; ``rule_b``: p1 = f1/41 (threshold 0.5 both).
    """
    o = obs(spark, sf_dir)
    if holdout:
        o = o.filter(F.col("bucket") >= TEST_FROM)
    lab = binarize("stress", 2)
    rows = F.array(*[
        F.struct(F.lit(name).alias("model"), (F.col("f1") / d).alias("p1"))
        for name, d in (("rule_a", 51), ("rule_b", 41))])
    long = o.select("uid", "day", "race", lab.alias("label"), F.inline(rows))
    return long.select("model", "uid", "day", "race", "label",
                       F.when(F.col("p1") <= 0.5, 0).otherwise(1).cast("double").alias("prediction"),
                       "p1")
