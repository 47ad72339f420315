"""The distributed string index against MLlib's, and where its rows go."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from errlens.operators import indexing as IX
from errlens.operators.features import FeatureSpec, fit_features
from errlens.plans import fixtures as fx


def labels_of(index, column):
    return [r["label"] for r in index.filter(F.col("column") == column).orderBy("index").collect()]


def test_order_equals_mllib_on_a_million_labels(spark):
    # counts of one to four, so most of the order is decided by the labels
    df = spark.range(2_000_000).select(F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("string")).alias("v"))
    index = IX.fit_index(df, ["v"])
    want = StringIndexer(inputCol="v", outputCol="i").fit(df).labelsArray[0]
    got = index.orderBy("index").select("label", "index").toArrow().to_pydict()
    assert got["label"] == list(want) and len(want) > 800_000
    assert got["index"] == [float(k) for k in range(len(want))]


def mixed(spark, n=3000):
    r = random.Random(4)
    rows = [("hot" if k % 3 == 0 else None if k % 7 == 0 else f"v{r.randint(0, 400)}", r.choice([1, 2, 2, 3, None]), float(k)) for k in range(n)]
    return spark.createDataFrame(rows, "a string, b int, x double")


@pytest.mark.parametrize("heavy", [1, 50, 1024])
def test_applied_equals_mllib(spark, heavy):
    df = mixed(spark)
    index = IX.fit_index(df.filter("x < 2500"), ["a", "b"], partitions=5)
    model = StringIndexer(inputCols=["a", "b"], outputCols=["a_index", "b_index"], handleInvalid="keep").fit(df.filter("x < 2500"))
    got = IX.apply_index(IX.apply_index(df, index, "a", heavy=heavy), index, "b", heavy=heavy)
    assert got.columns == ["a", "b", "x", "a_index", "b_index"]
    assert sorted(map(str, got.collect())) == sorted(map(str, model.transform(df).collect()))


def test_invalid_labels(spark):
    df = mixed(spark, 300)
    index = IX.fit_index(df.filter("x < 100"), ["a"])
    known = {r["label"] for r in index.collect()}
    kept = IX.apply_index(df, index, "a", invalid="skip")
    assert kept.count() == df.filter(F.col("a").isin(*known)).count() < 300
    with pytest.raises(PySparkException):
        IX.apply_index(df, index, "a", invalid="error").collect()
    assert IX.apply_index(df.filter(F.col("a").isin(*known)), index, "a", invalid="error").count() == kept.count()
    with pytest.raises(ValueError):
        IX.apply_index(df, index, "a", invalid="other")


def test_empty_table(spark):
    df = mixed(spark, 10)
    index = IX.fit_index(df.limit(0), ["a"])
    assert index.count() == 0
    assert {r["a_index"] for r in IX.apply_index(df, index, "a").collect()} == {0.0}


def test_index_is_kept_as_a_table(spark, tmp_path):
    df = mixed(spark)
    made = IX.fit_index(df, ["a", "b"], path=str(tmp_path / "index"))
    assert sorted(IX.load_index(spark, str(tmp_path / "index")).collect()) == sorted(made.collect())


def test_hot_label_does_not_move(spark):
    df = mixed(spark)
    index = IX.fit_index(df, ["a"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = IX.apply_index(df, index, "a", heavy=20)
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "Python" not in plan
    keys = out.select(F.count_if(F.col("a") == "hot")).first()[0]
    assert keys >= 1000 and max(sizes) < 2 * sum(sizes) / len(sizes) + 50


def test_features_equal_those_of_the_pipeline(spark, sf_small):
    rows = fx.obs(spark, sf_small)
    train, rest = rows.filter("bucket < 8000 AND race <> 'R'"), rows.filter("bucket >= 8000")
    spec = FeatureSpec(numeric=("f1", "f3"), categorical=("gender", "race"))
    index = IX.fit_index(train, spec.categorical)
    own = IX.indexed_spec(spec)
    a = fit_features(IX.with_indices(train, index, spec), own).transform(IX.with_indices(rest, index, spec))
    b = fit_features(train, spec).transform(rest)
    keep = ("uid", "day", "f2", F.round(F.col("arr")[0], 9), F.round(F.col("arr")[2], 9), F.round(F.col("arr")[3], 9))
    a, b = (sorted(map(tuple, x.withColumn("arr", vector_to_array(spec.scaled_col)).select(*keep).collect())) for x in (a, b))
    assert a == b
