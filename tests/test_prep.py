from pyspark.sql import functions as F

from errlens.operators import prep as P
from errlens.plans import fixtures as fx


def test_hash_split_disjoint_covering_and_layout_free(spark, sf_small):
    li = fx.table(spark, sf_small, "lineitem")
    keys = fx.SPLIT_KEYS
    train, test = P.hash_split(li, keys, (0.8, 0.2), seed=42)
    n, a, b = li.count(), train.count(), test.count()
    assert a + b == n and a > b > 0
    assert train.join(test, keys + ["l_quantity"], "inner").count() == 0
    # the same rows after a different partitioning
    other = P.hash_split(li.repartition(7, "l_partkey"), keys, (0.8, 0.2), seed=42)[1]
    assert sorted(map(tuple, test.select(keys).collect())) == sorted(map(tuple, other.select(keys).collect()))


def test_holdout_is_test_part(spark, sf_small):
    li = fx.table(spark, sf_small, "lineitem")
    test = P.hash_split(li, fx.SPLIT_KEYS, (0.8, 0.2), seed=42)[1]
    hold = P.holdout(li, fx.SPLIT_KEYS, 0.2, seed=42)
    assert test.exceptAll(hold).count() == 0 and hold.exceptAll(test).count() == 0


def test_three_way_split(spark, sf_small):
    li = fx.table(spark, sf_small, "lineitem")
    parts = P.hash_split(li, fx.SPLIT_KEYS, (0.6, 0.2, 0.2), seed=1)
    assert sum(p.count() for p in parts) == li.count()


def test_hash_sample_fraction_and_independent_seed(spark, sf_small):
    li = fx.table(spark, sf_small, "lineitem")
    s = P.hash_sample(li, fx.SPLIT_KEYS, 0.3, seed=7)
    frac = s.count() / li.count()
    assert 0.25 < frac < 0.35
    # sampling with another seed than the split keeps the split proportions
    test_in_sample = P.holdout(s, fx.SPLIT_KEYS, 0.2, seed=42).count() / s.count()
    assert 0.15 < test_in_sample < 0.25


def test_with_label_null_options(spark):
    df = spark.createDataFrame([(1,), (None,), (4,)], "stress int")
    assert [r.label for r in P.with_label(df).collect()] == [0, 1, 1]
    assert P.with_label(df, null_label="drop").count() == 2


def test_bernoulli_and_random_split(spark, sf_small):
    o = fx.obs(spark, sf_small)
    n = o.count()
    assert 0.2 < P.bernoulli_sample(o, 0.3, 42).count() / n < 0.4
    a, b = P.random_split(o, (0.8, 0.2), 42)
    assert a.count() + b.count() == n


def test_split_part_matches_hash_split(spark, sf_small):
    li = fx.table(spark, sf_small, "lineitem")
    w, names = (0.6, 0.25, 0.15), ("a", "b", "c")
    parts = P.hash_split(li, fx.SPLIT_KEYS, w, seed=3)
    labelled = li.withColumn("part", P.split_part(fx.SPLIT_KEYS, w, names, seed=3))
    for name, part in zip(names, parts):
        assert labelled.filter(F.col("part") == name).drop("part").exceptAll(part).count() == 0
        assert labelled.filter(F.col("part") == name).count() == part.count()


def test_sample_and_split_with_one_seed_are_independent(spark, sf_small):
    li = fx.table(spark, sf_small, "lineitem")
    for seed in (7, 42):
        s = P.hash_sample(li, fx.SPLIT_KEYS, 0.3, seed)
        assert 0.15 < P.holdout(s, fx.SPLIT_KEYS, 0.2, seed).count() / s.count() < 0.25


def test_fine_fractions(spark):
    df = spark.range(200_000)
    n = P.hash_sample(df, ["id"], 0.00004).count()
    assert 0 < n < 30
    a, b = P.hash_split(df, ["id"], (0.99996, 0.00004))
    assert a.count() + b.count() == 200_000 and 0 < b.count() < 30


def test_buckets_refuse_shares_they_do_not_have(spark):
    import pytest
    with pytest.raises(ValueError):
        P.hash_sample(spark.range(3), [], 0.00004, bucket_col="id")
