import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from errlens.operators.features import FeatureSpec, fit_features

ROWS = [
    ("u1", 20200301, 1, 2.0, 3.0, 7.5, 8000.0, 0.0, "F", "A"),
    ("u1", 20200302, 2, 3.0, 3.0, 6.0, 5000.0, 1.0, "F", "A"),
    ("u2", 20200401, 3, 5.0, 2.0, 5.5, 3000.0, 4.0, "M", "B"),
    ("u2", 20200402, None, 4.0, 2.0, 6.5, 4000.0, 4.0, "M", "B"),
    ("u3", 20200403, 5, None, 1.0, 4.0, 1000.0, 9.0, "M", "B"),
    ("u4", 20200404, 4, 6.0, 1.0, 5.0, 2000.0, 7.0, "X", None),
]
SCHEMA = ("uid string, day int, stress int, phq4_score double, social_level double, sleep_duration double, "
          "daily_steps double, covid_total double, gender string, race string")
NUMERIC = ("phq4_score", "social_level", "sleep_duration", "daily_steps", "covid_total")


def _spec(**kw):
    return FeatureSpec(numeric=NUMERIC, categorical=("gender", "race"), **kw)


def test_unseen_and_null_category_get_extra_index(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    train = df.filter(F.col("uid") != "u4").filter(F.col("phq4_score").isNotNull())
    model = fit_features(train, _spec())
    out = model.stages[0].transform(df).select("uid", "gender_index", "race_index").collect()
    by = {r.uid: (r.gender_index, r.race_index) for r in out}
    # F and M: one each 2 rows -> frequency desc, ties alphabetical: F=0, M=1 (2 vs 2 rows in train)
    assert by["u1"][0] == 0.0 and by["u2"][0] == 1.0
    assert by["u4"] == (2.0, 2.0)    # unseen 'X' and null race -> n


def test_assembler_invalid_modes(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).filter(F.col("uid") != "u4")
    with pytest.raises(Exception):
        fit_features(df, _spec()).transform(df).count()
    assert fit_features(df, _spec(assemble_invalid="skip")).transform(df).count() == 4
    kept = fit_features(df, _spec(assemble_invalid="keep")).transform(df)
    assert kept.count() == 5


def test_scale_is_divide_by_sample_std_and_zero_std_gives_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    spec = FeatureSpec(numeric=("a", "b"))
    out = fit_features(df, spec).transform(df).select(vector_to_array("scaledFeatures").alias("v")).collect()
    import statistics
    sd = statistics.stdev([1.0, 2.0, 4.0])
    assert [round(r.v[0], 12) for r in out] == [round(x / sd, 12) for x in (1.0, 2.0, 4.0)]
    assert [r.v[1] for r in out] == [0.0, 0.0, 0.0]


def test_counted_rows_fit_the_stages_of_every_copy(spark):
    """Labels and deviations from distinct rows with their copies are those of a fit on all rows."""
    rows = [(2.0, 1e6 + 1, "F", 3), (3.5, 1e6 + 2, "M", 2), (3.5, 1e6 + 9, None, 40), (7.25, 1e6, "M", 1), (-1.0, 1e6, "X", 5)]
    df = spark.createDataFrame(rows, "a double, b double, c string, n long").withColumn("one", F.lit(4.0))
    spec = FeatureSpec(numeric=("a", "b", "one"), categorical=("c",))
    every = df.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n", "col")
    got, want = fit_features(df, spec, "n"), fit_features(every, spec)
    assert [list(m.stages[0].labelsArray[0]) for m in (got, want)] == [["X", "F", "M"]] * 2
    assert got.stages[-1].std.toArray() == pytest.approx(want.stages[-1].std.toArray(), rel=1e-9)
    assert got.stages[-1].mean.toArray() == pytest.approx(want.stages[-1].mean.toArray(), rel=1e-12)
    a, b = (sorted(r[0] for r in m.transform(df).select(vector_to_array(spec.scaled_col)).collect()) for m in (got, want))
    assert [x for r in a for x in r] == pytest.approx([x for r in b for x in r], rel=1e-9)


def test_counted_rows_that_are_one_row_have_no_deviation(spark):
    df = spark.createDataFrame([(2.0, 7)], "a double, n long")
    assert fit_features(df, FeatureSpec(numeric=("a",)), "n").stages[-1].std.toArray().tolist() == [0.0]
