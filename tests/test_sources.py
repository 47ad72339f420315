import pytest
from pyspark.errors import AnalysisException

from errlens.session import scratch_path
from errlens.sources import readers as RD
from errlens.sources import writers as WR


def test_read_optional_missing_gives_none(spark):
    assert RD.read_optional(RD.read_parquet, spark, "/tmp/errlens-does-not-exist-xyz") is None


def test_read_optional_other_errors_raise(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    with pytest.raises(AnalysisException):
        RD.read_optional(lambda: RD.read_parquet(spark, path).select("nope"))


def test_single_csv_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = scratch_path(spark, "single")
    WR.write_single_csv(df, path)
    back = RD.read_csv(spark, path, schema="k INT, v STRING")
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    assert back.rdd.getNumPartitions() == 1
    inferred = RD.read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["k"] == "int"


def test_headerless_named_by_position(spark):
    df = spark.createDataFrame([("202003", 0.5, 10)], "m string, a double, n long")
    path = scratch_path(spark, "hl")
    WR.write_csv_headerless(df, path)
    back = RD.read_csv_headerless(spark, path, ["month", "accuracy", "samples"])
    r = back.first()
    assert (r.month, r.accuracy, r.samples) == ("202003", "0.5", "10")


def test_predictions_partitioned_by_model(spark):
    df = spark.createDataFrame([("RF", "u", 1, 1, 1.0), ("GBT", "u", 1, 0, 1.0)],
                               "model string, uid string, day int, label int, prediction double")
    path = scratch_path(spark, "pred")
    WR.write_predictions(df, path, columns=("uid", "day", "label", "prediction"), partition_by=["model"])
    back = RD.read_parquet(spark, path)
    assert back.filter("model = 'GBT'").count() == 1
    assert set(back.columns) == {"model", "uid", "day", "label", "prediction"}


def test_parquet_folder_with_stray_file_falls_back_to_parts(spark):
    import os
    path = scratch_path(spark, "stray")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    with open(os.path.join(path, "notes.txt"), "w") as f:
        f.write("not parquet")
    back = RD.read_parquet(spark, path)
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(AnalysisException):
        RD.read_parquet(spark, "/tmp/errlens-no-such-folder-abc")


# Golden rows of the stored monthly accuracy table (headerless CSV), as
# printed in FIXTURES.md §3 (fixed values).
MONTHLY_ROWS = ["202003,0.6496268325626793,101429",
                "202004,0.7217763666611993,170708",
                "202204,0.6727472584993065,38209"]


def test_golden_monthly_table_reads_typed(spark):
    """The stored monthly table read by position with its types: every
    accuracy × samples is a whole number of correct rows, and the
    count-weighted accuracy of the rows equals correct ÷ samples."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from errlens.functions.columns import month_label
    path = scratch_path(spark, "golden_monthly")
    spark.createDataFrame([(r,) for r in MONTHLY_ROWS], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("month", T.StringType()), T.StructField("accuracy", T.DoubleType()),
                           T.StructField("samples", T.LongType())])
    back = RD.read_csv_headerless(spark, path, schema)
    rows = back.select("month", month_label("month").alias("label"), "accuracy", "samples",
                       (F.col("accuracy") * F.col("samples")).alias("correct")).orderBy("month").collect()
    assert [(r.month, r.label, r.samples) for r in rows] == [
        ("202003", "2020-03", 101429), ("202004", "2020-04", 170708), ("202204", "2022-04", 38209)]
    assert all(abs(r.correct - round(r.correct)) < 1e-6 for r in rows)
    total = back.agg((F.sum(F.col("accuracy") * F.col("samples")) / F.sum("samples")).alias("a")).first().a
    assert total == pytest.approx((65891 + 123213 + 25705) / (101429 + 170708 + 38209), rel=1e-12)


def _csv(spark, name, text):
    import os
    path = scratch_path(spark, name)
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(text)
    return path


def test_csv_columns_are_matched_by_name(spark):
    path = _csv(spark, "named", "day,note,uid,stress\n20200301,x,u1,3.0\n20200302,,u2,\n")
    back = RD.read_csv(spark, path, schema="uid STRING, day INT, stress DOUBLE")
    assert back.columns == ["uid", "day", "stress"]
    assert sorted(map(tuple, back.collect())) == [("u1", 20200301, 3.0), ("u2", 20200302, None)]
    from errlens.operators import prep as P
    assert sorted((r.uid, r.label) for r in P.with_label(back).collect()) == [("u1", 1), ("u2", 1)]


def test_observation_schema_takes_decimal_cells(spark):
    head = "stress,race,gender,covid_total,daily_steps,sleep_duration,social_level,phq4_score,day,uid,extra"
    path = _csv(spark, "obs", head + "\n1.0,a,F,0,100,7.5,2,3,20200301,u1,z\n4.0,b,M,1,50,6,1,,20200302,u2,z\n")
    rows = RD.read_csv(spark, path, schema=RD.OBSERVATION_SCHEMA).collect()
    assert sorted((r.uid, r.stress, r.sleep_duration, r.phq4_score) for r in rows) == [("u1", 1.0, 7.5, 3.0), ("u2", 4.0, 6.0, None)]


def test_csv_missing_column_is_an_error(spark):
    path = _csv(spark, "missing", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="nope"):
        RD.read_csv(spark, path, schema="a INT, nope INT")


def test_csv_cells_that_do_not_parse(spark):
    path = _csv(spark, "cells", "a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        RD.read_csv(spark, path, schema="a INT, b INT").collect()
    back = RD.read_csv(spark, path, schema="a INT, b INT", mode="PERMISSIVE").collect()
    assert sorted(map(tuple, back), key=repr) == [(1, 2), (None, 3)]


def test_csv_files_with_another_header_are_refused(spark):
    import os
    path = _csv(spark, "headers", "a,b\n1,2\n")
    with open(os.path.join(path, "b.csv"), "w") as f:
        f.write("b,a\n1,2\n")
    with pytest.raises(Exception):
        RD.read_csv(spark, path, schema="a INT, b INT").collect()


def test_scratch_folders_are_removed(spark):
    import os
    from errlens.session import clear_scratch
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file://")
    assert os.path.isdir(local)
    clear_scratch(spark)
    assert not os.path.isdir(local)


def test_the_callers_settings_survive(spark):
    from errlens.session import get_session
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        again = get_session()
        assert again.conf.get("spark.sql.shuffle.partitions") == "5" and again.sparkContext.master == spark.sparkContext.master
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
