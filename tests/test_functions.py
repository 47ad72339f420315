import hashlib

from pyspark.sql import functions as F

from errlens.functions import columns as C


def test_binarize_null_is_one(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "stress int")
    got = [r[0] for r in df.select(C.binarize("stress", 2)).collect()]
    assert got == [0, 0, 1, 1]
    assert df.select(C.binarize("stress").alias("l")).schema["l"].nullable is False


def test_correct_null_prediction(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (1, None)], "label int, prediction double")
    assert [r[0] for r in df.select(C.correct()).collect()] == [1, 0, None]


def test_month_key_and_label(spark):
    df = spark.createDataFrame([(20200301,), (20221231,)], "day int")
    rows = df.select(C.month_key("day").alias("m")).select("m", C.month_label("m").alias("l")).collect()
    assert [(r.m, r.l) for r in rows] == [("202003", "2020-03"), ("202212", "2022-12")]


def test_stable_bucket_matches_python_md5(spark):
    df = spark.createDataFrame([(5979, 1616, 79, 3), (1, 2, 3, 4)], "a long, b long, c long, d int")
    got = [r[0] for r in df.select(C.stable_bucket(["a", "b", "c", "d"], 42)).collect()]
    want = [int(hashlib.md5(f"{a}:{b}:{c}:{d}:42".encode()).hexdigest()[:8], 16) % 10000
            for a, b, c, d in [(5979, 1616, 79, 3), (1, 2, 3, 4)]]
    assert got == want


def test_probability_helpers(spark):
    df = spark.createDataFrame([(0.2,), (0.9,)], "p1 double").select(
        C.vector_column(1 - F.col("p1"), "p1").alias("probability"))
    rows = df.select(C.class_probability("probability", 1).alias("p"),
                     C.confidence("probability").alias("c")).collect()
    assert [round(r.p, 12) for r in rows] == [0.2, 0.9]
    assert [round(r.c, 12) for r in rows] == [0.8, 0.9]
    dec = spark.createDataFrame([(0.5,), (0.51,)], "p double").select(C.threshold_decision("p")).collect()
    assert [r[0] for r in dec] == [0, 1]


def test_coerce_numeric_bad_values_null(spark):
    df = spark.createDataFrame([("1.5",), ("Importance",), (None,), ("2",)], "s string")
    assert [r[0] for r in df.select(C.coerce_numeric("s")).collect()] == [1.5, None, None, 2.0]


def test_percent_and_short_id(spark):
    df = spark.createDataFrame([("4228abcdef", 0.1488)], "uid string, acc double")
    r = df.select(C.short_id("uid").alias("s"), C.percent_text("acc", 2).alias("p")).first()
    assert (r.s, r.p) == ("4228...", "14.88%")


def test_param_value_both_spellings(spark):
    df = spark.createDataFrame([("Trees:10, Depth:3",), ("T:50, D:6",), ("Depth:3, Iter:25",), ("D:6, I:10",)],
                               "params string")
    rows = df.select(C.param_value("params", ["Trees", "T"]).alias("t"),
                     C.param_value("params", ["Depth", "D"]).alias("d"),
                     C.param_value("params", ["Iter", "I"]).alias("i")).collect()
    assert [tuple(r) for r in rows] == [(10, 3, None), (50, 6, None), (None, 3, 25), (None, 6, 10)]
