"""Part files with different columns, and lines that do not parse."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from errlens.sources import merged as MG
from errlens.sources import readers as RD
from errlens.sources import writers as WR


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_added_widened_and_missing_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    add(spark, path, [(1, 1.5, "x", Decimal("1.25"))], "a int, b float, c string, e decimal(5,2)")
    add(spark, path, [(2 ** 40, 2.5, True, Decimal("12345678.125"))], "a long, b double, d boolean, e decimal(11,3)")
    add(spark, path, [("y", 3)], "c string, a short")
    df = MG.read_merged(spark, path)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "decimal(11,3)"}
    got = sorted(tuple(r[c] for c in "abcde") for r in df.collect())
    assert got == [(1, 1.5, "x", None, Decimal("1.250")), (3, None, "y", None, None), (2 ** 40, 2.5, None, True, Decimal("12345678.125"))]
    assert sum(r["files"] for r in MG.file_schemas(spark, path).collect()) == 3


def test_impossible_pair_names_both_files(spark, tmp_path):
    path = str(tmp_path / "t")
    add(spark, path, [(1,)], "a int")
    add(spark, path, [("x",)], "a string")
    with pytest.raises(MG.SchemaConflict, match=r"column 'a' is (int|string) in .*part-.*parquet and (int|string) in .*part-.*parquet"):
        MG.read_merged(spark, path)


def test_partitioned_and_replaced_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "model string, v int")
    WR.write_predictions(df, path, ["v"], ["model"])
    assert sorted(map(tuple, MG.read_merged(spark, path).select("model", "v").collect())) == [("a", 1), ("b", 2)]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        MG.read_merged(spark, str(tmp_path / "none"))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    add(spark, path, [(1, 1.5)], "a int, b float")
    add(spark, path, [(2, 2.5)], "a long, b double")
    plan = MG.read_merged(spark, path).filter("a > 1").select("a")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a), GreaterThan(a,1)]" in plan and "ReadSchema: struct<a:bigint>" in plan


@pytest.mark.parametrize("a, b, both", [
    (T.ByteType(), T.LongType(), T.LongType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()), (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (T.LongType(), T.DoubleType(), None), (T.IntegerType(), T.FloatType(), None), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
    (T.IntegerType(), T.DecimalType(5, 2), T.DecimalType(12, 2)), (T.DecimalType(38, 0), T.DecimalType(10, 4), None),
    (T.StringType(), T.IntegerType(), None), (T.DecimalType(5, 2), T.DecimalType(7, 1), T.DecimalType(8, 2))])
def test_widening(a, b, both):
    assert MG.wider(a, b) == both == MG.wider(b, a)


CSV = '''id,name,score
1,"a, b",1.5
2,c,x
three,d,2.5
4,e
5,f,3.5,more

6,,
x,"g",y
7,"h ""q""",4
'''


def test_lines_that_do_not_parse_are_set_apart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.csv").write_text(CSV)
    (folder / "two.csv").write_text("id,name,score\n8,i,5\n,,bad\n")
    good, bad = RD.split_csv(spark, str(folder), "score DOUBLE, id INT", str(tmp_path / "out"))
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1.5, 1), (None, 6), (4.0, 7), (5.0, 8)], key=repr)
    assert sorted((r["file"].rpartition("/")[2], r["line"], r["reason"]) for r in bad.collect()) == sorted([
        ("one.csv", "2,c,x", "score is no double"), ("one.csv", "three,d,2.5", "id is no int"), ("one.csv", "4,e", "not 3 fields"),
        ("one.csv", "5,f,3.5,more", "not 3 fields"), ("one.csv", 'x,"g",y', "id is no int; score is no double"), ("two.csv", ",,bad", "score is no double")])
    assert good.count() + bad.count() == 10            # all lines but two headers and an empty one
    with pytest.raises(ValueError):
        RD.split_csv(spark, str(folder), "other INT", str(tmp_path / "out"))


def test_a_clean_file_has_an_empty_quarantine(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2\n")
    good, bad = RD.split_csv(spark, str(tmp_path / "in.csv"), "a INT, b INT", str(tmp_path / "out"))
    assert [tuple(r) for r in good.collect()] == [(1, 2)] and bad.count() == 0
