"""Registered queries: one per operator group of the blueprint.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables (through the ``obs``/``scored`` fixture views).  Queries
that write and read back (sinks/sources) run the write as part of building
the DataFrame, into a fresh folder under ``spark.checkpoint.dir``.

Fitted models are memoised per Spark context and input folder, so the
queries that look at the same training run (accuracy, confusion,
round trip, importances) fit it once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errlens.functions import columns as C
from errlens.operators import evaluate as E
from errlens.operators import fingerprint as FP
from errlens.operators import indexing as IX
from errlens.operators import prep as P
from errlens.operators import report as R
from errlens.operators import score as S
from errlens.operators import staged as SG
from errlens.operators import state as ST
from errlens.operators import train as TR
from errlens.operators.asof import asof_join
from errlens.operators.features import FeatureSpec, fit_features
from errlens.plans import fixtures as fx
from errlens.session import scratch_path
from errlens.sources import merged as MG
from errlens.sources import readers as RD
from errlens.sources import tables as TB
from errlens.sources import writers as WR
from errlens.sources import models as MD

# Model configurations of the registered training queries.  ``max_bins`` 64
# covers the 50 distinct quantities of the fixture, so every split point
# between two quantities is a candidate.
RF_FINAL = TR.ModelConfig(TR.RF, depth=6, trees=50, max_bins=64)
GBT_FINAL = TR.ModelConfig(TR.GBT, depth=6, iters=25, max_bins=64)
RF_GRID = TR.rf_grid((10, 50), (3, 6), max_bins=64)
GBT_GRID = TR.gbt_grid((3, 6), (10, 25), max_bins=64)
FLAGSHIP = TR.ModelConfig(TR.GBT, depth=3, iters=10, max_bins=64)
# Least partition count of the canonical training layout of the fixture, and
# the rows above which it has more.  Both fixed, not taken from the session,
# so a fit gives the same model under any session configuration.
LAYOUT_PARTITIONS = 8
LAYOUT_ROWS = 500_000

_memo: dict = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, name)


def _memoised(spark: SparkSession, sf_dir: str, name: str, make: Callable):
    k = _key(spark, sf_dir, name)
    if k not in _memo:
        _memo[k] = make()
    return _memo[k]


def reset() -> None:
    """Drop memoised models and release their cached training inputs."""
    for v in _memo.values():
        if isinstance(v, TR.Prepared):
            v.unpersist()
        elif isinstance(v, DataFrame):
            v.unpersist()
    _memo.clear()


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return P.hash_split(fx.labelled(spark, sf_dir), [], bucket_col="bucket")


def _prepared(spark: SparkSession, sf_dir: str) -> TR.Prepared:
    """Preprocessing fitted on the training part, input cached, layout canonical."""
    def make():
        train, _ = _split(spark, sf_dir)
        return TR.prepare(train, fx.SPEC, layout_keys=fx.LAYOUT_KEYS, layout_partitions=LAYOUT_PARTITIONS, layout_rows=LAYOUT_ROWS)
    return _memoised(spark, sf_dir, "prepared", make)


def _fitted(spark: SparkSession, sf_dir: str, cfg: TR.ModelConfig):
    prepared = _prepared(spark, sf_dir)
    return _memoised(spark, sf_dir, ("fit", cfg),
                     lambda: TR.full_pipeline(prepared, TR.fit_classifier(prepared, cfg, fx.SEED)))


def _test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)[1]


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", C.month_key("day"))


# ---------------------------------------------------------------- flagship

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the stable 80 %, score the 20 % hold-out, accuracy by month."""
    model = _fitted(spark, sf_dir, FLAGSHIP)
    scored = S.score_pipelines(_test(spark, sf_dir), {"GBT": model}, keep=["day", "label"])
    return E.accuracy_by(_with_month(scored), "month", count_col="total_samples", order="keys")


# ---------------------------------------------------------------- sources / sinks

def q_scan_parquet(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    WR.write_predictions(fx.scored_two(spark, sf_dir, holdout=False), path,
                         columns=("uid", "day", "label", "prediction", "p1"), partition_by=["model"])
    back = RD.read_parquet(spark, path)
    return back.groupBy("model", "label").agg(F.count(F.lit(1)).alias("n"),
                                              F.sum("prediction").alias("pred_pos"))


def q_source_guard(spark, sf_dir):
    """Optional sources: those that are there are read, those that are not give no table and no failure."""
    out = None
    for name, read, path in (("nation", RD.read_parquet, f"{sf_dir}/nation.parquet"),
                             ("no_table", RD.read_parquet, f"{sf_dir}/no_such_table.parquet"),
                             ("region_csv", RD.read_csv, _region_csv(spark, sf_dir)),
                             ("no_csv", RD.read_csv, scratch_path(spark, "never_written"))):
        df = RD.read_optional(read, spark, path)
        rows = (spark.range(1).select(F.lit(None).cast("long").alias("n_rows")) if df is None
                else df.agg(F.count(F.lit(1)).alias("n_rows")))
        row = rows.select(F.lit(name).alias("source"), F.lit(df is not None).alias("found"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def _region_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "region_csv")
    fx.table(spark, sf_dir, "region").select("r_regionkey", "r_name").write.option("header", "true").csv(path)
    return path


def q_table_replace(spark, sf_dir):
    """Predictions replaced by a table made from themselves, then by a write that fails: the second table is read."""
    path = scratch_path(spark, "replaced")
    two = fx.scored_two(spark, sf_dir, holdout=False)
    columns = ("uid", "day", "label", "prediction", "p1")
    WR.write_predictions(two, path, columns=columns, partition_by=["model"])
    WR.write_predictions(RD.read_parquet(spark, path).filter("label = 1"), path, columns=columns, partition_by=["model"])
    broken = two.withColumn("label", F.when(F.col("p1") > 0.9, F.raise_error(F.lit("this write fails"))).otherwise(F.col("label")))
    try:
        WR.write_predictions(broken, path, columns=columns, partition_by=["model"])
        failed = False
    except PySparkException:
        failed = True
    version = TB.current(spark, path).version
    back = RD.read_parquet(spark, path)
    return back.groupBy("model", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("pred_pos"),
                                              F.lit(version).alias("version"), F.lit(failed).alias("failed"))


def q_scan_merged(spark, sf_dir):
    """Part files of which one has narrower types, one a further column and one lacks a column."""
    path = scratch_path(spark, "merged")
    li = fx.table(spark, sf_dir, "lineitem")
    for n, part in enumerate((
            li.filter("l_linenumber = 1").select(F.col("l_orderkey").cast("int").alias("k"), F.col("l_quantity").cast("float").alias("q"), F.to_date("l_shipdate").alias("d")),
            li.filter("l_linenumber = 2").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("double").alias("q"), "l_tax"),
            li.filter("l_linenumber > 2").select("l_tax", F.col("l_orderkey").alias("k"), F.col("l_shipdate").cast("timestamp_ntz").alias("d")))):
        part.write.mode("append").parquet(path)
    both = MG.read_merged(spark, path)
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"), F.count("q").alias("n_q"), F.sum("q").alias("q"),
                    F.count("l_tax").alias("n_tax"), F.round(F.sum("l_tax"), 6).alias("tax"), F.count("d").alias("n_d"),
                    F.date_format(F.max("d"), "yyyy-MM-dd").alias("d"),
                    F.concat_ws(",", F.any_value(F.typeof("k")), F.any_value(F.typeof("q")), F.any_value(F.typeof("d"))).alias("types"))


def q_csv_quarantine(spark, sf_dir):
    """Lines with a cell that is no number and lines with a field too many, set apart from those that parse."""
    path, line = scratch_path(spark, "lines"), F.col("l_linenumber")
    q = F.when(line == 3, F.lit("x")).when(line == 5, F.concat(F.col("l_quantity").cast("string"), F.lit(",0"))).otherwise(F.col("l_quantity").cast("string"))
    text = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.when(line == 4, F.lit("four")).otherwise(line.cast("string")), q)
    # one column whose name is the header of three
    (fx.table(spark, sf_dir, "lineitem").select(text.alias("k,n,q")).write.option("header", "true").option("sep", "\t").csv(path))
    good, bad = RD.split_csv(spark, path, "q DOUBLE, k BIGINT, n INT", scratch_path(spark, "split-csv"))
    return (good.groupBy(F.lit("").alias("reason")).agg(F.count(F.lit(1)).alias("lines"), F.sum("k").alias("k"), F.sum("q").alias("q"))
            .unionByName(bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.substring_index("line", ",", 1).cast("bigint")).alias("k"),
                                                   F.lit(None).cast("double").alias("q"))))


def _nation_csv(spark, sf_dir) -> str:
    """A headed file with the columns in another order and one more."""
    path = scratch_path(spark, "nation_csv")
    nation = fx.table(spark, sf_dir, "nation").select("n_name", F.lit("x").alias("note"), "n_regionkey", "n_nationkey")
    WR.write_single_csv(nation, path)
    return path


def q_scan_csv(spark, sf_dir):
    return RD.read_csv(spark, _nation_csv(spark, sf_dir), schema="n_nationkey INT, n_name STRING, n_regionkey INT")


def q_scan_csv_inferred(spark, sf_dir):
    back = RD.read_csv(spark, _nation_csv(spark, sf_dir), infer=True)
    return back.select("n_nationkey", "n_name", "n_regionkey", (F.col("n_nationkey") + 1).alias("next_key"))


def q_scan_csv_headerless(spark, sf_dir):
    path = scratch_path(spark, "monthly_csv")
    monthly = E.accuracy_by(_with_month(fx.scored(spark, sf_dir)), "month",
                            count_col="total_samples", order="keys")
    WR.write_csv_headerless(monthly, path)
    schema = T.StructType([T.StructField("month", T.StringType()),
                           T.StructField("accuracy", T.DoubleType()),
                           T.StructField("samples", T.LongType())])
    return RD.read_csv_headerless(spark, path, schema)


# ---------------------------------------------------------------- label / flags / projections

def q_binarize_label(spark, sf_dir):
    return (P.with_label(fx.obs(spark, sf_dir))
            .groupBy("stress", "label").agg(F.count(F.lit(1)).alias("n")))


def q_binarize_label_null(spark, sf_dir):
    o = fx.obs(spark, sf_dir).withColumn(
        "stress", F.when(F.col("f4") == 0, F.lit(None).cast("int")).otherwise(F.col("stress")))
    return P.with_label(o).groupBy("stress", "label").agg(F.count(F.lit(1)).alias("n"))


def q_correct_flag(spark, sf_dir):
    s = E.with_correct(fx.scored(spark, sf_dir, holdout=False))
    return s.groupBy("label", "prediction", "correct").agg(F.count(F.lit(1)).alias("n"))


def q_accuracy_null_pred(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    p1 = F.col("f1") / 51
    s = o.select(C.binarize("stress").alias("label"),
                 F.when(F.col("f3") == 0, F.lit(None).cast("double"))
                 .otherwise(F.when(p1 <= 0.5, 0).otherwise(1).cast("double")).alias("prediction"))
    return s.agg(F.avg(C.correct()).alias("accuracy"), F.count(F.lit(1)).alias("samples"),
                 F.count("prediction").alias("scored"))


def q_prediction_project(spark, sf_dir):
    return fx.scored(spark, sf_dir, holdout=False).select("uid", "day", "label", "prediction", "p1")


def q_prediction_preview(spark, sf_dir):
    s = fx.scored(spark, sf_dir).select("uid", "day", "p1", "label", "prediction")
    return WR.preview(s, 10, order_by=["uid", "day", "p1", "label", "prediction"])


# ---------------------------------------------------------------- sample / split

def q_sample_hash(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    s = P.hash_sample(li, fx.SPLIT_KEYS, 0.3, seed=7)
    return s.agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
                 F.sum("l_orderkey").alias("sum_orderkey"))


def q_split_hash(spark, sf_dir):
    part = P.split_part(fx.SPLIT_KEYS, (0.8, 0.2), ("train", "test"), bucket_col="bucket")
    return (fx.obs(spark, sf_dir).groupBy(part.alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("f1").alias("sum_f1")))


def q_holdout_hash(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    test = P.holdout(li, fx.SPLIT_KEYS, 0.2, seed=fx.SEED)
    return test.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("l_linenumber").cast("bigint").alias("sum_linenumber"))


def q_sample_fine(spark, sf_dir):
    """A share finer than 1e-4."""
    s = P.hash_sample(fx.table(spark, sf_dir, "lineitem"), fx.SPLIT_KEYS, 0.00375, seed=7)
    return s.agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("sum_orderkey"))


def q_sample_then_split(spark, sf_dir):
    """Sample and split with one seed: the split of the sample keeps its shares."""
    s = P.hash_sample(fx.table(spark, sf_dir, "lineitem"), fx.SPLIT_KEYS, 0.3, seed=fx.SEED)
    part = P.split_part(fx.SPLIT_KEYS, (0.8, 0.2), seed=fx.SEED)
    return s.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("sum_orderkey"))


def q_split_fingerprint(spark, sf_dir):
    """Count and digest of each part of the split, and of all rows."""
    li = fx.table(spark, sf_dir, "lineitem")
    part = P.split_part(fx.SPLIT_KEYS, seed=fx.SEED)
    every = FP.digests(li, fx.SPLIT_KEYS).select(F.lit("all").alias("part"), "rows", FP.digest_text().alias("digest"))
    return FP.digests(li, fx.SPLIT_KEYS, {"part": part}).select("part", "rows", FP.digest_text().alias("digest")).unionByName(every)


def q_split_check(spark, sf_dir):
    """The saved training part against the right hold-out, another seed, a smaller share, and a file that lost rows."""
    li = fx.table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "fingerprint")
    FP.save(spark, FP.fingerprint(P.hash_split(li, fx.SPLIT_KEYS, seed=fx.SEED)[0], fx.SPLIT_KEYS, seed=fx.SEED), path)
    fp = FP.load(spark, path)
    cases = {"same": FP.compare(li, fp), "other seed": FP.compare(li, fp, seed=7), "smaller share": FP.compare(li, fp, test_fraction=0.1),
             "changed file": FP.compare(li.filter("l_linenumber < 7"), fp), "holdout only": FP.compare(P.holdout(li, fx.SPLIT_KEYS, seed=fx.SEED), fp, whole=False)}
    out = None
    for name, row in cases.items():
        row = row.select(F.lit(name).alias("case"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def q_sample_bernoulli(spark, sf_dir):
    """What holds for any seeded sample: a sub-bag of the rows, of about the asked size."""
    o = fx.obs(spark, sf_dir)
    s = P.bernoulli_sample(o, 0.3, seed=fx.SEED)
    total, n = o.agg(F.count(F.lit(1))).scalar(), F.count(F.lit(1))
    extra = s.exceptAll(o).agg(F.count(F.lit(1))).scalar()
    # six standard deviations
    return s.agg(total.alias("n_all"), extra.alias("n_not_in_input"),
                 (F.abs(n - 0.3 * total) <= 6 * F.sqrt(0.21 * total)).alias("size_ok"))


def q_split_random(spark, sf_dir):
    """What holds for any random split: parts that together are the input, of about the asked sizes."""
    o = fx.obs(spark, sf_dir)
    train, test = P.random_split(o, (0.8, 0.2), seed=fx.SEED)
    total, n_test = (x.agg(F.count(F.lit(1))).scalar() for x in (o, test))
    both = train.unionByName(test)
    lost = o.exceptAll(both).agg(F.count(F.lit(1))).scalar()
    return both.agg(F.count(F.lit(1)).alias("n_parts"), lost.alias("n_lost"),
                    (F.abs(n_test - 0.2 * total) <= 6 * F.sqrt(0.16 * total)).alias("size_ok"))


# ---------------------------------------------------------------- month scalars

def q_month_key(spark, sf_dir):
    return _with_month(fx.obs(spark, sf_dir)).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


def q_month_label(spark, sf_dir):
    m = _with_month(fx.obs(spark, sf_dir)).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    return m.select("month", C.month_label("month").alias("month_label"), "n")


# ---------------------------------------------------------------- grouped accuracy

def q_accuracy_by_month(spark, sf_dir):
    return E.accuracy_by(_with_month(fx.scored(spark, sf_dir)), "month",
                         count_col="total_samples", order="keys")


def q_accuracy_by_user(spark, sf_dir):
    return E.accuracy_by(fx.scored(spark, sf_dir), "uid", count_col="samples", order="asc")


def q_accuracy_by_category(spark, sf_dir):
    return E.accuracy_by(fx.scored(spark, sf_dir), "race", count_col=None, order="desc")


def q_accuracy_overall(spark, sf_dir):
    return E.accuracy_overall(fx.scored_two(spark, sf_dir), by="model")


def q_accuracy_grouping_sets(spark, sf_dir):
    return E.accuracy_grouping_sets(_with_month(fx.scored(spark, sf_dir)), ["month", "uid", "race"])


def _kept_state(spark, sf_dir) -> DataFrame:
    """Predictions applied in four parts, out of order, one twice, one with wrong predictions first."""
    rows = _with_month(fx.scored_two(spark, sf_dir)).withColumn("file", F.pmod(F.col("day"), F.lit(4)).cast("string"))
    path, dims = scratch_path(spark, "state"), ["model", "month", "race"]
    wrong = rows.withColumn("prediction", 1 - F.col("prediction"))
    for part in (rows.filter("file = 2"), wrong.filter("file = 3"), rows.filter("file IN (0, 2)"), rows.filter("file = 1"), rows.filter("file = 3")):
        state = ST.update(part, path, dims, "file")
    return ST.fold(spark, path, F.col(ST.SOURCE).isin("0", "1"), "before")


def q_state_accuracy(spark, sf_dir):
    return ST.accuracy_tables(_kept_state(spark, sf_dir), ["month", "race"], by="model")


def q_state_confusion(spark, sf_dir):
    return ST.confusion(_kept_state(spark, sf_dir), by="model")


def q_row_counts(spark, sf_dir):
    return E.row_counts(fx.obs(spark, sf_dir), "bucket", fx.TEST_FROM)


# ---------------------------------------------------------------- confusion / probability

def q_confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(fx.scored_two(spark, sf_dir), by="model")


def q_confusion_pivot(spark, sf_dir):
    return E.confusion_pivot(fx.scored(spark, sf_dir), classes=(0.0, 1.0))


def q_confusion_other(spark, sf_dir):
    """Labels and predictions outside the given classes are counted as others."""
    o = fx.obs(spark, sf_dir)
    three = o.select((F.col("stress") % 3).alias("label"),
                     F.when(F.col("f3") > 0, (F.col("f5") % 4)).alias("prediction"))
    return E.confusion_pivot(three, classes=(0.0, 1.0))


def q_confusion_many_classes(spark, sf_dir):
    """A matrix with over a thousand classes, summed up."""
    li = fx.table(spark, sf_dir, "lineitem")
    m = E.confusion_matrix(li.select((F.col("l_orderkey") % 1100).alias("label"), (F.col("l_partkey") * 7 % 1100).alias("prediction")))
    return m.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("filled"),
                 F.sum(F.col("n") * F.col("actual")).alias("by_actual"), F.sum(F.col("n") * F.col("predicted")).alias("by_predicted"))


def q_evaluator_accuracy(spark, sf_dir):
    value = E.evaluator_accuracy(fx.scored(spark, sf_dir, holdout=False).withColumn("label", F.col("label").cast("double")))
    return RD.table_from_rows(spark, [(value,)], "accuracy DOUBLE")


def q_class1_probability(spark, sf_dir):
    s = fx.scored_vector(spark, sf_dir, holdout=False)
    return s.select("uid", "day", C.class_probability("probability", 1).alias("p_class1"))


def q_confidence_max(spark, sf_dir):
    s = fx.scored_vector(spark, sf_dir, holdout=False)
    return s.select("uid", "day", C.confidence("probability").alias("confidence"))


def q_threshold_decision(spark, sf_dir):
    s = fx.scored_vector(spark, sf_dir, holdout=False)
    d = s.select("label", C.threshold_decision(C.class_probability("probability", 1)).alias("decision"))
    return d.groupBy("label", "decision").agg(F.count(F.lit(1)).alias("n"))


def q_confidence_histogram(spark, sf_dir):
    s = fx.scored_vector(spark, sf_dir).select(C.confidence("probability").alias("confidence"))
    return E.histogram(s, "confidence", bins=30)


def q_probability_kde(spark, sf_dir):
    return E.kde(fx.scored_two(spark, sf_dir), "p1", by="model", grid_size=21, decimals=6)


def _nullable_groups(spark, sf_dir):
    """Scored rows with a group key that is null for some."""
    o = fx.obs(spark, sf_dir)
    return o.select(F.when(F.col("f4") > 0, F.col("gender")).alias("gender"), (F.col("f1") / 51).alias("p1"))


def q_histogram_by_group(spark, sf_dir):
    return E.histogram(_nullable_groups(spark, sf_dir), "p1", bins=30, by="gender")


def q_kde_by_group(spark, sf_dir):
    return E.kde(_nullable_groups(spark, sf_dir), "p1", by="gender", grid_size=21, decimals=6)


def _priced(spark, sf_dir):
    """A value that is nearly all distinct, by a key that is null for some."""
    return fx.obs(spark, sf_dir).select(F.when(F.col("f4") > 0, F.col("race")).alias("race"), (F.col("f2") / 1000).alias("price"))


def q_kde_tolerance(spark, sf_dir):
    """Densities by moments, next to which SQL has the exact ones."""
    return E.kde(_priced(spark, sf_dir), "price", by="race", grid_size=21, decimals=7, tolerance=1e-12)


def q_histogram_distinct(spark, sf_dir):
    """A histogram of nearly all distinct values by group, of which only the counters move."""
    return E.histogram(_priced(spark, sf_dir), "price", bins=30, by="race").select("race", "bin", F.round("bin_lo", 9).alias("bin_lo"), "n")


def q_confidence_overlay(spark, sf_dir):
    """The curve over the confidence histogram: density within the range, scaled to counts."""
    s = fx.scored_vector(spark, sf_dir, holdout=False).select(C.confidence("probability").alias("confidence"))
    return E.kde(s, "confidence", grid_size=21, cut=0.0, counts_bins=30, decimals=4)


# ---------------------------------------------------------------- top-k / reports

def q_worst_users_top10(spark, sf_dir):
    return E.bottom_k(fx.scored(spark, sf_dir), "uid", k=10)


def q_worst_users_report(spark, sf_dir):
    s = fx.scored(spark, sf_dir)
    return R.worst_users_report(E.bottom_k(s, "uid", k=5), E.accuracy_overall(s))


def q_union_predictions(spark, sf_dir):
    two = fx.scored_two(spark, sf_dir, holdout=False)
    a = two.filter(F.col("model") == "rule_a")
    b = two.filter(F.col("model") == "rule_b")
    u = R.experiment_table(a, b)
    return u.groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def q_model_comparison(spark, sf_dir):
    return R.model_comparison(E.accuracy_overall(fx.scored_two(spark, sf_dir, holdout=False), by="model"))


# ---------------------------------------------------------------- featurisation

def q_string_index(spark, sf_dir):
    """Index fitted on training rows without one category, applied to rows with it and with nulls."""
    o = fx.obs(spark, sf_dir)
    train = o.filter((F.col("bucket") < fx.TEST_FROM) & (F.col("race") != "R"))
    rest = o.filter(F.col("bucket") >= fx.TEST_FROM).withColumn("race", F.when(F.col("f4") > 0, F.col("race")))
    model = fit_features(train, FeatureSpec(numeric=(), categorical=("race",)))
    return (model.transform(rest).groupBy(F.col("race").alias("value"), F.col("race_index").alias("index"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_string_index_large(spark, sf_dir):
    """Index of a column with many labels as a table, fitted on training rows, applied to the others."""
    li = fx.table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_tax", fx.stable_bucket(fx.SPLIT_KEYS, fx.SEED).alias("bucket"))
    train = li.filter((F.col("bucket") < fx.TEST_FROM) & (F.col("l_partkey") % 10 != 3))
    rest = li.filter(F.col("bucket") >= fx.TEST_FROM).withColumn("l_partkey", F.when(F.col("l_tax") > 0, F.col("l_partkey")))
    index = IX.fit_index(train, ["l_partkey", "l_returnflag"])
    done = IX.apply_index(IX.apply_index(rest, index, "l_partkey"), index, "l_returnflag")
    return (done.groupBy(F.col("l_partkey").alias("part"), F.col("l_partkey_index").alias("part_index"), F.col("l_returnflag_index").alias("mode_index"))
            .agg(F.count(F.lit(1)).alias("n")))


def _vector(df: DataFrame, spec: FeatureSpec, col: str) -> DataFrame:
    return fit_features(df, spec).transform(df).withColumn("arr", vector_to_array(col))


def q_assemble_features(spark, sf_dir):
    spec = FeatureSpec(numeric=fx.NUMERIC)
    v = _vector(fx.obs(spark, sf_dir), spec, spec.features_col)
    return v.select("uid", "day", *[F.col("arr")[i].alias(f"v{i}") for i in range(len(fx.NUMERIC))])


def q_assemble_skip(spark, sf_dir):
    o = fx.obs(spark, sf_dir).withColumn(
        "f1", F.when(F.col("f4") == 0, F.lit(None).cast("double")).otherwise(F.col("f1")))
    spec = FeatureSpec(numeric=fx.NUMERIC, assemble_invalid="skip")
    v = _vector(o, spec, spec.features_col)
    return v.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("arr")[0]).alias("sum_v0"))


def q_standard_scale(spark, sf_dir):
    spec = FeatureSpec(numeric=fx.NUMERIC)
    v = _vector(fx.obs(spark, sf_dir), spec, spec.scaled_col)
    return v.select("uid", "day", *[F.round(F.col("arr")[i], 6).alias(f"s{i}") for i in range(len(fx.NUMERIC))])


# ---------------------------------------------------------------- training / scoring

def _train_eval(spark, sf_dir, cfg):
    model = _fitted(spark, sf_dir, cfg)
    s = S.score_pipelines(_test(spark, sf_dir), {cfg.kind: model}, keep=["label"])
    return E.confusion_matrix(s, by="model")


def q_rf_train_eval(spark, sf_dir):
    return _train_eval(spark, sf_dir, RF_FINAL)


def q_gbt_train_eval(spark, sf_dir):
    return _train_eval(spark, sf_dir, GBT_FINAL)


def q_score_two_models(spark, sf_dir):
    models = {"RF": _fitted(spark, sf_dir, RF_FINAL), "GBT": _fitted(spark, sf_dir, GBT_FINAL)}
    s = S.score_pipelines(_test(spark, sf_dir), models, keep=["uid", "day", "label"])
    return (s.groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n")))


def q_model_roundtrip(spark, sf_dir):
    """Save the whole fitted pipeline, load it, and score every hold-out row
    with both: the loaded pipeline first, then the original on the same
    row, so the comparison is within each row (no join, no shuffle)."""
    model = _fitted(spark, sf_dir, GBT_FINAL)
    path = scratch_path(spark, "gbt_pipeline")
    MD.save_pipeline(model, path)
    loaded = MD.load_pipeline(path)
    test = _test(spark, sf_dir)
    first = loaded.transform(test).select(*test.columns, F.col("prediction").alias("loaded_prediction"),
                                          F.col("probability").alias("loaded_probability"))
    both = model.transform(first)
    differs = ~(F.col("prediction").eqNullSafe(F.col("loaded_prediction"))
                & (vector_to_array("probability") == vector_to_array("loaded_probability")))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_diff"))


def _side_by_side(configs) -> int:
    """Boosted fits, a row of small jobs each, run side by side, one a depth; a forest's rows fill the memory, so it runs alone."""
    return len({cfg.depth for cfg in configs}) if all(cfg.kind == TR.GBT for cfg in configs) else 1


def _grid(spark, sf_dir, which: str):
    def make():
        train, test = _split(spark, sf_dir)
        configs = RF_GRID if which == "RF" else GBT_GRID
        return TR.run_grid(train, test, fx.SPEC, configs, seed=fx.SEED,
                           prepared=_prepared(spark, sf_dir), prefixes=True, parallelism=_side_by_side(configs)).cache()
    return _memoised(spark, sf_dir, ("grid", which), make)


def q_grid_rf(spark, sf_dir):
    return _grid(spark, sf_dir, "RF").select("model", "params", "accuracy")


def q_grid_gbt(spark, sf_dir):
    return _grid(spark, sf_dir, "GBT").select("model", "params", "accuracy")


def _large_grid(spark, sf_dir, configs):
    train, test = _split(spark, sf_dir)
    return TR.run_grid(train, test, fx.SPEC, configs, seed=fx.SEED, prepared=_prepared(spark, sf_dir), prefixes=True,
                       parallelism=_side_by_side(configs)).select("model", "params", "accuracy")


def q_grid_rf_large(spark, sf_dir):
    return _large_grid(spark, sf_dir, TR.rf_grid(**TR.LARGE_RF, max_bins=64))


def q_grid_gbt_large(spark, sf_dir):
    return _large_grid(spark, sf_dir, TR.gbt_grid(**TR.LARGE_GBT, max_bins=64))


STAGED_SPEC = FeatureSpec(numeric=("f1", "f4"), categorical=("gender",))
STAGED_GRID = TR.gbt_grid((1, 2), (1, 20), max_bins=64)


def q_staged_grid(spark, sf_dir):
    """Four configurations off two fits, chosen on the validation part, the chosen one scored on the test part."""
    train, validation, test = P.hash_split(fx.banded(spark, sf_dir), [], fx.THREE_PARTS, bucket_col="bucket")
    found = SG.staged_grid(train, validation, test, STAGED_SPEC, STAGED_GRID, fx.SEED, fx.LAYOUT_KEYS, LAYOUT_PARTITIONS, layout_rows=LAYOUT_ROWS)
    return found.table.select("seq", "model", "params", "accuracy", "chosen", "test_accuracy")


BANDED_SPEC = FeatureSpec(numeric=("f1",), categorical=())
BANDED_GRID = TR.rf_grid((3, 9), (1, 2, 3), max_bins=64) + STAGED_GRID


def _banded_parts(spark, sf_dir) -> list[DataFrame]:
    return P.hash_split(fx.banded(spark, sf_dir), [], fx.THREE_PARTS, bucket_col="bucket")


def _banded_prepared(spark, sf_dir) -> TR.Prepared:
    """Model input and featurised test part, both cached once for a whole grid."""
    def make():
        train, _, test = _banded_parts(spark, sf_dir)
        prepared = TR.prepare(train, BANDED_SPEC, fx.LAYOUT_KEYS, LAYOUT_PARTITIONS, layout_rows=LAYOUT_ROWS)
        prepared.cache_test(test)
        return prepared
    return _memoised(spark, sf_dir, "banded_prepared", make)


def _banded_grid(spark, sf_dir) -> tuple[DataFrame, float]:
    """Both grids on bands of one feature, and the seconds that they took."""
    def make():
        prepared = _banded_prepared(spark, sf_dir)
        began = time.perf_counter()
        table = TR.run_grid(*_banded_parts(spark, sf_dir)[::2], BANDED_SPEC, BANDED_GRID, fx.SEED, prepared=prepared)
        return table, time.perf_counter() - began
    return _memoised(spark, sf_dir, "banded_grid", make)


def q_grid_banded(spark, sf_dir):
    """Forests of depth 1, 2 and 3 and boosted trees of depth 1 and 2 get different shares of the bands right."""
    return _banded_grid(spark, sf_dir)[0].select("seq", "model", "params", "accuracy")


def q_grid_cached(spark, sf_dir):
    """The two tables that a grid keeps: their rows and labels, and where they are kept."""
    prepared = _banded_prepared(spark, sf_dir)
    out = None
    for part, df in (("train", prepared.train), ("test", prepared.test)):
        kept = df.storageLevel
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")).select(
            F.lit(part).alias("part"), "n", "positives", F.lit(kept.useMemory).alias("in_memory"), F.lit(kept.useDisk).alias("on_disk"))
        out = row if out is None else out.unionByName(row)
    return out


def q_grid_timing(spark, sf_dir):
    """What holds for the times of any run: each fit took some, all together not more than the run, twenty iterations more than one."""
    table, seconds = _banded_grid(spark, sf_dir)
    prep = _banded_prepared(spark, sf_dir).prep_seconds
    long, short = (F.sum(F.when(F.col("iters") == i, F.col("fit_time"))) for i in (20, 1))
    return (R.parse_params(table).groupBy("model")
            .agg(F.count(F.lit(1)).alias("runs"), (F.min("fit_time") > 0).alias("timed"), (F.sum("fit_time") <= F.lit(seconds)).alias("within_run"),
                 F.bool_and(F.abs(F.col("train_time") - F.col("fit_time") - F.lit(prep)) < 1e-6).alias("with_preparation"),
                 (long > short).alias("more_for_more")))


def q_grid_shapes(spark, sf_dir):
    """Trees and depth limits that the fitted models have, next to what was asked for."""
    out = None
    for cfg in (RF_FINAL, GBT_FINAL, FLAGSHIP):
        shape = TR.model_shape(spark, _fitted(spark, sf_dir, cfg))
        row = shape.select(F.lit(cfg.label()).alias("params"), "trees", "depth", (F.col("deepest") <= F.col("depth")).alias("within"))
        out = row if out is None else out.unionByName(row)
    return out


def q_experiment_csv(spark, sf_dir):
    """The experiment table as one headed CSV file, read back by name."""
    path = scratch_path(spark, "experiments_csv")
    WR.write_single_csv(_experiments(spark, sf_dir).orderBy(F.desc("model"), "seq"), path)
    return RD.read_csv(spark, path, schema="model STRING, params STRING, accuracy DOUBLE, seq INT")


def _importances(spark, sf_dir, cfg):
    return TR.feature_importances(spark, _fitted(spark, sf_dir, cfg))


def q_importance_gbt(spark, sf_dir):
    return _importances(spark, sf_dir, GBT_FINAL).select("feature", F.round("importance", 6).alias("importance"))


def q_importance_rf(spark, sf_dir):
    """What holds for any forest here: seven features, shares that sum to one, the rule's feature on top."""
    imp = _importances(spark, sf_dir, RF_FINAL)
    return imp.agg(F.sort_array(F.collect_list("feature")).cast("string").alias("features"), F.round(F.sum("importance"), 9).alias("total"),
                   F.max_by("feature", "importance").alias("top"))


def q_importance_report(spark, sf_dir):
    # Written with a header, read back without one: the header line becomes
    # a row whose importance is not a number.
    path = scratch_path(spark, "importance_csv")
    imp = q_importance_gbt(spark, sf_dir)
    WR.write_single_csv(imp, path)
    back = RD.read_csv_headerless(spark, path, ["feature", "importance"])
    return R.importance_report(back, decimals=1)


def q_coerce_numeric(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linenumber") == 1, F.col("l_returnflag")).otherwise(F.col("l_quantity").cast("string"))
    v = li.select(C.coerce_numeric(text).alias("v"))
    return v.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_numeric"), F.sum("v").alias("sum_v"))


# ---------------------------------------------------------------- experiment tables

def _experiments(spark, sf_dir):
    return R.experiment_table(_grid(spark, sf_dir, "RF"), _grid(spark, sf_dir, "GBT"))


def q_experiment_table(spark, sf_dir):
    return _experiments(spark, sf_dir).select("model", "params", "accuracy")


def q_experiment_series(spark, sf_dir):
    return R.experiment_series(_experiments(spark, sf_dir), metrics=("accuracy",))


def q_experiment_models(spark, sf_dir):
    return R.experiment_models(_experiments(spark, sf_dir))


def q_params_parse(spark, sf_dir):
    return R.parse_params(_experiments(spark, sf_dir)).select("model", "params", "trees", "depth", "iters")


def q_asof_months(spark, sf_dir):
    """Each month of one rule next to the last quarter's end of the other rule, by category."""
    months = E.accuracy_by(_with_month(fx.scored_two(spark, sf_dir)), ["model", "race", "month"], count_col=None, order=None)
    a = months.filter("model = 'rule_a'").drop("model")
    b = months.filter("model = 'rule_b' AND CAST(substr(month, 5) AS INT) % 3 = 0").drop("model")
    return asof_join(a, b, ["race"], "month")


def q_compare_runs(spark, sf_dir):
    """Pair the experiment table with the same grid spelled the other way
    and run on a different layout (partition count)."""
    def other():
        train, test = _split(spark, sf_dir)
        prepared = TR.prepare(train, fx.SPEC, layout_keys=fx.LAYOUT_KEYS,
                              layout_partitions=LAYOUT_PARTITIONS // 2, layout_rows=2 * LAYOUT_ROWS)
        try:
            return R.experiment_table(
                TR.run_grid(train, test, fx.SPEC, RF_GRID, fx.SEED, prepared=prepared, short_params=True, prefixes=True),
                TR.run_grid(train, test, fx.SPEC, GBT_GRID, fx.SEED, prepared=prepared, short_params=True, prefixes=True,
                            parallelism=_side_by_side(GBT_GRID)),
            ).cache()
        finally:
            prepared.unpersist()
    b = _memoised(spark, sf_dir, "grid_other_layout", other)
    return R.compare_runs(_experiments(spark, sf_dir), b, ("local", "cluster"), metrics=("accuracy",))


def q_compare_runs_parts(spark, sf_dir):
    """The grid on the test part next to a run of its own on the validation part: the two sides differ."""
    def other():
        train, validation, _ = _banded_parts(spark, sf_dir)
        return TR.run_grid(train, validation, BANDED_SPEC, BANDED_GRID[::-1], fx.SEED, layout_keys=fx.LAYOUT_KEYS,
                           layout_partitions=LAYOUT_PARTITIONS // 2, short_params=True, layout_rows=2 * LAYOUT_ROWS)
    b = _memoised(spark, sf_dir, "banded_other", other)
    return R.compare_runs(_banded_grid(spark, sf_dir)[0], b, ("test", "validation"), metrics=("accuracy",))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_accuracy_by_month": flagship,
    "scan_parquet": q_scan_parquet,
    "source_guard": q_source_guard,
    "table_replace": q_table_replace,
    "scan_merged": q_scan_merged,
    "csv_quarantine": q_csv_quarantine,
    "scan_csv": q_scan_csv,
    "scan_csv_inferred": q_scan_csv_inferred,
    "scan_csv_headerless": q_scan_csv_headerless,
    "binarize_label": q_binarize_label,
    "binarize_label_null": q_binarize_label_null,
    "correct_flag": q_correct_flag,
    "accuracy_null_pred": q_accuracy_null_pred,
    "prediction_project": q_prediction_project,
    "prediction_preview": q_prediction_preview,
    "sample_hash": q_sample_hash,
    "split_hash": q_split_hash,
    "holdout_hash": q_holdout_hash,
    "sample_fine": q_sample_fine,
    "sample_then_split": q_sample_then_split,
    "split_fingerprint": q_split_fingerprint,
    "split_check": q_split_check,
    "sample_bernoulli": q_sample_bernoulli,
    "split_random": q_split_random,
    "month_key": q_month_key,
    "month_label": q_month_label,
    "accuracy_by_month": q_accuracy_by_month,
    "accuracy_by_user": q_accuracy_by_user,
    "accuracy_by_category": q_accuracy_by_category,
    "accuracy_overall": q_accuracy_overall,
    "accuracy_grouping_sets": q_accuracy_grouping_sets,
    "state_accuracy": q_state_accuracy,
    "state_confusion": q_state_confusion,
    "row_counts": q_row_counts,
    "confusion_matrix": q_confusion_matrix,
    "confusion_pivot": q_confusion_pivot,
    "confusion_other": q_confusion_other,
    "confusion_many_classes": q_confusion_many_classes,
    "evaluator_accuracy": q_evaluator_accuracy,
    "class1_probability": q_class1_probability,
    "confidence_max": q_confidence_max,
    "threshold_decision": q_threshold_decision,
    "confidence_histogram": q_confidence_histogram,
    "probability_kde": q_probability_kde,
    "histogram_by_group": q_histogram_by_group,
    "kde_by_group": q_kde_by_group,
    "kde_tolerance": q_kde_tolerance,
    "histogram_distinct": q_histogram_distinct,
    "confidence_overlay": q_confidence_overlay,
    "worst_users_top10": q_worst_users_top10,
    "worst_users_report": q_worst_users_report,
    "union_predictions": q_union_predictions,
    "model_comparison": q_model_comparison,
    "string_index": q_string_index,
    "string_index_large": q_string_index_large,
    "assemble_features": q_assemble_features,
    "assemble_skip": q_assemble_skip,
    "standard_scale": q_standard_scale,
    "rf_train_eval": q_rf_train_eval,
    "gbt_train_eval": q_gbt_train_eval,
    "score_two_models": q_score_two_models,
    "model_roundtrip": q_model_roundtrip,
    "grid_rf": q_grid_rf,
    "grid_gbt": q_grid_gbt,
    "grid_rf_large": q_grid_rf_large,
    "grid_gbt_large": q_grid_gbt_large,
    "staged_grid": q_staged_grid,
    "grid_banded": q_grid_banded,
    "grid_cached": q_grid_cached,
    "grid_timing": q_grid_timing,
    "grid_shapes": q_grid_shapes,
    "experiment_csv": q_experiment_csv,
    "importance_gbt": q_importance_gbt,
    "importance_rf": q_importance_rf,
    "importance_report": q_importance_report,
    "coerce_numeric": q_coerce_numeric,
    "experiment_table": q_experiment_table,
    "experiment_series": q_experiment_series,
    "experiment_models": q_experiment_models,
    "params_parse": q_params_parse,
    "asof_months": q_asof_months,
    "compare_runs": q_compare_runs,
    "compare_runs_parts": q_compare_runs_parts,
}
