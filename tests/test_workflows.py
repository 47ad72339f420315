"""End-to-end jobs on a CSV of observation rows derived from the fixture."""

import math

import pytest
from pyspark.sql import functions as F

from errlens.operators import fingerprint as FP
from errlens.operators import train as TR
from errlens.plans import fixtures as fx
from errlens.plans import workflows as W
from errlens.session import scratch_path
from errlens.sources import models as MD
from errlens.sources import readers as RD
from errlens.sources import writers as WR


@pytest.fixture(scope="module")
def obs_csv(spark, sf_small):
    """The obs view written as an observation CSV with the reference's column names."""
    o = fx.obs(spark, sf_small).select(
        F.concat("uid", F.lit("-"), F.col("bucket").cast("string")).alias("uid"), "day", "stress",
        F.col("f1").alias("phq4_score"), F.col("f2").alias("social_level"), F.col("f3").alias("sleep_duration"),
        F.col("f4").alias("daily_steps"), F.col("f5").alias("covid_total"), "gender", "race")
    path = scratch_path(spark, "obs_csv")
    o.write.option("header", "true").csv(path)
    return path


SMALL = {"RF": TR.ModelConfig(TR.RF, depth=4, trees=5, max_bins=64),
         "GBT": TR.ModelConfig(TR.GBT, depth=3, iters=5, max_bins=64)}


def test_train_then_inference(spark, obs_csv):
    df = RD.read_csv(spark, obs_csv, schema=RD.OBSERVATION_SCHEMA)
    model_dir = scratch_path(spark, "models")
    res = W.train(df, model_dir, models=SMALL)
    acc = {r.model: r.accuracy for r in res["accuracy"].collect()}
    assert set(acc) == {"RF", "GBT"} and min(acc.values()) > 0.9
    imp = RD.read_csv(spark, f"{model_dir}/importance_gbt", schema="feature STRING, importance DOUBLE")
    assert [r.feature for r in imp.collect()] == W.OBSERVATION_SPEC.vector_names

    out = scratch_path(spark, "inference")
    tables = W.inference(df, W.load_models(model_dir), out, kde_points=21)
    got = {r.model: r.accuracy for r in tables["accuracy"].collect()}
    assert got == pytest.approx(acc, rel=1e-12)
    n = {r.model: r.scored_rows for r in tables["row_counts"].collect()}
    month = tables["by_month"].groupBy("model").agg(F.sum("total_samples").alias("n")).collect()
    assert {r.model: r.n for r in month} == n
    worst = tables["worst_users"].collect()
    assert len(worst) == 20 and {r.model for r in worst} == {"RF", "GBT"}
    hist = tables["confidence_histogram"].groupBy("model").agg(F.sum("n").alias("n")).collect()
    assert {r.model: r.n for r in hist} == n
    monthly = RD.read_csv_headerless(spark, f"{out}/analysis_monthly_rf", ["month", "accuracy", "samples"])
    assert monthly.count() == tables["by_month"].filter("model = 'RF'").count()
    dens = tables["class1_density"].collect()
    assert all(r.density >= 0 for r in dens)

    # spreading the hold-out over more tasks before scoring changes nothing
    spread = W.inference(df, W.load_models(model_dir), scratch_path(spark, "inference"), kde_points=21,
                         partitions=4)
    for name in ("all_groupings", "confusion", "confidence_histogram"):
        a = sorted(map(tuple, tables[name].collect()), key=repr)
        b = sorted(map(tuple, spread[name].collect()), key=repr)
        assert a == b, name


def test_experiments_table(spark, obs_csv):
    df = RD.read_csv(spark, obs_csv, schema=RD.OBSERVATION_SCHEMA)
    out = scratch_path(spark, "experiments")
    t = W.experiments(df, rf=TR.rf_grid((3,), (2, 3), max_bins=64), gbt=TR.gbt_grid((2,), (3,), max_bins=64),
                      sample_fraction=0.5, out_csv=out)
    rows = t.collect()
    assert [r.model for r in sorted(rows, key=lambda r: (r.model != "RF", r.seq))] == ["RF", "RF", "GBT"]
    back = RD.read_csv(spark, out, schema="seq INT, model STRING, params STRING, accuracy DOUBLE, train_time DOUBLE")
    assert back.count() == 3
    # spreading the test part before the evaluation pass changes no accuracy
    spread = W.experiments(df, rf=TR.rf_grid((3,), (2, 3), max_bins=64), gbt=TR.gbt_grid((2,), (3,), max_bins=64),
                           sample_fraction=0.5, partitions=3)
    assert sorted((r.seq, r.model, r.accuracy) for r in spread.collect()) == sorted(
        (r.seq, r.model, r.accuracy) for r in rows)


def test_command_line_train_then_inference(spark, obs_csv, monkeypatch):
    import functools

    from errlens import __main__ as cli
    # the CLI trains the final model settings; small ones keep the test short
    monkeypatch.setattr(W, "train", functools.partial(W.train, models=SMALL))
    model_dir, out = scratch_path(spark, "cli-models"), scratch_path(spark, "cli-out")
    cli.main(["train", "--input", obs_csv, "--models", model_dir])
    cli.main(["inference", "--input", obs_csv, "--models", model_dir, "--out", out, "--partitions", "4"])
    pred = RD.read_parquet(spark, f"{out}/predictions")
    assert {r.model for r in pred.select("model").distinct().collect()} == {"RF", "GBT"}
    monthly = RD.read_csv_headerless(spark, f"{out}/analysis_monthly_gbt", ["month", "accuracy", "samples"])
    assert monthly.count() > 0


def test_scoring_refuses_a_hold_out_that_was_trained_on(spark, obs_csv):
    df = RD.read_csv(spark, obs_csv, schema=RD.OBSERVATION_SCHEMA)
    model_dir = scratch_path(spark, "models")
    small = {"GBT": TR.ModelConfig(TR.GBT, depth=2, iters=2)}
    W.train(df, model_dir, models=small)
    saved, models = W.load_fingerprint(spark, model_dir), W.load_models(model_dir, ["GBT"])
    W.release(W.inference(df, models, scratch_path(spark, "inference"), kde_points=5, fingerprint=saved))
    for change in ({"seed": 7}, {"test_fraction": 0.5}):
        with pytest.raises(FP.SplitMismatch):
            W.inference(df, models, scratch_path(spark, "inference"), fingerprint=saved, **change)
    with pytest.raises(FP.SplitMismatch, match="not the one"):
        W.inference(df.withColumn("phq4_score", F.col("phq4_score") + 1), models, scratch_path(spark, "inference"), fingerprint=saved)
    assert W.load_fingerprint(spark, scratch_path(spark, "nothing")) is None


def test_tune_saves_the_chosen_pipeline(spark, obs_csv):
    df = RD.read_csv(spark, obs_csv, schema=RD.OBSERVATION_SCHEMA)
    model_dir, out = scratch_path(spark, "models"), scratch_path(spark, "tuned")
    found = W.tune(df, configs=TR.gbt_grid((2,), (2, 5)), model_dir=model_dir, out_csv=out)
    rows = found.table.collect()
    assert found.fits == 1 and sum(r["chosen"] for r in rows) == 1
    back = RD.read_csv(spark, out, schema="params STRING, accuracy DOUBLE, chosen BOOLEAN, test_accuracy DOUBLE")
    assert [tuple(r) for r in back.collect()] == [(r["params"], r["accuracy"], r["chosen"], r["test_accuracy"]) for r in rows]
    model = MD.load_pipeline(f"{model_dir}/chosen_pipeline")
    assert len(model.stages[-1].trees) == found.config.iters
    with pytest.raises(ValueError):
        W.tune(df, weights=(0.8, 0.2))
