"""The three end-to-end jobs: train, inference with error analysis, experiments.

Each composes the operators; column names come from a :class:`FeatureSpec`
and keyword arguments, so the same jobs run on the observation table
(``sources.OBSERVATION_SCHEMA``) or on any table of that shape.

Inference writes the predictions first and runs every report off the written
Parquet table: the written table cuts the scoring lineage (a lost executor
re-reads files instead of re-scoring), and column pruning makes each report
read only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.functions.columns import class_probability, confidence, month_key
from errlens.operators import evaluate as E
from errlens.operators import fingerprint as FP
from errlens.operators import prep as P
from errlens.operators import report as R
from errlens.operators import score as S
from errlens.operators import staged as SG
from errlens.operators import train as TR
from errlens.operators.features import FeatureSpec
from errlens.sources import models as MD
from errlens.sources import readers as RD
from errlens.sources import writers as WR

# The observation table's feature columns, in the order the models use them
# (fixed values).
OBSERVATION_SPEC = FeatureSpec(
    numeric=("phq4_score", "social_level", "sleep_duration", "daily_steps", "covid_total"),
    categorical=("gender", "race"),
)
# The final model settings (fixed values).
FINAL_MODELS = {
    "RF": TR.ModelConfig(TR.RF, depth=6, trees=50),
    "GBT": TR.ModelConfig(TR.GBT, depth=6, iters=25),
}


@dataclass(frozen=True)
class Columns:
    """Names of the non-feature columns the jobs use."""
    user: str = "uid"
    day: str = "day"
    category: str = "race"
    target: str = "stress"
    threshold: float = 2
    split_keys: tuple[str, ...] = ("uid", "day")


def _labelled(df: DataFrame, spec: FeatureSpec, cols: Columns, null_label: str) -> DataFrame:
    return P.with_label(df, cols.target, cols.threshold, spec.label, null_label)


def train(df: DataFrame, model_dir: str | None = None, spec: FeatureSpec = OBSERVATION_SPEC,
          models: Mapping[str, TR.ModelConfig] = FINAL_MODELS, cols: Columns = Columns(),
          seed: int = 42, test_fraction: float = 0.2, layout_partitions: int | None = None,
          null_label: str = "one", reliable_input: bool = False, unique_rows: bool = False) -> dict:
    """Fit every model on the stable training part, evaluate on the hold-out,
    and (with ``model_dir``) save each whole pipeline plus its importances.

    ``unique_rows`` says that the split keys hold no combination twice, so
    the layout needs one shuffle instead of two.  The fingerprint of the
    training rows is saved as ``split_fingerprint`` beside the pipelines.

    Returns ``{"models": {name: PipelineModel}, "accuracy": DataFrame,
    "importances": DataFrame}``.
    """
    spark = df.sparkSession
    data = _labelled(df, spec, cols, null_label)
    train_part, test_part = P.hash_split(data, cols.split_keys, (1 - test_fraction, test_fraction), seed)
    layout = list(dict.fromkeys([*cols.split_keys, spec.label, *spec.numeric, *spec.categorical]))
    prepared = TR.prepare(train_part, spec, layout_keys=layout, layout_partitions=layout_partitions,
                          reliable=reliable_input, unique_keys=cols.split_keys if unique_rows else ())
    try:
        fitted = {name: TR.full_pipeline(prepared, TR.fit_classifier(prepared, cfg, seed))
                  for name, cfg in models.items()}
    finally:
        prepared.unpersist()
    accuracy = E.accuracy_overall(S.score_pipelines(test_part, fitted, keep=[spec.label]), by="model",
                                  label=spec.label)
    if model_dir:
        columns = list(dict.fromkeys([*cols.split_keys, spec.label, *spec.numeric, *spec.categorical]))
        FP.save(spark, FP.fingerprint(train_part, cols.split_keys, columns, seed, test_fraction), f"{model_dir.rstrip('/')}/split_fingerprint")
    importances = None
    for name, model in fitted.items():
        imp = TR.feature_importances(spark, model).select(F.lit(name).alias("model"), "*")
        importances = imp if importances is None else importances.unionByName(imp)
        if model_dir:
            MD.save_pipeline(model, f"{model_dir.rstrip('/')}/{name.lower()}_pipeline")
            WR.write_single_csv(imp.select("feature", "importance"),
                                f"{model_dir.rstrip('/')}/importance_{name.lower()}")
    return {"models": fitted, "accuracy": accuracy, "importances": importances}


def load_models(model_dir: str, names: Sequence[str] = tuple(FINAL_MODELS)) -> dict[str, PipelineModel]:
    return {n: MD.load_pipeline(f"{model_dir.rstrip('/')}/{n.lower()}_pipeline") for n in names}


def load_fingerprint(spark: SparkSession, model_dir: str) -> FP.Fingerprint | None:
    """What :func:`train` saved about its split; None for models that were saved without it."""
    return RD.read_optional(FP.load, spark, f"{model_dir.rstrip('/')}/split_fingerprint")


def inference(df: DataFrame, models: Mapping[str, PipelineModel], out_dir: str,
              spec: FeatureSpec = OBSERVATION_SPEC, cols: Columns = Columns(), seed: int = 42,
              test_fraction: float | None = 0.2, null_label: str = "one", worst_k: int = 10,
              bins: int = 30, kde_points: int = 200, partitions: int | None = None,
              fingerprint: FP.Fingerprint | None = None, kde_tolerance: float | None = None) -> dict[str, DataFrame]:
    """Score the stable hold-out with every model (one pass), write the long
    prediction table partitioned by model, and build the error-analysis
    tables from it.  The monthly table is also written as headerless CSV.
    ``test_fraction=None`` scores ``df`` as given (already the hold-out).

    With the ``fingerprint`` that training saved, a hold-out that has
    training rows in it, and an input that is not the one trained on, end
    the job (:class:`errlens.operators.fingerprint.SplitMismatch`).
    ``kde_tolerance`` allows the densities that error (:func:`errlens.operators.evaluate.kde`).

    Scoring is narrow and CPU-heavy (every tree of every model per row), so
    it runs in as many tasks as the source has splits.  ``partitions``
    spreads the hold-out round-robin over that many tasks first, for
    sources with few splits (gzip CSV, one large Parquet row group); leave
    it ``None`` when the scan already yields enough splits.
    """
    spark = df.sparkSession
    data = _labelled(df, spec, cols, null_label)
    if fingerprint:
        FP.check(data, fingerprint, keys=cols.split_keys, seed=seed, test_fraction=test_fraction, whole=test_fraction is not None)
    test = data if test_fraction is None else P.holdout(data, cols.split_keys, test_fraction, seed)
    if partitions:
        test = test.repartition(partitions)
    keep = list(dict.fromkeys([cols.user, cols.day, cols.category, spec.label]))
    scored = S.score_pipelines(test, models, keep=keep)
    out = out_dir.rstrip("/")
    WR.write_predictions(scored, f"{out}/predictions", columns=(*keep, "prediction", "probability"),
                         partition_by=["model"])
    pred = RD.read_parquet(spark, f"{out}/predictions").withColumn("month", month_key(cols.day))

    label = spec.label
    # One scan, one shuffle: the predictions reduced to what the accuracy
    # tables and the confusion matrix need; it is kept, and those read it
    # instead of the predictions.  ``release`` frees it.
    dims = ["month", cols.user, cols.category]
    reduced = E.reduce_predictions(pred, dims, label=label, by="model").persist(StorageLevel.MEMORY_AND_DISK)
    groupings = E.grouping_sets_of(reduced, dims, by="model").persist(StorageLevel.MEMORY_AND_DISK)

    def dim(name: str, col: str) -> DataFrame:
        return groupings.filter(F.col("dim") == name).select("model", F.col("value").alias(col),
                                                             "accuracy", "samples")

    tables = {
        "all_groupings": groupings,
        "reduced": reduced,
        "accuracy": groupings.filter(F.col("dim") == "all").select("model", "accuracy", "samples"),
        "row_counts": groupings.filter(F.col("dim") == "all").select("model", F.col("samples").alias("scored_rows")),
        "by_month": dim("month", "month").withColumnRenamed("samples", "total_samples").orderBy("model", "month"),
        "worst_users": E.lowest_k_by(dim(cols.user, cols.user), "model", cols.user, worst_k),
        "by_category": dim(cols.category, cols.category).drop("samples")
                       .orderBy("model", F.desc("accuracy"), cols.category),
        "confusion": E.confusion_of(reduced, by="model"),
        "confidence_histogram": E.histogram(pred.select("model", confidence("probability").alias("confidence")),
                                            "confidence", bins=bins, by="model"),
        "confidence_overlay": E.kde(pred.select("model", confidence("probability").alias("confidence")),
                                    "confidence", by="model", grid_size=kde_points, cut=0.0, counts_bins=bins, tolerance=kde_tolerance),
        "class1_density": E.kde(pred.select("model", class_probability("probability", 1).alias("p1")),
                                "p1", by="model", grid_size=kde_points, tolerance=kde_tolerance),
    }
    tables["comparison"] = R.model_comparison(tables["accuracy"])
    for name in models:
        WR.write_csv_headerless(
            tables["by_month"].filter(F.col("model") == name).select("month", "accuracy", "total_samples"),
            f"{out}/analysis_monthly_{name.lower()}")
    return tables


def release(tables: Mapping[str, DataFrame]) -> None:
    """Free what :func:`inference` keeps in memory for its tables."""
    tables["all_groupings"].unpersist()
    tables["reduced"].unpersist()


def experiments(df: DataFrame, spec: FeatureSpec = OBSERVATION_SPEC, cols: Columns = Columns(),
                rf: Sequence[TR.ModelConfig] | None = None, gbt: Sequence[TR.ModelConfig] | None = None,
                sample_fraction: float | None = 0.3, sample_seed: int = 7, seed: int = 42,
                out_csv: str | None = None, short_params: bool = False, parallelism: int = 1,
                null_label: str = "one", reliable_input: bool = False,
                partitions: int | None = None, layout_partitions: int | None = None,
                unique_rows: bool = False) -> DataFrame:
    """Hyper-parameter grids on one shared preprocessing.

    Optional stable sample first (its hash has nothing to do with the
    split's), then the stable split, then every RF and GBT configuration; one result table
    ``(seq, model, params, accuracy, train_time)``, optionally written as one
    headed CSV.  ``partitions`` spreads the test part before the one-pass
    evaluation of every configuration, as in :func:`inference`.
    """
    data = df
    if sample_fraction is not None and sample_fraction < 1:
        data = P.hash_sample(data, cols.split_keys, sample_fraction, sample_seed)
    data = _labelled(data, spec, cols, null_label)
    train_part, test_part = P.hash_split(data, cols.split_keys, (0.8, 0.2), seed)
    if partitions:
        test_part = test_part.repartition(partitions)
    layout = list(dict.fromkeys([*cols.split_keys, spec.label, *spec.numeric, *spec.categorical]))
    prepared = TR.prepare(train_part, spec, layout_keys=layout, layout_partitions=layout_partitions,
                          reliable=reliable_input, unique_keys=cols.split_keys if unique_rows else ())
    try:
        prepared.cache_test(test_part)
        parts = [TR.run_grid(train_part, test_part, spec, grid, seed, prepared=prepared,
                             short_params=short_params, parallelism=parallelism)
                 for grid in (rf if rf is not None else TR.rf_grid(),
                              gbt if gbt is not None else TR.gbt_grid()) if grid]
    finally:
        prepared.unpersist()
    table = R.experiment_table(*parts)
    if out_csv:
        WR.write_single_csv(table.orderBy(F.desc("model"), "seq"), out_csv)
    return table


def tune(df: DataFrame, spec: FeatureSpec = OBSERVATION_SPEC, cols: Columns = Columns(),
         configs: Sequence[TR.ModelConfig] | None = None, weights: Sequence[float] = (0.6, 0.2, 0.2),
         sample_fraction: float | None = None, sample_seed: int = 7, seed: int = 42, model_dir: str | None = None,
         out_csv: str | None = None, null_label: str = "one", reliable_input: bool = False,
         layout_partitions: int | None = None, unique_rows: bool = False) -> SG.Staged:
    """Grids over three parts: fit on the first, choose on the second, report on the third.

    Unlike :func:`experiments`, whose accuracies are those of the test part,
    the test part is read once, for the chosen configuration.  With
    ``model_dir`` its whole pipeline is saved as ``chosen_pipeline``.
    """
    data = df
    if sample_fraction is not None and sample_fraction < 1:
        data = P.hash_sample(data, cols.split_keys, sample_fraction, sample_seed)
    if len(weights) != 3:
        raise ValueError("weights of three parts: training, validation, test")
    data = _labelled(data, spec, cols, null_label)
    train_part, validation, test = P.hash_split(data, cols.split_keys, weights, seed)
    layout = list(dict.fromkeys([*cols.split_keys, spec.label, *spec.numeric, *spec.categorical]))
    prepared = TR.prepare(train_part, spec, layout_keys=layout, layout_partitions=layout_partitions,
                          reliable=reliable_input, unique_keys=cols.split_keys if unique_rows else ())
    try:
        found = SG.staged_grid(train_part, validation, test, spec, configs, seed, prepared=prepared)
    finally:
        prepared.unpersist()
    if model_dir:
        MD.save_pipeline(found.pipeline, f"{model_dir.rstrip('/')}/chosen_pipeline")
    if out_csv:
        WR.write_single_csv(found.table.orderBy("seq"), out_csv)
    return found
