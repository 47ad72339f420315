"""Staged grids: choose on a validation part, report on the test part.

Boosting adds trees one after the other, so the model of few iterations is a
prefix of the model of many.  Each depth of a grid is therefore fitted once,
at its largest number of iterations, and every smaller number is read off
its trees: a row meets each tree once, the weighted outputs of the trees
between two numbers of iterations are added up in one column, and one
aggregate over the validation part gives the accuracy of every
configuration.  Forests draw their samples by the number of trees and so
have no such prefix; they are fitted one by one and scored in the same scan.

The configuration that is best on the validation part is scored on the test
part, which nothing else reads, so its accuracy there is not an accuracy of
the choice.  Ties go to fewer trees, then to the lower depth, then to the
earlier configuration.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errlens.operators import train as TR
from errlens.operators.features import FeatureSpec
from errlens.operators.train import prefix
from errlens.sources.readers import table_from_rows

STAGED_SCHEMA = T.StructType([
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("params", T.StringType(), False),
    T.StructField("accuracy", T.DoubleType(), True),        # on the validation part
    T.StructField("chosen", T.BooleanType(), False),
    T.StructField("test_accuracy", T.DoubleType(), True),   # of the chosen one
    T.StructField("fit_time", T.DoubleType(), False),       # of the fit that the configuration is read off
])


@dataclass
class Staged:
    """Outcome of a staged grid: its table, the chosen configuration and its whole pipeline."""
    table: DataFrame
    config: TR.ModelConfig
    pipeline: PipelineModel
    fits: int


def stage_margins(df: DataFrame, model: GBTClassificationModel, stages: Sequence[int], features_col: str,
                  tag: str) -> tuple[DataFrame, dict[int, Column]]:
    """``df`` with a column of summed tree outputs between each two stages, and the margin of each stage.

    Every tree is evaluated once per row.  A margin above zero is class 1.
    """
    keep, weights, trees = df.columns, model.treeWeights, model.trees
    ends = sorted(set(stages))
    if not 1 <= ends[0] <= ends[-1] <= len(trees):
        raise ValueError(f"stages {ends} of a model that has {len(trees)} trees")
    for k, tree in enumerate(trees[:ends[-1]]):
        df = tree.copy().setFeaturesCol(features_col).setPredictionCol(f"{tag}_tree{k}").transform(df)
    parts = {e: reduce(add, (F.col(f"{tag}_tree{k}") * F.lit(float(weights[k])) for k in range(b, e)))
             for b, e in zip([0, *ends], ends)}
    df = df.select(*keep, *(c.alias(f"{tag}_to{e}") for e, c in parts.items()))
    return df, {e: reduce(add, (F.col(f"{tag}_to{x}") for x in ends if x <= e)) for e in ends}


def _accuracy(label: str, predicted: Column) -> Column:
    return F.avg((F.col(label) == predicted).cast("int"))


def staged_grid(train: DataFrame, validation: DataFrame, test: DataFrame, spec: FeatureSpec,
                configs: Sequence[TR.ModelConfig] | None = None, seed: int = 42,
                layout_keys: Sequence[str] | None = None, layout_partitions: int | None = None,
                short_params: bool = False, prepared: TR.Prepared | None = None, reliable: bool = False,
                layout_rows: int | None = None) -> Staged:
    """Fit, choose on ``validation``, score the chosen configuration on ``test``.

    An empty validation or test part is an error.
    """
    configs = list(configs if configs is not None else [*TR.rf_grid(), *TR.gbt_grid()])
    if not configs:
        raise ValueError("no configuration")
    own = prepared is None
    if own:
        prepared = TR.prepare(train, spec, layout_keys, layout_partitions, reliable, layout_rows=layout_rows)
    try:
        longest = TR.longest_fits(configs)
        # shared by the fits, so no part of their own times
        for cfg in longest if prepared.layout else ():
            if cfg.kind == TR.GBT:
                prepared.binned(cfg.max_bins)
            elif not prepared.forests_on_bins(cfg.max_bins):
                prepared.lay_out()
        fitted, seconds = {}, {}
        for cfg in dict.fromkeys(longest.values()):
            began = time.perf_counter()
            fitted[cfg] = TR.fit_classifier(prepared, cfg, seed)
            seconds[cfg] = time.perf_counter() - began
    finally:
        if own:
            prepared.unpersist()

    scored, predicted = prepared.features(validation), {}
    for i, (cfg, model) in enumerate(fitted.items()):
        if cfg.kind == TR.GBT:
            mine = [c for c in configs if longest[c] == cfg]
            scored, margins = stage_margins(scored, model, [c.iters for c in mine], spec.scaled_col, f"_g{i}")
            predicted |= {c: F.when(margins[c.iters] > 0, 1.0).otherwise(0.0) for c in mine}
        else:
            model = model.copy().setFeaturesCol(spec.scaled_col)
            model.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
            scored = model.transform(scored).drop(f"_r{i}", f"_q{i}")
            predicted[cfg] = F.col(f"_p{i}")
    found = scored.agg(F.count(F.lit(1)).alias("n"), *(_accuracy(spec.label, predicted[c]).alias(f"a{i}") for i, c in enumerate(configs))).first()
    if not found["n"]:
        raise ValueError("the validation part is empty")
    best = max(range(len(configs)), key=lambda i: (found[f"a{i}"], -(configs[i].iters if configs[i].kind == TR.GBT else configs[i].trees),
                                                   -configs[i].depth, -i))
    cfg = configs[best]
    model = fitted[longest[cfg]]
    if cfg.kind == TR.GBT:
        model = prefix(model, cfg.iters)
    pipeline = TR.full_pipeline(prepared, model)
    at_end = model.transform(prepared.features(test)).agg(F.count(F.lit(1)).alias("n"), _accuracy(spec.label, F.col("prediction")).alias("a")).first()
    if not at_end["n"]:
        raise ValueError("the test part is empty")
    rows = [(i, c.kind, c.label(short_params), found[f"a{i}"], i == best, at_end["a"] if i == best else None, seconds[longest[c]])
            for i, c in enumerate(configs)]
    return Staged(table_from_rows(train.sparkSession, rows, STAGED_SCHEMA), cfg, pipeline, len(fitted))
