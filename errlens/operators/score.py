"""Scoring: several models over one input in one pass, long result table.

Preprocessing is applied once; each classifier writes its own output
columns; the wide row is then turned into one row per (input row, model)
with ``inline`` over an array of structs — a narrow, codegen'd projection,
no shuffle and no second scan of the input.  Dense vector columns
(``features``/``scaledFeatures``) are dropped before the result leaves
this module, so caching or writing it stays cheap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_pipeline(model: PipelineModel) -> tuple[PipelineModel, object]:
    """(preprocessing stages, classifier) of a fitted pipeline."""
    return PipelineModel(stages=list(model.stages[:-1])), model.stages[-1]


def _stage_key(st) -> tuple:
    if isinstance(st, StringIndexerModel):
        return ("idx", tuple(st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]),
                tuple(tuple(a) for a in st.labelsArray), st.getHandleInvalid())
    if isinstance(st, VectorAssembler):
        return ("asm", tuple(st.getInputCols()), st.getOutputCol(), st.getHandleInvalid())
    if isinstance(st, StandardScalerModel):
        return ("scl", st.getInputCol(), st.getOutputCol(), tuple(st.std.toArray()),
                tuple(st.mean.toArray()), st.getWithMean(), st.getWithStd())
    return ("other", st.uid)


def same_preprocessing(a: PipelineModel, b: PipelineModel) -> bool:
    """True when two fitted preprocessing pipelines compute the same columns."""
    return (len(a.stages) == len(b.stages)
            and all(_stage_key(x) == _stage_key(y) for x, y in zip(a.stages, b.stages)))


def score_wide(df: DataFrame, prep: PipelineModel, classifiers: Mapping[str, object]) -> DataFrame:
    """Apply ``prep`` once, then every classifier with its own output columns
    ``<name>__prediction`` / ``<name>__probability``."""
    out = prep.transform(df)
    for name, clf in classifiers.items():
        m = clf.copy()
        m.setPredictionCol(f"{name}__prediction")
        m.setProbabilityCol(f"{name}__probability")
        m.setRawPredictionCol(f"{name}__raw")
        out = m.transform(out)
    return out


def score_long(df: DataFrame, prep: PipelineModel, classifiers: Mapping[str, object],
               keep: Sequence[str], model_col: str = "model") -> DataFrame:
    """One row per (input row, model): ``model, *keep, prediction, probability``."""
    wide = score_wide(df, prep, classifiers)
    rows = F.array(*[
        F.struct(F.lit(name).alias(model_col),
                 F.col(f"{name}__prediction").alias("prediction"),
                 F.col(f"{name}__probability").alias("probability"))
        for name in classifiers])
    return wide.select(*keep, F.inline(rows)).select(model_col, *keep, "prediction", "probability")


def score_pipelines(df: DataFrame, pipelines: Mapping[str, PipelineModel], keep: Sequence[str],
                    model_col: str = "model") -> DataFrame:
    """Score fitted pipelines (e.g. loaded from disk) into one long table.

    When all pipelines share the same fitted preprocessing — the case for
    models trained on one training part — it runs once and all classifiers
    score in a single pass; otherwise each pipeline scores separately and
    the results are concatenated.
    """
    parts = {name: split_pipeline(pm) for name, pm in pipelines.items()}
    preps = [p for p, _ in parts.values()]
    if all(same_preprocessing(preps[0], p) for p in preps[1:]):
        return score_long(df, preps[0], {n: c for n, (_, c) in parts.items()}, keep, model_col)
    out = None
    for name, (prep, clf) in parts.items():
        one = score_long(df, prep, {name: clf}, keep, model_col)
        out = one if out is None else out.unionByName(one)
    return out
