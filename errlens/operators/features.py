"""Featurisation: string index → assemble → standard scale.

Fitted once on the training part and reused for every classifier and every
grid point (the stages only ever see training rows, so this equals
refitting them per model).  The multi-column ``StringIndexer`` counts all
categorical columns in a single aggregation job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (
    StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns feed the model, in the order they enter the vector.

    Numeric columns come first, then the index of each categorical column
    (``<name>_index``); that order is the order of feature importances.
    """
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    label: str = "label"
    features_col: str = "features"
    scaled_col: str = "scaledFeatures"
    # StringIndexer: 'keep' gives unseen and null categories their own index.
    index_invalid: str = "keep"
    # VectorAssembler on null numeric input: 'error' (raise), 'skip' (drop
    # the row) or 'keep' (NaN).
    assemble_invalid: str = "error"
    index_suffix: str = "_index"
    extra: dict = field(default_factory=dict)

    @property
    def index_cols(self) -> list[str]:
        return [c + self.index_suffix for c in self.categorical]

    @property
    def vector_names(self) -> list[str]:
        return list(self.numeric) + self.index_cols


def feature_stages(spec: FeatureSpec) -> list:
    stages = []
    if spec.categorical:
        stages.append(StringIndexer(inputCols=list(spec.categorical), outputCols=spec.index_cols,
                                    handleInvalid=spec.index_invalid))
    stages.append(VectorAssembler(inputCols=spec.vector_names, outputCol=spec.features_col,
                                  handleInvalid=spec.assemble_invalid))
    # Divide by the sample standard deviation; no centring (keeps sparsity).
    stages.append(StandardScaler(inputCol=spec.features_col, outputCol=spec.scaled_col,
                                 withMean=False, withStd=True))
    return stages


def fit_features(train: DataFrame, spec: FeatureSpec, copies: str | None = None) -> PipelineModel:
    """The stages fitted on ``train``; ``copies`` names a column that says how many rows each row stands for."""
    if copies is None:
        return Pipeline(stages=feature_stages(spec)).fit(train)
    *first, scaler = feature_stages(spec)
    if spec.categorical:
        first[0] = _index_of_copies(train, first[0], copies)
    found = PipelineModel(first)
    return PipelineModel([*first, _scale_of_copies(found.transform(train), scaler, copies)])


def _index_of_copies(train: DataFrame, indexer: StringIndexer, copies: str) -> StringIndexerModel:
    """The model that ``indexer`` fits on every copy: labels by falling frequency, ties in the order of their text."""
    names = indexer.getInputCols()
    values = F.inline(F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in enumerate(names))))
    counts = train.select(copies, values).filter("v IS NOT NULL").groupBy("k", "v").agg(F.sum(copies).alias("n")).collect()
    labels = [[r.v for r in sorted((r for r in counts if r.k == k), key=lambda r: (-r.n, r.v.encode("utf-16-be")))] for k in range(len(names))]
    return StringIndexerModel.from_arrays_of_labels(labels, names, indexer.getOutputCols(), indexer.getHandleInvalid())


def _scale_of_copies(assembled: DataFrame, scaler: StandardScaler, copies: str) -> StandardScalerModel:
    """The model that ``scaler`` fits on every copy.

    The summary's variance of weighted rows is divided by another number than that of rows which stand one by one,
    so the squares are taken out of it again.  Deviations have twelve digits, so that the order in which rows were
    added up does not show.
    """
    col, w = F.col(scaler.getInputCol()), F.col(copies).cast("double")
    s, n, squares = assembled.select(Summarizer.metrics("mean", "variance").summary(col, w), F.sum(w), F.sum(w * w)).first()
    std = np.sqrt(np.maximum(s.variance.toArray() * (n - squares / n) / max(n - 1, 1), 0))
    std = np.array([float(f"{x:.12g}") for x in std])
    sc = SparkContext._active_spark_context
    made = sc._jvm.org.apache.spark.ml.feature.StandardScalerModel(scaler.uid, _py2java(sc, Vectors.dense(std)), _py2java(sc, s.mean))
    out = StandardScalerModel(made)
    out._resetUid(scaler.uid)
    return out._set(**{p.name: v for p, v in scaler.extractParamMap().items() if scaler.isSet(p)})

