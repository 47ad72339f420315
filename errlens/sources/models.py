"""Fitted pipeline persistence (the whole PipelineModel, not only the classifier)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from errlens.sources.tables import replace, resolve


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Replace ``path`` with the fitted pipeline (all stages)."""
    replace(SparkSession.active(), path, lambda folder: model.write().save(folder))


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(resolve(SparkSession.active(), path))
