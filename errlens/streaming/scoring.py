"""Scoring as a stream.

The batch scoring path is row-wise (feature stages and tree models are
projections), so the same fitted pipelines apply unchanged to a streaming
frame.  Grouped accuracy becomes a streaming aggregation whose state is one
row per group (month, user, category): ``sum`` of correct rows, rows with a
prediction, and all rows — partial aggregates that merge across
micro-batches, so a hot group never needs more than one state row.

Progress and state live under the query's checkpoint location, which the
caller names and which must be on shared storage: a query started again with
the same location resumes from its last committed batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from errlens.functions.columns import correct
from errlens.operators.score import score_pipelines


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File source (a folder or a glob) with an explicit schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def score_stream(df: DataFrame, pipelines: Mapping[str, PipelineModel], keep: Sequence[str],
                 model_col: str = "model") -> DataFrame:
    """Long scored stream ``(model, *keep, prediction, probability)``."""
    return score_pipelines(df, pipelines, keep, model_col)


def accuracy_stream(scored: DataFrame, keys: Sequence[str], label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """Running accuracy per group: ``(*keys, accuracy, samples)``.

    ``accuracy`` ignores rows without a prediction, ``samples`` counts all
    rows (as the batch ``accuracy_by``).
    """
    c = correct(label, prediction)
    agg = scored.groupBy(*keys).agg(F.sum(c).alias("_ok"), F.count(c).alias("_scored"),
                                    F.count(F.lit(1)).alias("samples"))
    return agg.select(*keys, (F.col("_ok") / F.col("_scored")).alias("accuracy"), "samples")


def start(df: DataFrame, name: str, checkpoint_location: str, fmt: str = "memory", path: str | None = None,
          output_mode: str = "update", available_now: bool = True, options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start a streaming query.  ``available_now`` processes what is there
    and stops (batch-like catch-up); otherwise it runs until stopped."""
    writer = (df.writeStream.format(fmt).outputMode(output_mode).queryName(name)
              .option("checkpointLocation", checkpoint_location))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()
