"""Corpus pipeline: five stages from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its
predecessor kept.  All but the last return the columns of ``documents``.
Rows are kept or dropped one by one; ``doc_id`` may be null or repeat, and
documents may have further columns of any name.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.llm import exact_dedup, packing, simhash, suffix_dedup, toxicity
from errlens.llm.common import read_table, ship, stored
from errlens.llm.queries import BYTE_BPE, END_ID, fold
from errlens.session import ensure_checkpoint_dir


def placed(docs: DataFrame) -> tuple[DataFrame, str, str, tuple[str, ...]]:
    """``docs`` with columns named by place, so that none can meet a name of an operator; its id, its text, all columns."""
    names = tuple(f"_d{k}" for k in range(len(docs.columns)))
    return docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")], names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject (score under one half)."""
    ship(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), fold("id") != 0)
    rows, own, text, names = placed(docs)
    return toxicity.tag(rows, model, own, text, columns=names).filter("score < 0.5").select(*names).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id."""
    rows, own, text, names = placed(docs)
    return exact_dedup.dedup(rows, own, text, columns=names).filter("kept").select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest doc_id (null last); of equal rows one stays."""
    ship(spark)
    return simhash.keep_first(docs, shingle=3, distance=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without long repeated strings; every document stays, n_chars follows its text."""
    ship(spark)
    rows, own, text, names = placed(docs)
    cut = suffix_dedup.remove_repeats(rows, own, text, columns=tuple(n for n in names if n not in (own, text)), as_text=True)
    cut = cut.withColumnsRenamed({"id": own, "kept": text})
    if "n_chars" in docs.columns:
        cut = cut.withColumn(names[docs.columns.index("n_chars")], F.length(text).cast("long"))
    return cut.select(*names).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024 tokens."""
    ship(spark)
    cut = packing.pieces(docs, public_tokenizers.path(BYTE_BPE), END_ID)
    in_sequences = packing.pack(cut.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return in_sequences.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

# Toxicity, SimHash components, suffix arrays and packing are beyond SQL;
# tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
