"""Exact deduplication by progressive refinement (operator 10), DataFrame functions only.

Method: rows are grouped by the length of their normalised text, then
within shared lengths by a hash of a prefix, then within shared (length,
prefix hash) by a hash of the full text.  The full text is hashed (SHA-256)
only for rows that the two levels before left in a group of two or more.

The first two levels are counts with map-side combine.  What a level hands
to the next scan is a bitmap of its surviving keys with a fixed number of
bits, read as a scalar subquery, so no text is shuffled and nothing that
grows with the data is broadcast.  A bit that two keys share only lets a
row through that the next level counts as alone.  The last level keeps its
groups per salt, so a group with a third of all rows reaches the join as
many keys.  No group is gathered.

Cases: null counts as empty; texts are equal if they are so after each run
of white space becomes one space; of equal texts the smallest id stays, null
ids last, and of rows that repeat that id the first of the stored table, so
one row of a group stays in any case; ``keep_id`` is null only where all ids
of a group are; texts of any length are compared whole (their SHA-256); an
empty table gives an empty result; extra columns, of whatever names, are left
out or stay with their rows if named in ``columns``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errlens.llm.common import group_stats, pick, salt, stored

PREFIX = 64
WORDS = 1 << 16             # longs in a bitmap
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _bit(keys: list[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(64 * words))


def _survivors(rows: DataFrame, keys: list[str], words: int) -> Column:
    """Bitmap (array of longs, scalar subquery) of the keys that occur more than once."""
    at = _bit(keys, words)
    again = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select(F.shiftright(at, 6).alias("word"), F.pmod(at, F.lit(64)).cast("int").alias("b"))
             .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b"))).alias("bits")))
    every = rows.sparkSession.range(words).withColumnRenamed("id", "word")
    cells = every.join(again, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("c"))
    return (cells.agg(F.sort_array(F.collect_list("c")).alias("c"))
            .select(F.transform("c", lambda x: x["bits"]).alias("bits")).scalar())


def _among(bitmap: Column, keys: list[str], words: int) -> Column:
    at = _bit(keys, words)
    word = F.get(bitmap, F.shiftright(at, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, F.pmod(at, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, words: int = WORDS,
          carry: dict[str, Column] | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``keep_id``, ``group_size``, ``kept``, one row per row of ``df``.

    ``carry`` adds columns computed from ``t``, the normalised text, in the
    last scan; ``columns`` names columns of ``df`` that stay with their rows.
    """
    own = {f"x{k}": c for k, c in enumerate(columns)}
    rows = pick(df, id=id_col, text=text_col, **own).withColumn("t", normalised(F.col("text"))).withColumn("size", F.length("t"))
    by_size = _survivors(rows.select("size"), ["size"], words)
    headed = (rows.filter(_among(by_size, ["size"], words))
              .select("size", F.xxhash64(F.substring("t", 1, prefix)).alias("head")))
    by_head = _survivors(headed, ["size", "head"], words)
    last = rows.withColumn("head", F.xxhash64(F.substring("t", 1, prefix)))
    full = F.when(_among(by_head, ["size", "head"], words), F.sha2("t", 256))
    extra = [*(carry or {}), *own]
    # a row is told apart from its repetitions by its place in the stored table
    who = F.struct(F.col("id").isNull().alias("none"), "id", F.monotonically_increasing_id().alias("at"))
    level = stored(last.select("id", full.alias("full"), *(c.alias(n) for n, c in (carry or {}).items()), *own)
                   .withColumn("who", who).withColumn("salt", salt(F.col("who.at"))), "exact-level")
    open_ = level.filter("full IS NOT NULL")
    groups = group_stats(open_.select("full", "salt", "who"), ["full"], "who").filter("group_size > 1")
    found = open_.join(groups, ["full", "salt"], "left")
    alone = level.filter("full IS NULL").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                F.lit(True).alias("kept"), *extra)
    single = F.col("group_size").isNull()
    both = found.select("id", F.when(single, F.col("id")).otherwise(F.col("lowest.id")).alias("keep_id"),
                        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        (single | F.col("who").eqNullSafe(F.col("lowest"))).alias("kept"), *extra)
    return alone.unionByName(both).withColumnsRenamed(own)
