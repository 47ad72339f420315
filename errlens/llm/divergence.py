"""Audit of how term use differs between the sources of a language (operator 13).

Method: for the kept terms of a language, every group (language, source) has
a level for each term: how often the term occurs there, zero included.  A
block of terms is a 0/1 matrix with a column for each (group, level) that
occurs in it.  The product of its transpose with itself counts, for each
two groups, the terms with level c in one and level d in the other: all
joint tables at once.  A pair of groups is priced on its joint tables, the
sum over the cells of terms x |p(c) - p(d)|, so no term is looked at pair
by pair.

* The terms of a block are sorted by how often they occur, so that rare
  terms, most of them, share few levels; the matrices grow smaller where
  levels differ.  Products run over blocks of at most ``COLUMNS`` columns.
  Entries are counts of at most 8192 terms and so exact in single precision.
* Shares are whole parts of 10^9, worked out in integers, by three digits
  at a time where a product could pass 64 bits.
* Terms are counted in each task by (language, source), up to a bounded
  number of entries, so a term, source or language that most documents
  share reaches the shuffle as one row a task.
* Blocks of terms hold ``CELLS`` (term, group) cells, and as many terms as
  groups at least; the group sizes reach them in a cogroup.  A pair leaves a
  block as one number.

The result has a row for each ordered pair of sources of a language, so the
number of sources of a language must be one that can be squared.

Cases: null text, language and source are empty strings; a language in
which no term is in enough documents has pairs of value 0 and no term rows;
a source without terms has the share of unseen terms; repeated rows count
as often as they occur; the id is never read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from errlens.llm.common import SALTS, out_batch, pick, stored, text_batches

MIN_DOCS = 30
SMOOTH = 5
PARTS = 1_000_000_000
TOP = 50
ENTRIES = 400_000           # counters of a task before they are sent on
CELLS = 1 << 16             # (term, group) cells of a block, or the square of the groups if that is more
COLUMNS = 1024              # columns of a factor of a product
TERMS = 8192                # most terms of a product
# ASCII letters in lower case and all bytes of other characters; the rest are blanks
_FOLD = bytes(c if c >= 128 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


# ---------------------------------------------------------------- counting

def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                entries: int = ENTRIES) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``docs`` documents, as partial rows of each task."""
    rows = pick(df, text=text_col, lang=lang_col, source=source_col).select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))

    def rows_of(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                terms = list(n)
                yield out_batch(lang=pa.array([lang] * len(terms)), source=pa.array([source] * len(terms)),
                                term=pa.array(terms, pa.binary()).cast(pa.string()), n=pa.array(n.values(), pa.int64()),
                                docs=pa.array([docs[t] for t in terms], pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in text_batches(batches):
            texts = b.column("text").cast(pa.binary())
            for text, lang, source in zip(texts, b.column("lang").to_pylist(), b.column("source").to_pylist()):
                words = text.as_py().translate(_FOLD).split()
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(words)
                docs.update(set(words))
                size += len(n)
                if size > entries:
                    yield from rows_of(held)
                    held, size = {}, 0
        yield from rows_of(held)

    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_cells(partial: DataFrame, min_docs: int) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n``, ``n_lang`` (in the language) and ``first`` (1 in one row of each term)."""
    cells = (partial.repartition("lang", "term").groupBy("lang", "term", "source")
             .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")
    return (cells.withColumns({"n_lang": F.sum("n").over(term), "docs": F.sum("docs").over(term),
                               "first": (F.row_number().over(term.orderBy("source")) == 1).cast("int")})
            .filter(F.col("docs") >= min_docs).drop("docs"))


def group_sizes(df: DataFrame, cells: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``g`` (its place), ``own`` (kept occurrences), and of the language ``groups``, ``v`` (terms), ``whole``."""
    every = (pick(df, lang=lang_col, source=source_col)
             .select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct())
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.sum("first").alias("v"))
    lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    return (every.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("own", zero).alias("own"), F.coalesce("v", zero).alias("v"))
            .select("lang", "source", (F.row_number().over(lang.orderBy("source")) - 1).alias("g"), "own",
                    F.count(F.lit(1)).over(lang).alias("groups"), F.sum("v").over(lang).alias("v"), F.sum("own").over(lang).alias("whole")))


# ---------------------------------------------------------------- level products

def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 x count / whole) for 0 <= count <= whole < 9 x 10^15."""
    out, rest = np.zeros(len(count), np.int64), count.astype(np.int64)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digits
    return out + 1


def level_blocks(levels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Column of each (term, group), and group and level of each column, for blocks of the rows of ``levels`` (terms x groups)."""
    levels = levels[np.argsort(levels.sum(axis=1), kind="stable")]
    groups, at, size = levels.shape[1], 0, TERMS
    while at < len(levels):
        part = levels[at:at + size]
        width = int(part.max()) + 1
        keys, column = np.unique(part + np.arange(groups) * width, return_inverse=True)
        if len(keys) > COLUMNS and size > 32:
            size //= 2
            continue
        yield column.reshape(part.shape), keys // width, keys % width
        at += size


def column_blocks(group: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of columns of whole groups, of at most ``COLUMNS`` columns where a group allows it."""
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]).tolist()
    out, lo = [], 0
    for a, b in zip(cuts, cuts[1:]):
        if b - lo > COLUMNS and a > lo:
            out.append((lo, a))
            lo = a
    return [*out, (lo, len(group))]


def joint_counts(column: np.ndarray, group: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """The blocks on and above the diagonal of X'X, X the 0/1 matrix of a block of terms."""
    ranges = column_blocks(group)
    places = np.repeat(np.arange(len(column)), column.shape[1])
    flat = column.ravel()

    def indicators(lo: int, hi: int) -> np.ndarray:
        x = np.zeros((len(column), hi - lo), np.float32)
        mine = (flat >= lo) & (flat < hi)
        x[places[mine], flat[mine] - lo] = 1
        return x

    for i, (lo, hi) in enumerate(ranges):
        left = indicators(lo, hi)
        for j, (lo2, hi2) in enumerate(ranges[i:]):
            right = left if j == 0 else indicators(lo2, hi2)
            yield slice(lo, hi), slice(lo2, hi2), left.T @ right


def _levels(cells: pa.Table, groups: int) -> np.ndarray:
    """Terms x groups matrix of a block's counts."""
    term = cells.column("term").combine_chunks().dictionary_encode()
    out = np.zeros((len(term.dictionary), groups), np.int64)
    out[term.indices.to_numpy(), cells.column("place").to_numpy()] = cells.column("n").to_numpy()
    return out


def priced(levels: np.ndarray, whole: np.ndarray, smooth: int) -> np.ndarray:
    """Sum over terms of |p - q| for each two groups (groups x groups)."""
    out = np.zeros((len(whole), len(whole)), np.int64)
    for column, group, level in level_blocks(levels):
        p = shares(level + smooth, whole[group])
        for a, b, n in joint_counts(column, group):
            value = n.astype(np.int64) * np.abs(p[a, None] - p[None, b])
            starts = [np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) for g in (group[a], group[b])]
            value = np.add.reduceat(np.add.reduceat(value, starts[0], axis=0), starts[1], axis=1)
            out[np.ix_(group[a][starts[0]], group[b][starts[1]])] += value
    return out


def _blocks(cells: DataFrame, sizes: DataFrame, cells_per_block: int) -> tuple[DataFrame, DataFrame]:
    """Cells and group sizes by ``lang`` and ``block``."""
    counted = sizes.withColumn("blocks", F.greatest(F.ceil(
        F.col("v") * F.col("groups") / F.greatest(F.lit(cells_per_block), F.col("groups") * F.col("groups"))), F.lit(1)).cast("long"))
    salted = counted.select("lang", "source", "g", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    left = (cells.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(salted, ["lang", "source", "salt"])
            .select("lang", F.pmod(F.xxhash64(F.lit(7), F.col("term")), F.col("blocks")).alias("block"), "term", F.col("g").alias("place"), "n"))
    right = counted.filter("v > 0").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "g", "own", "v")
    return left, right


def pair_values(cells: DataFrame, sizes: DataFrame, smooth: int = SMOOTH, cells_per_block: int = CELLS) -> DataFrame:
    """``lang``, ``g``, ``h`` (g < h), ``value`` for the groups of each language that has terms."""
    left, right = _blocks(cells, sizes, cells_per_block)

    def run(cells: pa.Table, groups: pa.Table) -> pa.Table:
        own = groups.sort_by("g")
        if cells.num_rows:
            whole = own.column("own").to_numpy() + smooth * own.column("v").to_numpy()
            value = priced(_levels(cells, len(whole)), whole, smooth)
            g, h = np.triu_indices(len(whole), 1)
            lang = pa.array([cells.column("lang")[0].as_py()] * len(g), pa.string())
            return pa.table({"lang": lang, "g": pa.array(g, pa.int32()), "h": pa.array(h, pa.int32()), "value": pa.array(value[g, h])})
        return pa.schema([("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("value", pa.int64())]).empty_table()

    part = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(run, "lang string, g int, h int, value long")
    return part.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def joint_tables(cells: DataFrame, sizes: DataFrame, cells_per_block: int = CELLS) -> DataFrame:
    """The joint tables themselves: ``lang``, ``source``, ``level``, ``other``, ``other_level``, ``terms`` (source < other in place)."""
    left, right = _blocks(cells, sizes, cells_per_block)
    names = ("g", "level", "h", "other_level", "terms")

    def run(cells: pa.Table, groups: pa.Table) -> pa.Table:
        found = {n: [np.zeros(0, np.int64)] for n in names}
        if cells.num_rows:
            for column, group, level in level_blocks(_levels(cells, groups.num_rows)):
                for a, b, n in joint_counts(column, group):
                    x, y = np.nonzero(n * (group[a, None] < group[None, b]))
                    for name, v in zip(names, (group[a][x], level[a][x], group[b][y], level[b][y], n[x, y].astype(np.int64))):
                        found[name].append(v)
        cols = {n: np.concatenate(v) for n, v in found.items()}
        lang = cells.column("lang")[0].as_py() if cells.num_rows else ""
        return pa.table({"lang": pa.array([lang] * len(cols["g"]), pa.string()), **{n: pa.array(v) for n, v in cols.items()}})

    part = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(
        run, "lang string, g long, level long, h long, other_level long, terms long")
    part = part.groupBy("lang", "g", "level", "h", "other_level").agg(F.sum("terms").alias("terms"))
    name = sizes.select("lang", "source", "g")
    return (part.join(name, ["lang", "g"]).join(name.select("lang", F.col("source").alias("other"), F.col("g").alias("h")), ["lang", "h"])
            .select("lang", "source", "level", "other", "other_level", "terms"))


# ---------------------------------------------------------------- report

def _share(count: Column, whole: Column) -> Column:
    """1 + floor(10^9 x count / whole), exact beyond 64 bits."""
    wide = count.cast("decimal(27,0)") * F.lit(PARTS).cast("decimal(10,0)")
    return F.call_function("div", wide, whole.cast("decimal(27,0)")) + F.lit(1)


def audit(df: DataFrame, min_docs: int = MIN_DOCS, smooth: int = SMOOTH, top: int = TOP, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source", cells_per_block: int = CELLS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    cells = stored(kept_cells(term_counts(df, text_col, lang_col, source_col), min_docs), "divergence-cells")
    sizes = stored(group_sizes(df, cells, lang_col, source_col), "divergence-groups")

    values = stored(pair_values(cells, sizes, smooth, cells_per_block), "divergence-pairs")
    names = sizes.select("lang", "source", "g")
    both = names.join(names.select("lang", F.col("source").alias("item"), F.col("g").alias("h")), "lang").filter("g <> h")
    both = both.select("lang", "source", "item", F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h"))
    pairs = (both.join(values, ["lang", "g", "h"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))

    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    own = cells.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(
        sizes.select("lang", "source", "own", "v", "whole", salts), ["lang", "source", "salt"])
    p = _share(F.col("n") + smooth, F.col("own") + smooth * F.col("v"))
    q = _share(F.col("n_lang") + smooth, F.col("whole") + smooth * F.col("v"))
    terms = (own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value"))
             .filter("value > 0"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms)
