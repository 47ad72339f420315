"""Error analysis: accuracy by group, confusion matrix, histogram, density, top-k.

All aggregations are hash aggregates with a map-side partial step, so a hot
group (one user holding a third of the rows) is pre-reduced in every task
before the shuffle and never lands whole in one task.  Where a second step
needs per-group statistics (histogram range, KDE bandwidth), the statistics
come first.  Of at most ``FEW_GROUPS`` groups they are broadcast to the scan,
which counts bins or sums moments in place, so no value moves.  With more
groups, and for the exact density, rows are reduced to (group, value, count)
and meet the statistics in a null-safe join on a salted key, so neither
unreduced rows nor a hot group's values gather in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from errlens.functions.columns import correct
from errlens.session import scratch_path

# Keys into which the distinct values of one group are dealt for a join.
SALTS = 32
# Groups whose statistics (one row each) may be broadcast.
FEW_GROUPS = 4096
# Half the width of a moment cell, in bandwidths.
HALF_CELL = 0.5
# Grid points of a density that one row of sums holds.
LANE = 20


def _cols(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def with_correct(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 out: str = "correct") -> DataFrame:
    return df.withColumn(out, correct(label, prediction))


def accuracy_by(df: DataFrame, keys: Sequence[str] | str, label: str = "label",
                prediction: str = "prediction", count_col: str | None = "samples",
                order: str | None = "asc", tie_break: bool = True,
                min_samples: int = 0) -> DataFrame:
    """``avg(correct)`` (and ``count(*)``) per group, optionally sorted by accuracy.

    ``avg`` ignores rows whose prediction is null while ``count(*)`` counts
    them.  ``order='asc'``/``'desc'`` sorts by accuracy with the group keys
    as tie-break; ``order='keys'`` sorts by the keys; ``None`` leaves the
    result unsorted.  ``min_samples`` drops groups smaller than that.
    """
    keys = _cols(keys)
    aggs = [F.avg(correct(label, prediction)).alias("accuracy")]
    if count_col or min_samples:
        aggs.append(F.count(F.lit(1)).alias(count_col or "_n"))
    out = df.groupBy(*keys).agg(*aggs)
    if min_samples:
        out = out.filter(F.col(count_col or "_n") >= min_samples)
        if not count_col:
            out = out.drop("_n")
    if order == "asc":
        out = out.orderBy(F.asc("accuracy"), *(keys if tie_break else []))
    elif order == "desc":
        out = out.orderBy(F.desc("accuracy"), *(keys if tie_break else []))
    elif order == "keys":
        out = out.orderBy(*keys)
    elif order is not None:
        raise ValueError("order must be 'asc', 'desc', 'keys' or None")
    return out


def bottom_k(df: DataFrame, key: str, k: int = 10, label: str = "label",
             prediction: str = "prediction", count_col: str = "samples",
             min_samples: int = 0) -> DataFrame:
    """The ``k`` groups with the lowest accuracy, ties by key.

    ``orderBy`` + ``limit`` plans as ``TakeOrderedAndProject``: each task
    keeps its own top k, only k rows per task reach the final merge.
    """
    return accuracy_by(df, key, label, prediction, count_col, "asc", True, min_samples).limit(k)


def bottom_k_by(df: DataFrame, by: Sequence[str] | str, key: str, k: int = 10, label: str = "label",
                prediction: str = "prediction", count_col: str = "samples",
                min_samples: int = 0) -> DataFrame:
    """The ``k`` lowest-accuracy ``key`` groups within each ``by`` group
    (ties by key), with their rank.  See :func:`lowest_k_by`."""
    by = _cols(by)
    per_key = accuracy_by(df, by + [key], label, prediction, count_col, order=None, min_samples=min_samples)
    return lowest_k_by(per_key, by, key, k)


def lowest_k_by(per_key: DataFrame, by: Sequence[str] | str, key: str, k: int = 10,
                metric: str = "accuracy") -> DataFrame:
    """Rows with the ``k`` lowest ``metric`` within each ``by`` group of an
    already aggregated table (ties by ``key``), with a ``rank`` column.

    ``row_number`` filtered to ``<= k`` is planned as a two-stage group
    limit: every task keeps its own k lowest per group before the shuffle
    (``WindowGroupLimit Partial``), so a group with millions of keys sends
    at most k rows per task to its final ranking task.
    """
    by = _cols(by)
    w = Window.partitionBy(*by).orderBy(F.asc(metric), F.asc(key))
    return per_key.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def accuracy_overall(df: DataFrame, by: Sequence[str] | str | None = None, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Share of rows with ``label == prediction``, per group in one pass."""
    return accuracy_by(df, _cols(by), label, prediction, count_col="samples", order=None)


def evaluator_accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """MLlib's evaluator, for parity with code that uses it (one job)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(df)


def accuracy_grouping_sets(df: DataFrame, dims: Sequence[str], label: str = "label",
                           prediction: str = "prediction", by: Sequence[str] | str | None = None) -> DataFrame:
    """Accuracy by each dimension and overall, in one scan and one shuffle.

    Output ``(*by, dim, value, accuracy, samples)``: ``dim`` names the
    grouping (``'all'`` for the total), ``value`` is the group's key as text.
    """
    by = _cols(by)
    dims = list(dims)
    sets = [by + [d] for d in dims] + [by]
    # the raw rows are reduced once; only the reduced ones are repeated per set
    ok = correct(label, prediction)
    reduced = df.groupBy(*by, *dims).agg(F.sum(ok).alias("_ok"), F.count(ok).alias("_scored"), F.count(F.lit(1)).alias("_n"))
    return _accuracy_of_reduced(reduced, by, dims, sets)


def reduce_predictions(df: DataFrame, dims: Sequence[str], label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] | str | None = None) -> DataFrame:
    """``(*by, *dims, actual, predicted, n)``: all that accuracy tables and confusion matrices need of the rows."""
    return (df.groupBy(*_cols(by), *dims, F.col(label).cast("double").alias("actual"), F.col(prediction).cast("double").alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def grouping_sets_of(reduced: DataFrame, dims: Sequence[str], by: Sequence[str] | str | None = None) -> DataFrame:
    """:func:`accuracy_grouping_sets` from the table of :func:`reduce_predictions`."""
    by, dims = _cols(by), list(dims)
    ok = (F.col("actual") == F.col("predicted")).cast("int")
    counted = reduced.select(*by, *dims, (ok * F.col("n")).alias("_ok"), F.when(ok.isNotNull(), F.col("n")).alias("_scored"), F.col("n").alias("_n"))
    return _accuracy_of_reduced(counted, by, dims, [by + [d] for d in dims] + [by])


def confusion_of(reduced: DataFrame, by: Sequence[str] | str | None = None) -> DataFrame:
    """:func:`confusion_matrix` from the table of :func:`reduce_predictions`."""
    by = _cols(by)
    return _confusion_grid(reduced.groupBy(*by, "actual", "predicted").agg(F.sum("n").alias("n")), by)


def _accuracy_of_reduced(reduced: DataFrame, by: list[str], dims: list[str], sets: list[list[str]]) -> DataFrame:
    g = reduced.groupingSets(sets, *(by + dims)).agg(
        (F.sum("_ok") / F.sum("_scored")).alias("accuracy"), F.sum("_n").alias("samples"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dim_expr = F.lit("all")
    val_expr = F.lit(None).cast("string")
    for d in reversed(dims):
        dim_expr = F.when(F.col(f"_g_{d}") == 0, F.lit(d)).otherwise(dim_expr)
        val_expr = F.when(F.col(f"_g_{d}") == 0, F.col(d).cast("string")).otherwise(val_expr)
    return g.select(*by, dim_expr.alias("dim"), val_expr.alias("value"), "accuracy", "samples")


def row_counts(df: DataFrame, bucket: str = "bucket", test_from: int = 8000,
               scored: str | None = None) -> DataFrame:
    """All / test / train (and optionally scored) row counts in one pass."""
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col(bucket) >= test_from).alias("test_rows"),
            F.count_if(F.col(bucket) < test_from).alias("train_rows")]
    if scored:
        aggs.append(F.count(F.col(scored)).alias("scored_rows"))
    return df.agg(*aggs)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: Sequence[str] | str | None = None) -> DataFrame:
    """Dense confusion table ``(*by, actual, predicted, n)``; zero cells kept.

    One partially aggregated shuffle of the data gives the non-empty cells.
    The classes of a group are the distinct labels and predictions of those
    cells, the grid is that table joined with itself on the group, and the
    counts join the grid: no list is gathered and any number of classes
    works (the grid has classes² cells, which is the result asked for).
    Rows with a null prediction are not counted (as in the accuracy), but
    their label still counts as a class.
    """
    by = _cols(by)
    counts = (df.groupBy(*by, F.col(label).cast("double").alias("actual"),
                         F.col(prediction).cast("double").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    return _confusion_grid(counts, by)


def _confusion_grid(counts: DataFrame, by: list[str]) -> DataFrame:
    one = counts if by else counts.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    cls = one.select(*keys, F.explode(F.array("actual", "predicted")).alias("c")).filter("c IS NOT NULL").distinct()
    a, p, n = cls.alias("a"), cls.alias("p"), one.alias("n")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    grid = a.join(p, _all(same)).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.c").alias("actual"), F.col("p.c").alias("predicted")).alias("g")
    cell = [F.col(f"g.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys] + [F.col(f"g.{k}") == F.col(f"n.{k}") for k in ("actual", "predicted")]
    return grid.join(n, _all(cell), "left").select(*[F.col(f"g.{k}").alias(k) for k in by], "g.actual", "g.predicted",
                                                   F.coalesce(F.col("n.n"), F.lit(0)).cast("bigint").alias("n"))


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def confusion_pivot(df: DataFrame, label: str = "label", prediction: str = "prediction",
                    classes: Sequence[float] = (0.0, 1.0),
                    by: Sequence[str] | str | None = None) -> DataFrame:
    """Confusion matrix as one row per true class and one column per
    predicted class (``pred_<k>``); the class list is given, so the pivot
    needs no extra pass to discover it.

    Every row is accounted for: ``pred_other`` counts predictions outside
    the list (and missing ones), and labels outside it (and missing ones)
    share one row whose ``actual`` is null.
    """
    by = _cols(by)
    given = [float(c) for c in classes]
    p, a = F.col(prediction).cast("double"), F.col(label).cast("double")
    aggs = [F.count_if(p == F.lit(c)).alias(f"pred_{int(c)}") for c in given]
    other = F.count_if(~F.coalesce(p.isin(given), F.lit(False))).alias("pred_other")
    return df.groupBy(*by, F.when(a.isin(given), a).alias("actual")).agg(*aggs, other)


def _reduced(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``(*by, _x, _w)``: the distinct values of each group and their counts."""
    x = F.col(value).cast("double")
    return (df.select(*by, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
            .groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_w")))


def _attach(data: DataFrame, stats: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Add per-group statistics to the reduced rows.

    With group keys: a null-safe join on the key and a salt of the value
    (the statistics, one row per group, are repeated per salt).  Without:
    the single statistics row enters as scalar subqueries (merged into one
    subquery by the optimizer), so no join is planned at all.
    """
    if by:
        d = data.withColumn("_salt", F.pmod(F.xxhash64("_x"), F.lit(SALTS))).alias("d")
        t = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).alias("t")
        on = [F.col(f"d.{k}").eqNullSafe(F.col(f"t.{k}")) for k in by] + [F.col("d._salt") == F.col("t._salt")]
        return d.join(t, _all(on)).select("d.*", *[F.col(f"t.{c}") for c in cols]).drop("_salt")
    return data.select("*", *[stats.select(c).scalar().alias(c) for c in cols]).filter(
        F.col(cols[0]).isNotNull())


def _values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``(*by, _x)`` of the rows that have a value."""
    x = F.col(value).cast("double")
    return df.select(*by, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))


def _held(stats: DataFrame) -> tuple[DataFrame, bool]:
    """Statistics of groups, written once, and whether their groups are few."""
    path = scratch_path(stats.sparkSession, "group-statistics")
    stats.write.parquet(path)
    back = stats.sparkSession.read.schema(stats.schema).parquet(path)
    return back, back.count() <= FEW_GROUPS


def _in_place(rows: DataFrame, stats: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Rows with the statistics of their group (few groups), without moving a row."""
    if not by:
        return _attach(rows, stats, by, cols)
    d, t = rows.alias("d"), F.broadcast(stats).alias("t")
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"t.{k}")) for k in by]
    return d.join(t, _all(on)).select("d.*", *[F.col(f"t.{c}") for c in cols])


def _edge(lo: Column, hi: Column, i: Column, bins: int) -> Column:
    # numpy.linspace: lo + i * ((hi - lo) / bins), with the last edge = hi exactly
    return F.when(i >= F.lit(bins), hi).otherwise(lo + i.cast("double") * ((hi - lo) / F.lit(float(bins))))


def histogram(df: DataFrame, value: str, bins: int = 30, by: Sequence[str] | str | None = None) -> DataFrame:
    """Equal-width histogram over ``[min, max]`` per group, ``numpy.histogram``
    rules: the last bin is closed, and ``min == max`` widens the range to
    ``[v - 0.5, v + 0.5]``.  All ``bins`` bins are returned, empty ones with 0.

    Output ``(*by, bin, bin_lo, bin_hi, n)``; a null group key is a group.
    The ranges come first, then the bins are counted in the scan and only
    the counters move.  With more than ``FEW_GROUPS`` groups rows are reduced
    to distinct values, which move.
    """
    by = _cols(by)
    rows = _values(df, value, by)
    raw = rows.groupBy(*by).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    stats = raw.select(*by,
                       F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                       F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    stats, few = _held(stats) if by else (stats, True)
    lo, hi = F.col("_lo"), F.col("_hi")
    if few:
        joined = _in_place(rows, stats, by, ["_lo", "_hi"]).withColumn("_w", F.lit(1))
    else:
        joined = _attach(_reduced(df, value, by), stats, by, ["_lo", "_hi"])
    # First guess as numpy: (x - lo) * (bins / (hi - lo)), then correct by the edges.
    guess = F.least(F.floor((F.col("_x") - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int"), F.lit(bins - 1))
    binned = joined.select(*by, "_x", "_w", "_lo", "_hi", guess.alias("_i0"))
    i0 = F.col("_i0")
    idx = (i0 - F.when(F.col("_x") < _edge(lo, hi, i0, bins), 1).otherwise(0)
           + F.when((F.col("_x") >= _edge(lo, hi, i0 + 1, bins)) & (i0 != bins - 1), 1).otherwise(0))
    counts = binned.groupBy(*by, idx.alias("bin")).agg(F.sum("_w").alias("n"))
    if by:
        grid = stats.select(*by, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    else:
        # bin numbers only; the range enters through the same (merged)
        # scalar subquery as in the counting pass
        grid = _attach(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")),
                       stats, by, ["_lo", "_hi"])
    b = F.col("bin")
    g, c = grid.alias("g"), counts.alias("c")
    on = [F.col(f"g.{k}").eqNullSafe(F.col(f"c.{k}")) for k in by] + [F.col("g.bin") == F.col("c.bin")]
    both = g.join(c, _all(on), "left").select("g.*", F.col("c.n").alias("n"))
    return (both.select(*by, b, _edge(lo, hi, b, bins).alias("bin_lo"), _edge(lo, hi, b + 1, bins).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def hermite_order(tolerance: float) -> int:
    """Terms of the expansion of a kernel about the middle of its cell that keep its error below ``tolerance``.

    For u within the half cell a, ``exp(-(t-u)²/2)`` is the sum over k of
    ``He_k(t)·exp(-t²/2)·u^k / k!``; Cramér's inequality bounds the first
    factor by ``1.0865·sqrt(k!)``, so the terms from k on add up to at most
    ``1.0865·sum(a^k / sqrt(k!))``.
    """
    if not 1e-14 <= tolerance < 1:
        raise ValueError("tolerance must lie between 1e-14, where rounding begins, and 1")
    terms = [1.0865 * HALF_CELL ** k / math.sqrt(math.factorial(k)) for k in range(60)]
    return next(p for p in range(1, 60) if sum(terms[p:]) <= tolerance)


def _hermite(order: int) -> list[list[float]]:
    """Coefficients of He_0 to He_(order-1), lowest power first."""
    polys = [[1.0], [0.0, 1.0]]
    for k in range(1, order - 1):
        up, down = [0.0, *polys[k]], [*polys[k - 1], 0.0, 0.0]
        polys.append([u - k * d for u, d in zip(up, down)])
    return polys[:order]


def _moments(rows: DataFrame, by: list[str], stats: list[str], order: int) -> DataFrame:
    """``(*by, *stats, _x, _c0 …)``: middle of each cell and the polynomial that its values' kernels add up to."""
    h = F.col("_h")
    width = F.lit(2 * HALF_CELL) * h
    cell = F.floor(F.col("_x") / width)
    middle = (cell.cast("double") + F.lit(0.5)) * width
    u = (F.col("_x") - middle) / h
    cut = rows.select(*by, *stats, "_w", cell.alias("_cell"), u.alias("_u"))
    power, sums = F.col("_w").cast("double"), []
    for k in range(order):
        sums.append(F.sum(power / F.lit(float(math.factorial(k)))).alias(f"_m{k}"))
        power = power * F.col("_u")
    cells = cut.groupBy(*by, *stats, "_cell").agg(*sums)
    polys = _hermite(order)
    coefficients = []
    for j in range(order):
        c = F.lit(0.0)
        for k in range(j, order):
            if polys[k][j]:
                c = c + F.lit(polys[k][j]) * F.col(f"_m{k}")
        coefficients.append(c.alias(f"_c{j}"))
    return cells.select(*by, *stats, ((F.col("_cell").cast("double") + F.lit(0.5)) * width).alias("_x"), *coefficients)


def kde(df: DataFrame, value: str, by: Sequence[str] | str | None = None, grid_size: int = 200,
        cut: float = 3.0, decimals: int | None = None, counts_bins: int | None = None,
        tolerance: float | None = None) -> DataFrame:
    """Gaussian kernel density per group on an evenly spaced grid, exact unless a ``tolerance`` is given.

    Bandwidth by Scott's rule, ``h = stddev_samp · n^(-1/5)``; the grid runs
    from ``min - cut·h`` to ``max + cut·h`` in ``grid_size`` points (the
    defaults of common plotting libraries).  Groups with zero spread or
    fewer than two values have no bandwidth and give no rows; a null group
    key is a group.

    Rows are reduced to ``(group, distinct value, count)``, and each group's
    kernel sums, ``LANE`` grid points to a row, are the columns of one
    aggregate over those, so a value is repeated once per lane and only
    ``groups × grid_size`` partial sums per task move.  ``counts_bins`` scales the density to the
    counts of a histogram with that many bins (the overlay of a histogram,
    together with ``cut=0``).

    With ``tolerance`` the density differs from the exact one by at most that
    share of ``1 / (h·sqrt(2·pi))``, the height of one kernel and the most a
    density can be.  The values of a cell one bandwidth wide are then summed
    up as moments in the scan, and the kernels of the cell's values are read
    off a Hermite expansion about its middle, so ``groups × cells × order``
    numbers move instead of the values.  The order follows from the
    tolerance (:func:`hermite_order`).

    Output ``(*by, point, x, density)``.
    """
    by = _cols(by)
    order = None if tolerance is None else hermite_order(tolerance)
    rows = _values(df, value, by)
    # spread straight from the rows: stddev_samp merges partial moments
    # stably (no sum-of-squares cancellation)
    sd = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
                               F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    scale = (F.col("_mx") - F.col("_mn")) * F.col("_n") / F.lit(counts_bins) if counts_bins else F.lit(1.0)
    bw = (sd.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
          .filter((F.col("_n") >= 2) & (F.col("_h") > 0))
          .select(*by, "_n", "_h", scale.alias("_scale"),
                  (F.col("_mn") - F.lit(cut) * F.col("_h")).alias("_lo"),
                  (F.col("_mx") + F.lit(cut) * F.col("_h")).alias("_hi")))
    stats = ["_n", "_h", "_scale", "_lo", "_hi"]
    if order is None:
        joined = _attach(_reduced(df, value, by), bw, by, stats)
    else:
        bw, few = _held(bw) if by else (bw, True)
        placed = _in_place(rows, bw, by, stats).withColumn("_w", F.lit(1)) if few else _attach(_reduced(df, value, by), bw, by, stats)
        joined = _moments(placed, by, stats, order)
    # a lane holds LANE neighbouring grid points: few enough sums for
    # generated code, and each value is repeated once per lane, not per point
    lanes = -(-grid_size // LANE)
    lane = F.col("_lane").cast("double") * F.lit(float(LANE))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(grid_size - 1))

    def at(j: int) -> Column:
        i = lane + F.lit(float(j))
        return F.when(i == grid_size - 1, F.col("_hi")).otherwise(F.col("_lo") + i * step)

    def kernel(j: int) -> Column:
        z = (at(j) - F.col("_x")) / F.col("_h")
        peak = F.exp(F.lit(-0.5) * z * z)
        if order is None:
            return F.sum(F.col("_w") * peak).alias(f"_k{j}")
        poly = F.col(f"_c{order - 1}")
        for k in range(order - 2, -1, -1):
            poly = poly * z + F.col(f"_c{k}")
        # beyond 38 bandwidths a kernel is below the smallest double
        return F.sum(F.when(F.abs(z) < 38, poly * peak).otherwise(F.lit(0.0))).alias(f"_k{j}")

    repeated = joined.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    sums = repeated.groupBy(*by, *stats, "_lane").agg(*[kernel(j) for j in range(LANE)])
    points = F.array(*[F.struct((F.col("_lane") * LANE + j).alias("point"), at(j).alias("x"), F.col(f"_k{j}").alias("k")) for j in range(LANE)])
    dens = (sums.select(*by, *stats, F.inline(points)).filter(F.col("point") < grid_size)
            .select(*by, "point", "x", (F.col("k") / (F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))) * F.col("_scale")).alias("density")))
    if decimals is not None:
        dens = dens.select(*by, "point", F.round("x", decimals).alias("x"),
                           F.round("density", decimals).alias("density"))
    return dens


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
