"""Classifier training, hyper-parameter grids, feature importances.

Design points for large inputs:

* Equal training rows are counted once, and preprocessing is fitted on the
  distinct ones with their copies (``fit_features``).  The model input of
  every copy — only ``label`` and the scaled vector — is laid out and
  persisted when a fit reads it (``Prepared.train``).
* A tree sees a feature only through the bins of its split candidates, so
  boosting is fitted on distinct rows of bins weighted by their copies
  (``Prepared.binned``), whose number is bounded by the bins and not by the
  rows.  A grid scores the test part in the same bins; a model that is kept
  gets the thresholds of its bins (``unbinned``).
* Forests draw every row by itself.  Where rows are many more than distinct
  rows of bins, each tree draws how many copies of such a row it has
  (``fit_forest``), which is what the draws of its copies add up to;
  otherwise they are fitted on all rows one by one.
* ``canonical_layout`` hash-partitions and sorts the training rows by
  content before fitting.  MLlib's bootstrap (RF) and split-candidate
  sampling (RF and GBT) draw per partition, so a seed alone reproduces a
  model only on an identical layout; a content-defined layout makes the
  fit independent of how the source files happen to be split.  Exact
  copies of a row are counted first and spread over all partitions, so a
  repeated row holding a large share of the data does not make one task
  hold it.
* Grid points are evaluated in one pass: every fitted model scores the
  test part with its own output columns, and one aggregate computes all
  accuracies.  ``Prepared.cache_test`` keeps the featurised test part for
  several grids.
* Long GBT runs checkpoint to ``spark.checkpoint.dir`` every
  ``checkpointInterval`` iterations (set on the context by
  :func:`errlens.session.ensure_checkpoint_dir`), so a lost executor does
  not replay the whole boosting lineage.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from threading import RLock

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errlens.operators.features import FeatureSpec, fit_features
from errlens.session import ensure_checkpoint_dir
from errlens.sources.readers import table_from_rows

RF = "RF"
GBT = "GBT"
# Number of copies of a distinct row, counted and as the weight of a fit.
COPIES = "_copies"
WEIGHT = "_weight"
# Rows that the split candidates of a feature are taken from (MLlib itself: 10,000).
CANDIDATE_ROWS = 100_000
# Forests are fitted on distinct rows of bins from so many rows on, if there are so many times as many rows as distinct ones:
# each tree is then a fit of its own, which costs more a row and more jobs than MLlib's fit of all trees at once.
FOREST_ROWS, FOREST_GAIN = 2_000_000, 8
# Trees of such a forest that are fitted side by side.
TREES_AT_ONCE = 10


@dataclass(frozen=True)
class ModelConfig:
    """One classifier configuration.

    ``kind`` is ``'RF'`` (``trees``, ``depth``) or ``'GBT'`` (``depth``,
    ``iters``).  ``max_bins`` is the number of split candidates per feature.
    """
    kind: str
    depth: int
    trees: int | None = None
    iters: int | None = None
    max_bins: int = 32

    def label(self, short: bool = False) -> str:
        """Parameter text: ``Trees:10, Depth:3`` / ``Depth:3, Iter:10``
        (``short``: ``T:10, D:3`` / ``D:3, I:10``)."""
        if self.kind == RF:
            return f"T:{self.trees}, D:{self.depth}" if short else f"Trees:{self.trees}, Depth:{self.depth}"
        return f"D:{self.depth}, I:{self.iters}" if short else f"Depth:{self.depth}, Iter:{self.iters}"


# Grids of the reference's experiment scripts (fixed values): the small
# 2×2 grids, and the larger 3×3 grids of the full-data analysis.
SMALL_RF = dict(trees=(10, 50), depths=(3, 6))
SMALL_GBT = dict(depths=(3, 6), iters=(10, 25))
LARGE_RF = dict(trees=(10, 50, 100), depths=(3, 5, 10))
LARGE_GBT = dict(depths=(3, 5, 10), iters=(10, 20, 50))


def rf_grid(trees: Sequence[int] = SMALL_RF["trees"], depths: Sequence[int] = SMALL_RF["depths"], max_bins: int = 32) -> list[ModelConfig]:
    return [ModelConfig(RF, depth=d, trees=t, max_bins=max_bins) for t in trees for d in depths]


def gbt_grid(depths: Sequence[int] = SMALL_GBT["depths"], iters: Sequence[int] = SMALL_GBT["iters"], max_bins: int = 32) -> list[ModelConfig]:
    return [ModelConfig(GBT, depth=d, iters=i, max_bins=max_bins) for d in depths for i in iters]


def canonical_layout(df: DataFrame, keys: Sequence[str], partitions: int | None = None,
                     spread: int = 16, unique_keys: Sequence[str] = ()) -> DataFrame:
    """Content-defined layout: a fixed number of partitions whose contents
    and row order depend only on the rows, not on the input files.

    Identical rows are first counted (a hash aggregate with a map-side
    partial step, so a row repeated a billion times leaves every task as one
    record).  Each distinct row's copies are then split into
    ``min(copies, spread · partitions)`` chunks of near-equal size, chunks
    are placed by a hash of the row and the chunk number, sorted by
    ``keys`` then the other columns, and expanded back into their copies in
    place.  A group of copies holding a third of the data is therefore
    spread over all partitions instead of landing in one task.  Rows that
    differ in any column (including outside ``keys``) are never counted as
    copies of each other.

    ``unique_keys`` names columns that hold no combination twice: counting
    is then left out, rows are placed by those keys in a single shuffle, and
    the keys are dropped.

    ``partitions`` defaults to ``spark.sql.shuffle.partitions``; keep it
    fixed between runs that must reproduce each other (an explicit
    repartition is not coalesced by AQE).  Grouping normalises ``-0.0`` to
    ``0.0`` and NaN payloads, as any Spark aggregate does.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if unique_keys:
        # rows are told apart by these keys, so one shuffle places them and
        # rows that the model cannot tell apart are spread by their keys
        order = list(dict.fromkeys([*keys, *(c for c in df.columns if c not in unique_keys), *unique_keys]))
        return df.repartition(n, *unique_keys).sortWithinPartitions(*order).drop(*unique_keys)
    return _laid_out(_counted(df), keys, n, spread)


def _counted(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def _laid_out(counted: DataFrame, keys: Sequence[str], n: int, spread: int = 16) -> DataFrame:
    """Every copy of counted rows in the canonical layout."""
    cols = [c for c in counted.columns if c != COPIES]
    order = list(dict.fromkeys([*keys, *cols]))
    copies = F.col(COPIES)
    k = F.least(copies, F.lit(spread * n))
    chunks = counted.select(*cols, copies, k.alias("_k"),
                            F.explode(F.sequence(F.lit(0).cast("long"), k - 1)).alias("_chunk"))
    # chunk j of k holds copies // k rows, plus one for the first copies % k chunks
    size = (F.expr("_copies div _k")
            + F.when(F.col("_chunk") < copies % F.col("_k"), 1).otherwise(0))
    placed = (chunks.select(*cols, "_chunk", size.alias("_m"))
              .repartition(n, *cols, "_chunk")
              .sortWithinPartitions(*order, "_chunk"))
    expanded = placed.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))).alias("_copy"))
    return expanded.drop("_copy")


def sized(rows: int, partitions: int | None, rows_each: int | None) -> int | None:
    """``partitions``, or as many more that on average none holds over ``rows_each`` rows."""
    return max(partitions or 1, -(-rows // rows_each)) if rows_each else partitions


def make_classifier(cfg: ModelConfig, spec: FeatureSpec, seed: int = 42, weight: str | None = None):
    common = dict(featuresCol=spec.scaled_col, labelCol=spec.label, maxDepth=cfg.depth,
                  maxBins=cfg.max_bins, seed=seed, **({"weightCol": weight} if weight else {}))
    if cfg.kind == RF:
        return RandomForestClassifier(numTrees=cfg.trees, **common)
    if cfg.kind == GBT:
        return GBTClassifier(maxIter=cfg.iters, **common)
    raise ValueError(f"unknown model kind {cfg.kind!r}")


def split_candidates(values: np.ndarray, bins: int, copies: np.ndarray | None = None) -> list[float]:
    """Thresholds between at most ``bins`` bins of a feature, by MLlib's rule: between all neighbouring values
    where they are few, else where the rows up to a value come nearest to each multiple of an equal share."""
    copies = np.ones(len(values)) if copies is None else copies
    known = ~np.isnan(values)
    found, of = np.unique(values[known], return_inverse=True)
    counts = np.bincount(of, copies[known], len(found))
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        cuts = middles.tolist()
    else:
        cuts, stride = [], float(copies.sum()) / bins
        target, upto = stride, np.cumsum(counts).tolist()
        for k, middle in enumerate(middles.tolist()):
            if abs(upto[k] - target) < abs(upto[k + 1] - target):
                cuts.append(middle)
                target += stride
    return sorted({c for c in cuts if math.isfinite(c)})


@dataclass
class Bins:
    """Split candidates of each slot of the model input."""
    cuts: list[list[float]]

    def count(self, df: DataFrame, spec: FeatureSpec) -> DataFrame:
        """Featurised rows as distinct ones of the label and a bin for each slot (``b0``, ...), with their number of copies
        (of rows that have a ``WEIGHT`` themselves, its sum).

        A value on a candidate lies below it, as in a tree, and NaN in the last bin.
        """
        slots = [f"s{j}" for j in range(len(self.cuts))]
        copies = F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1.0)
        df = (df.withColumn("_slots", vector_to_array(spec.scaled_col))
              .select(spec.label, copies.alias(WEIGHT), *[F.col("_slots")[j].alias(s) for j, s in enumerate(slots)]))
        cut = [j for j, c in enumerate(self.cuts) if c]
        if cut:
            df = Bucketizer(splitsArray=[[-math.inf, *(math.nextafter(c, math.inf) for c in self.cuts[j]), math.inf] for j in cut],
                            inputCols=[slots[j] for j in cut], outputCols=[f"k{j}" for j in cut], handleInvalid="keep").transform(df)
        bins = [(F.least(F.col(f"k{j}"), F.lit(float(len(c)))) if c else F.lit(0.0)).alias(f"b{j}") for j, c in enumerate(self.cuts)]
        return df.select(spec.label, WEIGHT, *bins).groupBy(spec.label, *self.names).agg(F.sum(WEIGHT).alias(WEIGHT))

    @property
    def names(self) -> list[str]:
        return [f"b{j}" for j in range(len(self.cuts))]

    def vectors(self, counted: DataFrame, spec: FeatureSpec) -> DataFrame:
        return counted.select(spec.label, array_to_vector(F.array(*self.names)).alias(spec.scaled_col), WEIGHT)


@dataclass
class Prepared:
    """Preprocessing fitted on the training part plus the cached inputs."""
    prep: PipelineModel
    spec: FeatureSpec
    # Training rows.
    rows: int
    prep_seconds: float = 0.0
    test: DataFrame | None = None
    # Partitions, rows a partition and reliability of a canonical layout.
    layout: tuple[int | None, int | None, bool] | None = None
    layout_keys: Sequence[str] = ()
    # Of a model input in bins.
    bins: Bins | None = None
    # Distinct training rows with their number of copies, kept.
    counted: DataFrame | None = field(default=None, repr=False)
    _train: DataFrame | None = field(default=None, repr=False)
    _weighted: DataFrame | None = field(default=None, repr=False)
    _binned: dict[int, Prepared] = field(default_factory=dict, repr=False)
    _lock: RLock = field(default_factory=RLock, repr=False)

    @property
    def train(self) -> DataFrame:
        """The model input, a row for every copy, laid out and kept at the first call."""
        with self._lock:
            if self._train is None:
                partitions, rows_each, reliable = self.layout
                n = sized(self.rows, partitions, rows_each) or int(self.counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                self._train = _kept(self.features(_laid_out(self.counted, self.layout_keys, n)), reliable)
        return self._train

    def _distinct(self) -> DataFrame:
        """Distinct rows of the model input with their number of copies."""
        if self.counted is not None:
            return self.features(self.counted, F.col(COPIES).cast("double").alias(WEIGHT))
        return self.train.groupBy(self.spec.label, self.spec.scaled_col).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))

    def lay_out(self) -> None:
        """Make the model input (:attr:`train`) now, as a part of the preparation."""
        if self._train is None:
            began = time.perf_counter()
            _ = self.train
            self.prep_seconds += time.perf_counter() - began

    def weighted(self) -> DataFrame:
        """The model input as distinct rows with their number of copies (``WEIGHT``), counted and kept at the first call.

        Its layout is canonical like that of the input.
        """
        with self._lock:
            if self._weighted is None:
                began = time.perf_counter()
                self._weighted = self._placed(self._distinct(), [self.spec.label, self.spec.scaled_col])[0]
                self.prep_seconds += time.perf_counter() - began
        return self._weighted

    def binned(self, max_bins: int, seed: int = 42) -> Prepared:
        """The same preparation with the model input in at most ``max_bins`` bins a feature: distinct rows of bins with
        their number of copies.  Made and kept at the first call.

        Every row is counted.  The split candidates that bound the bins are taken, as MLlib takes them, from a bounded
        share of the rows (``CANDIDATE_ROWS``, all where there are fewer), drawn by their content: of a row's copies
        that share, and one more or none for the fraction.
        """
        with self._lock:
            if max_bins not in self._binned:
                began = time.perf_counter()
                share, distinct = CANDIDATE_ROWS / max(1, self.rows), self._distinct()
                some = distinct.select(vector_to_array(self.spec.scaled_col).alias("v"), WEIGHT)
                if share < 1:
                    place = F.pmod(F.xxhash64(self.spec.label, vector_to_array(self.spec.scaled_col), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
                    some = (distinct.select(vector_to_array(self.spec.scaled_col).alias("v"), F.floor(F.col(WEIGHT) * share + place).cast("double").alias(WEIGHT))
                            .filter(F.col(WEIGHT) > 0))
                taken = some.toArrow()
                values = np.asarray(taken["v"].combine_chunks().flatten()).reshape(len(taken), -1)
                bins = Bins([split_candidates(column, max_bins, np.asarray(taken[WEIGHT])) for column in values.T])
                kept, n = self._placed(bins.count(distinct, self.spec), [self.spec.label, *bins.names], bins)
                self._binned[max_bins] = Prepared(self.prep, self.spec, n, layout=self.layout, bins=bins, _train=kept, _weighted=kept)
                self.prep_seconds += time.perf_counter() - began
        return self._binned[max_bins]

    def forests_on_bins(self, max_bins: int) -> bool:
        """Whether distinct rows of bins are so much fewer than rows that a forest is fitted on them (:func:`fit_forest`)."""
        return bool(self.bins) or bool(self.layout) and self.rows >= FOREST_ROWS and self.binned(max_bins).rows * FOREST_GAIN <= self.rows

    def _placed(self, rows: DataFrame, cols: Sequence[str], bins: Bins | None = None) -> tuple[DataFrame, int]:
        """Distinct ``rows`` in a canonical layout, kept, and their number."""
        counted = rows.persist(StorageLevel.MEMORY_AND_DISK)
        partitions, rows_each, reliable = self.layout
        count = counted.count()
        n = sized(count, partitions, rows_each) or int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = counted.repartition(n, *cols).sortWithinPartitions(*cols)
        placed = _kept(bins.vectors(placed, self.spec) if bins else placed, reliable)
        counted.unpersist()
        return placed, count

    def cache_test(self, test: DataFrame) -> DataFrame:
        """Featurise the test part once and keep it for every grid."""
        self.test = self.features(test).persist(StorageLevel.MEMORY_AND_DISK)
        return self.test

    def features(self, df: DataFrame, *more: Column) -> DataFrame:
        return self.prep.transform(df).select(F.col(self.spec.label).cast("double").alias(self.spec.label), self.spec.scaled_col, *more)

    def unpersist(self) -> None:
        for kept in (self._train, self._weighted, self.counted):
            if kept is not None:
                kept.unpersist()
        self._weighted = None
        if self.counted is not None:
            self._train = None
        for binned in self._binned.values():
            binned.unpersist()
        self._binned.clear()
        if self.test is not None:
            self.test.unpersist()
            self.test = None


def _kept(df: DataFrame, reliable: bool) -> DataFrame:
    """``df`` computed and kept, with ``reliable`` as a copy in ``spark.checkpoint.dir``."""
    df = (df.checkpoint(eager=True) if reliable else df).persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


def prepare(train: DataFrame, spec: FeatureSpec, layout_keys: Sequence[str] | None = None,
            layout_partitions: int | None = None, reliable: bool = False,
            unique_keys: Sequence[str] = (), layout_rows: int | None = None) -> Prepared:
    """Fit index/assemble/scale on ``train`` once and keep what the fits read.

    Only the columns that the model sees (label, numeric and categorical
    inputs) are read; in the model input only the label and the scaled
    vector are kept.

    With ``layout_keys`` equal training rows are counted, in one pass over
    the input, and kept as distinct ones with their copies: the stages are
    fitted on those, and all fits read them or what is made of them, so the
    input is not read again and no copy is written out unless a fit draws
    rows one by one (``Prepared.train``).  That model input has the
    canonical layout: ``layout_keys`` gives the sort order; keys outside
    the model's columns (ids, dates) are not needed and are ignored.
    With ``layout_rows`` it has ``layout_partitions`` or as many more that
    on average none holds over ``layout_rows`` rows; the number depends on
    the data alone.

    ``reliable=True`` also writes what is kept once to
    ``spark.checkpoint.dir`` (shared storage) and caches the written copy,
    so cached blocks lost with an executor during long fits are re-read
    from those files instead of re-running the scan and the layout's
    shuffles.  Partitions and row order are kept, so the fits are the same.
    """
    ensure_checkpoint_dir(train.sparkSession)
    began, raw = time.perf_counter(), None
    layout = (layout_partitions, layout_rows, reliable) if layout_keys else None
    if layout_keys:
        needed = [c for c in dict.fromkeys([spec.label, *spec.numeric, *spec.categorical])
                  if c in train.columns]
        keys = [k for k in layout_keys if k in needed]
        own = [k for k in unique_keys if k not in needed]
        if not own:
            counted = _kept(_counted(train.select(*needed)), reliable)
            rows = counted.agg(F.sum(COPIES)).first()[0]
            if not rows:
                raise ValueError("the training part is empty")
            return Prepared(fit_features(counted, spec, COPIES), spec, rows, time.perf_counter() - began,
                            layout=layout, layout_keys=keys, counted=counted)
        # The index and scaler fits each read the training rows; keep the
        # laid-out rows (only the columns the features need) so the scan,
        # hash and shuffle run once instead of once per fit.
        n = sized(train.count(), layout_partitions, layout_rows) if layout_rows else layout_partitions
        raw = canonical_layout(train.select(*needed, *own), keys, n, unique_keys=own).persist(
            StorageLevel.MEMORY_AND_DISK)
        train = raw
    if train.isEmpty():
        raise ValueError("the training part is empty")
    prep = fit_features(train, spec)
    model_input = _kept(prep.transform(train).select(F.col(spec.label).cast("double").alias(spec.label), spec.scaled_col), reliable)
    rows = model_input.count()
    if raw is not None:
        raw.unpersist()
    return Prepared(prep, spec, rows, time.perf_counter() - began, layout=layout, _train=model_input)


def fit_classifier(prepared: Prepared, cfg: ModelConfig, seed: int = 42):
    """One classifier.  On a canonical layout boosting reads each distinct row of bins once, weighted by its copies,
    which weigh what they do one by one, and so does a forest where rows are many more than those
    (:meth:`Prepared.forests_on_bins`); otherwise a forest draws each copy by itself.

    The model of a preparation in bins reads bins, any other the scaled features.
    """
    if prepared.bins:
        return _fit_on_bins(prepared, cfg, seed)
    if prepared.layout and (cfg.kind == GBT or prepared.forests_on_bins(cfg.max_bins)):
        binned = prepared.binned(cfg.max_bins)
        return unbinned(_fit_on_bins(binned, cfg, seed), binned.bins)
    return make_classifier(cfg, prepared.spec, seed).fit(prepared.train)


def _fit_on_bins(binned: Prepared, cfg: ModelConfig, seed: int):
    if cfg.kind == RF:
        return fit_forest(binned, cfg, seed)
    return make_classifier(cfg, binned.spec, seed, WEIGHT).fit(binned.weighted())


def fit_forest(binned: Prepared, cfg: ModelConfig, seed: int = 42) -> RandomForestClassificationModel:
    """A forest on distinct rows of bins.

    In MLlib's forest each tree draws every row by itself, as often as a Poisson number of mean 1 says.  Rows of the
    same bins are one to a tree, so what counts is how often they are drawn together, a Poisson number whose mean is
    their number: that is drawn here for each tree and distinct row, and is its weight in a fit of that tree.  The
    draws of a tree depend on the seed, the tree's number and the canonical layout only, so a forest of fewer trees is
    the beginning of one of more.  Each node draws the features that it splits by as in any forest.
    """
    spec = binned.spec
    classes = int(binned.train.agg(F.max(spec.label)).first()[0]) + 1
    label = F.col(spec.label).alias(spec.label, metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})

    def fit_tree(drawn: DataFrame, k: int, number: int):
        one = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt" if cfg.trees > 1 else "all", weightCol=WEIGHT,
                                     featuresCol=spec.scaled_col, labelCol=spec.label, maxDepth=cfg.depth, maxBins=cfg.max_bins,
                                     seed=int(np.random.SeedSequence([seed, number]).generate_state(1)[0]))
        return one.fit(drawn.select(label, spec.scaled_col, F.col("_draws")[k].cast("double").alias(WEIGHT)).filter(F.col(WEIGHT) > 0))

    fitted = []
    for first in range(0, cfg.trees, TREES_AT_ONCE):
        numbers = range(first, min(first + TREES_AT_ONCE, cfg.trees))
        drawn = _drawn(binned, numbers, seed).persist(StorageLevel.MEMORY_AND_DISK)
        drawn.count()
        with ThreadPoolExecutor(max_workers=len(numbers)) as pool:
            fitted += pool.map(lambda k, drawn=drawn, first=first: fit_tree(drawn, k, first + k), range(len(numbers)))
        drawn.unpersist()
    asked = make_classifier(cfg, spec, seed)
    return _forest([m._java_obj.trees()[0] for m in fitted], f"{asked.uid}_{cfg.trees}", fitted[0].numFeatures, classes,
                   {p.name: v for p, v in asked.extractParamMap().items() if asked.isSet(p)})


def _drawn(binned: Prepared, numbers: Sequence[int], seed: int) -> DataFrame:
    """Rows of bins with the number of their copies that each of the trees ``numbers`` draws (``_draws``)."""
    label, col = binned.spec.label, binned.spec.scaled_col
    numbers = list(numbers)

    def draw(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        streams = [np.random.default_rng([seed, number, part]) for number in numbers]
        for batch in batches:
            copies = np.asarray(batch.column(2))
            counts = np.stack([s.poisson(copies) for s in streams], axis=1).astype("int64")
            at = np.arange(len(copies) + 1, dtype="int32") * len(streams)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(at), pa.array(counts.ravel()))],
                                             names=[label, col, "_draws"])

    rows = binned.weighted().select(label, vector_to_array(col).alias(col), WEIGHT)
    schema = T.StructType([T.StructField(label, T.DoubleType()), T.StructField(col, T.ArrayType(T.DoubleType())),
                           T.StructField("_draws", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(draw, schema).withColumn(col, array_to_vector(col))


def _forest(trees: Sequence, uid: str, features: int, classes: int, params: dict) -> RandomForestClassificationModel:
    """A forest of fitted trees."""
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml.classification
    grown = sc._gateway.new_array(ml.DecisionTreeClassificationModel, len(trees))
    for k, t in enumerate(trees):
        grown[k] = t
    made = ml.RandomForestClassificationModel(uid, grown, features, classes)
    out = RandomForestClassificationModel(made)
    out._resetUid(made.uid())
    out._set(**params | {"numTrees": len(trees)})
    out._transfer_params_to_java()
    return out


def unbinned(model, bins: Bins):
    """The forest or boosted model that reads features where ``model`` reads their bins: a split between two bins is the candidate between them."""
    java, sc = model._java_obj, SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml

    def read(node):
        if not node.subtreeDepth():
            return node
        split = node.split()
        j = split.featureIndex()
        return ml.tree.InternalNode(node.prediction(), node.impurity(), node.gain(), read(node.leftChild()), read(node.rightChild()),
                                    ml.tree.ContinuousSplit(j, bins.cuts[j][math.floor(split.threshold())]), node.impurityStats())

    params = {p.name: v for p, v in model.extractParamMap().items() if model.isSet(p)}
    if isinstance(model, RandomForestClassificationModel):
        trees = [ml.classification.DecisionTreeClassificationModel(t.uid(), read(t.rootNode()), model.numFeatures, model.numClasses) for t in java.trees()]
        return _forest(trees, model.uid, model.numFeatures, model.numClasses, params)
    trees = [ml.regression.DecisionTreeRegressionModel(t.uid(), read(t.rootNode()), model.numFeatures) for t in java.trees()]
    return _boosted(trees, model.treeWeights, model.uid, model.numFeatures, model.numClasses)._set(**params)


def _boosted(trees: Sequence, weights: Sequence[float], uid: str, features: int, classes: int) -> GBTClassificationModel:
    """A boosted model of fitted trees."""
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    grown, shares = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees)), sc._gateway.new_array(sc._jvm.double, len(trees))
    for k, t in enumerate(trees):
        grown[k], shares[k] = t, float(weights[k])
    made = ml.classification.GBTClassificationModel(uid, grown, shares, features, classes)
    out = GBTClassificationModel(made)
    out._resetUid(made.uid())
    return out


def prefix(model: GBTClassificationModel, iters: int) -> GBTClassificationModel:
    """The boosted model after its first ``iters`` iterations; it can be saved like any other."""
    weights = model.treeWeights
    if not 1 <= iters <= len(weights):
        raise ValueError(f"{iters} iterations of a model that has {len(weights)}")
    out = _boosted(model._java_obj.trees()[:iters], weights, f"{model.uid}_{iters}", model.numFeatures, model.numClasses)
    for name in ("FeaturesCol", "PredictionCol", "RawPredictionCol", "ProbabilityCol"):
        getattr(out, f"set{name}")(getattr(model, f"get{name}")())
    return out


def shallower(model: RandomForestClassificationModel, depth: int, first: int | None = None) -> RandomForestClassificationModel:
    """The forest (with ``first``, so many of its trees) cut at ``depth``, which is the forest that the same fit with that depth limit grows.

    MLlib grows all trees of a forest level by level, draws rows and the features of a node without regard to the
    depth limit, and keeps at each node the counts of its rows.  Like MLlib it joins leaves that predict the same.
    (The features are drawn in the same order as long as a level's statistics fit ``maxMemoryInMB``: about 58,000
    nodes for seven features of 64 bins; beyond that the cut forest is one that other draws of features give.)
    """
    if depth < 0:
        raise ValueError(f"depth {depth}")
    java, sc = model._java_obj, SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml

    def leaf(node):
        return ml.tree.LeafNode(node.prediction(), node.impurity(), node.impurityStats())

    def cut(node, levels: int):
        if node.subtreeDepth() <= levels:
            return node
        if not levels:
            return leaf(node)
        left, right = cut(node.leftChild(), levels - 1), cut(node.rightChild(), levels - 1)
        if not left.subtreeDepth() and not right.subtreeDepth() and left.prediction() == right.prediction():
            return leaf(node)
        return ml.tree.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), node.impurityStats())

    trees = [ml.classification.DecisionTreeClassificationModel(f"{t.uid()}_{depth}", cut(t.rootNode(), depth), model.numFeatures, model.numClasses)
             for t in java.trees()[:first]]
    params = {p.name: v for p, v in model.extractParamMap().items() if model.isSet(p)}
    return _forest(trees, f"{model.uid}_{len(trees)}_{depth}", model.numFeatures, model.numClasses, params | {"maxDepth": depth})


def deepest_fits(configs: Sequence[ModelConfig], beginnings: Callable[[ModelConfig], bool] = lambda cfg: False) -> dict[ModelConfig, ModelConfig]:
    """The fit that each configuration is read off in a grid: as in :func:`longest_fits`, and for a forest the deepest that differs in depth
    only, or where forests of fewer trees are ``beginnings`` of those of more the deepest of the most trees (a single tree is by itself,
    as its nodes split by all features)."""
    def of(cfg):
        if cfg.kind == GBT:
            return longest[cfg]
        if not beginnings(cfg) or cfg.trees == 1:
            return max((c for c in configs if (c.kind, c.trees, c.max_bins) == (cfg.kind, cfg.trees, cfg.max_bins)), key=lambda c: c.depth)
        alike = [c for c in configs if (c.kind, c.max_bins) == (cfg.kind, cfg.max_bins) and c.trees > 1]
        return replace(cfg, depth=max(c.depth for c in alike), trees=max(c.trees for c in alike))

    longest = longest_fits(configs)
    return {cfg: of(cfg) for cfg in configs}


def longest_fits(configs: Sequence[ModelConfig]) -> dict[ModelConfig, ModelConfig]:
    """The fit that each configuration is read off: its own, or for boosting the longest that differs in iterations only."""
    return {cfg: max((c for c in configs if (c.kind, c.depth, c.max_bins) == (cfg.kind, cfg.depth, cfg.max_bins)), key=lambda c: c.iters)
            if cfg.kind == GBT else cfg for cfg in configs}


def full_pipeline(prepared: Prepared, classifier_model) -> PipelineModel:
    """Preprocessing stages + classifier as one saveable ``PipelineModel``."""
    return PipelineModel(stages=list(prepared.prep.stages) + [classifier_model])


def train_pipeline(train: DataFrame, spec: FeatureSpec, cfg: ModelConfig, seed: int = 42,
                   layout_keys: Sequence[str] | None = None,
                   layout_partitions: int | None = None, reliable: bool = False) -> PipelineModel:
    """index → assemble → scale → classifier, fitted on ``train`` only."""
    prepared = prepare(train, spec, layout_keys, layout_partitions, reliable)
    try:
        return full_pipeline(prepared, fit_classifier(prepared, cfg, seed))
    finally:
        prepared.unpersist()


GRID_SCHEMA = T.StructType([
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("params", T.StringType(), False),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("train_time", T.DoubleType(), False),
    T.StructField("fit_time", T.DoubleType(), False),
])


def run_grid(train: DataFrame, test: DataFrame, spec: FeatureSpec, configs: Sequence[ModelConfig],
             seed: int = 42, layout_keys: Sequence[str] | None = None,
             layout_partitions: int | None = None, short_params: bool = False,
             prepared: Prepared | None = None, parallelism: int = 1,
             reliable: bool = False, layout_rows: int | None = None, prefixes: bool = False) -> DataFrame:
    """Fit every configuration on the same prepared training table, then
    score all of them on the test part in a single pass.

    Returns ``(seq, model, params, accuracy, train_time, fit_time)``:
    ``fit_time`` is the wall time of each classifier's ``fit``,
    ``train_time`` that of the whole pipeline (the shared preprocessing fit
    and the classifier's).  An empty test part is an error.  With ``parallelism > 1`` that many
    fits are submitted at once from driver threads (Spark runs their jobs
    side by side, useful when one fit cannot fill a large cluster); the
    times then overlap.

    On a canonical layout boosted configurations, and forests where rows
    are many (:meth:`Prepared.forests_on_bins`), are fitted and scored on
    distinct rows of bins (:meth:`Prepared.binned`): a tree tells rows
    apart by the bins of its split candidates only, so rows in the same
    bins have the same path and are counted instead of read one by one.

    Boosting adds trees one after the other.  With ``prefixes`` boosted
    configurations that differ in their iterations only are read off one
    fit, the longest, whose first trees are the shorter model; they then
    have the times of that fit.  A forest grows level by level, so forests
    that differ in their depth only are read off the deepest, cut at their
    depth (:func:`shallower`); forests on bins that differ in their trees
    are read off the one of the most trees.
    """
    spark = train.sparkSession
    own = prepared is None
    if own:
        prepared = prepare(train, spec, layout_keys, layout_partitions, reliable, layout_rows=layout_rows)
    try:
        # shared by the fits, so no part of their own times
        inputs_of = {cfg: prepared.binned(cfg.max_bins) if prepared.layout and (cfg.kind == GBT or prepared.forests_on_bins(cfg.max_bins)) else prepared
                     for cfg in configs}
        if any(inputs is prepared for inputs in inputs_of.values()):
            prepared.lay_out()

        def read_by(cfg):
            return inputs_of[cfg] if cfg in inputs_of else prepared.binned(cfg.max_bins)

        def fit_one(cfg):
            t0 = time.perf_counter()
            m = fit_classifier(read_by(cfg), cfg, seed)
            return m, time.perf_counter() - t0

        source = deepest_fits(configs, lambda cfg: bool(read_by(cfg).bins)) if prefixes else {}
        runs = list(dict.fromkeys(source.values())) if prefixes else list(configs)
        if parallelism > 1:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                results = list(pool.map(fit_one, runs))
        else:
            results = [fit_one(cfg) for cfg in runs]
        if prefixes:
            by_fit = dict(zip(runs, results))
            results = [(m if cfg == source[cfg] else prefix(m, cfg.iters) if cfg.kind == GBT else shallower(m, cfg.depth, cfg.trees), t)
                       for cfg in configs for m, t in [by_fit[source[cfg]]]]
        fitted = [m for m, _ in results]
        times = [t for _, t in results]
        accs = {"n": 0}
        for inputs in {id(read_by(cfg)): read_by(cfg) for cfg in configs}.values():
            scored = prepared.test if prepared.test is not None else prepared.features(test)
            if inputs.bins:
                scored = inputs.bins.vectors(inputs.bins.count(scored, spec), spec)
            copies = F.col(WEIGHT).cast("long") if inputs.bins else F.lit(1).cast("long")
            cols = []
            for i, m in enumerate(fitted):
                if read_by(configs[i]) is inputs:
                    m = m.copy()
                    m.setFeaturesCol(spec.scaled_col)
                    m.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
                    scored = m.transform(scored)
                    right = (F.col(spec.label) == F.col(f"_p{i}")).cast("int")
                    cols.append((F.sum(right * copies) / F.sum(F.when(right.isNotNull(), copies))).alias(f"a{i}"))
            # one row, one value per configuration
            accs |= scored.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("n"), *cols).first().asDict()
        if not accs["n"]:
            raise ValueError("the test part is empty")
    finally:
        if own:
            prepared.unpersist()
    rows = [(i, cfg.kind, cfg.label(short_params), accs[f"a{i}"], float(t) + prepared.prep_seconds, float(t))
            for i, (cfg, t) in enumerate(zip(configs, times))]
    return table_from_rows(spark, rows, GRID_SCHEMA)


IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType(), False),
    T.StructField("importance", T.DoubleType(), False),
])


def feature_names(model: PipelineModel) -> list[str]:
    """Vector slot names, taken from the fitted assembler stage."""
    from pyspark.ml.feature import VectorAssembler
    for st in model.stages:
        if isinstance(st, VectorAssembler):
            return list(st.getInputCols())
    raise ValueError("pipeline has no VectorAssembler stage")


def feature_importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, importance)`` in assembler order; values sum to 1."""
    names = feature_names(model)
    values = model.stages[-1].featureImportances.toArray()
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} features")
    return table_from_rows(spark, [(n, float(v)) for n, v in zip(names, values)], IMPORTANCE_SCHEMA)


SHAPE_SCHEMA = T.StructType([
    T.StructField("trees", T.IntegerType(), False),
    T.StructField("depth", T.IntegerType(), False),
    T.StructField("deepest", T.IntegerType(), False),
])


def model_shape(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(trees, depth, deepest)`` of a fitted ensemble: its trees, the depth
    limit it was fitted under, and the depth of its deepest tree."""
    clf = model.stages[-1]
    return table_from_rows(spark, [(len(clf.trees), clf.getMaxDepth(), max(t.depth for t in clf.trees))], SHAPE_SCHEMA)
