"""Forests of many rows, fitted and applied over cells of binned features (ML11, ML12).

Spark's tree learner sees a row only through the bins of its features (``maxBins``), its
label and how often each tree drew it.  Rows that agree in bins, which are at least as
many, and in labels are therefore counted together, whatever their values, and the trees
are grown from the counted cells: the bootstrap draws of n rows, Poisson(1) each, add up
to one Poisson(n) draw of their cell.  The bins are a stage of the model, so what it
predicts is a function of them as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.encode import encode_columns
from ..operators.profile import with_class_weights
from ..session import materialize, remove_scratch, write_scratch
from .models import FEATURES, MAX_CLASSES, TrainedModel, estimator, fit_detached, label_dictionary, own, prepare_features, read_classes

#: Rows from which a chain of forests is fitted on cells: fewer take less time as they are.
CELL_ROWS = 4_000_000
#: Bins of all features together, multiplied: as many cells are scored and broadcast.
MAX_GRID = 1 << 20
#: Most bins of a feature.
MAX_BINS = 1024
#: Rows by which features are binned, ten times as many as Spark's tree learner takes.
SPLIT_ROWS = 100_000
#: Rows that a cell must hold on average; else the rows themselves are the shorter input.
ROWS_PER_CELL = 4
#: Cells in one partition of a fit.
CELLS_PER_TASK = 50_000
#: Trees that are grown at a time, each one distributed over the cluster.
PARALLEL_TREES = 4
#: Parameters of a forest that mean the same over cells.  Others count rows.
CELL_PARAMS = {"numTrees", "maxDepth", "maxBins", "impurity"}


def bin_name(c: str) -> str:
    return f"_cf_b_{c}"


def split_points(values, weights, max_bins: int) -> list[float]:
    """Thresholds of at most ``max_bins`` bins of about equal weight, as Spark's tree learner
    sets them: midpoints between neighbouring values, all of them if they are few."""
    found, of = np.unique(np.asarray(values, dtype=np.float64) + 0.0, return_inverse=True)
    if len(found) <= max_bins:
        at = list(range(1, len(found)))
    else:
        upto = np.cumsum(np.bincount(of, weights))
        at, stride = [], upto[-1] / max_bins
        target = stride
        for i in range(1, len(found)):
            if abs(upto[i - 1] - target) < abs(upto[i] - target):
                at.append(i)
                target += stride
    with np.errstate(over="ignore", invalid="ignore"):
        mid = [float((found[i - 1] + found[i]) / 2) for i in at]
    return sorted({m for m in mid if math.isfinite(m)})


def label_weights(counts: list, targets) -> dict:
    """The weight of a row by its labels: the mean of its balanced weights over the targets."""
    out = dict.fromkeys((tuple(r[:-1]) for r in counts), 0.0)
    for i in range(len(targets)):
        of: dict = {}
        for *labels, n in counts:
            if labels[i] is not None:
                of[labels[i]] = of.get(labels[i], 0) + n
        for labels in out:
            if labels[i] is not None:
                out[labels] += sum(of.values()) / (len(of) * of[labels[i]] * len(targets))
    return out


def fit_bins(df: DataFrame, numeric, targets, counts: list, max_bins: int, seed: int) -> Bucketizer | None:
    """Bins of the features, their splits found among some rows by weight, as the tree learner
    finds them: as many bins as ``MAX_GRID`` allows, so that features of few values keep them
    all; None if it does not allow ``max_bins``.  All rows are then counted in them."""
    rows = sum(r[-1] for r in counts)
    x = prepare_features(df, numeric).select(*[own(c) for c in numeric], *targets)
    some = (x if rows <= SPLIT_ROWS else x.sample(SPLIT_ROWS / rows, seed)).collect()
    of = label_weights(counts, targets)
    weights = np.array([of.get(tuple(r[len(numeric):]), 0.0) for r in some])
    values = [np.array([r[i] for r in some]) for i in range(len(numeric))]
    distinct = [len(np.unique(v)) for v in values]
    most = max((b for b in range(2, MAX_BINS + 1) if math.prod(max(2, min(d, b)) for d in distinct) <= MAX_GRID), default=0)
    if most < min(max_bins, max(distinct)):
        return None
    inner = [split_points(v, weights, most) or [0.0 if np.any(v) else 1.0] for v in values]
    return Bucketizer(inputCols=[own(c) for c in numeric], outputCols=[bin_name(c) for c in numeric],
                      splitsArray=[[-math.inf, *s, math.inf] for s in inner])


def grid_size(bins: Bucketizer) -> int:
    return math.prod(len(s) - 1 for s in bins.getSplitsArray())


def count_cells(df: DataFrame, bins: Bucketizer, numeric, targets) -> DataFrame:
    """One row per cell, that is per bins and labels, with its number of rows ``_cf_n``."""
    cells = bins.transform(prepare_features(df.select(*dict.fromkeys([*numeric, *targets])), numeric))
    # The cast leaves out the attribute by which the learner would take bins for categories.
    cells = cells.select(*[F.col(b).cast("int").alias(b) for b in bins.getOutputCols()], *targets)
    return cells.groupBy(*bins.getOutputCols(), *targets).agg(F.count(F.lit(1)).alias("_cf_n"))


def with_draws(cells: DataFrame, bins: Bucketizer, targets, trees: int, seed: int) -> DataFrame:
    """Adds how often each tree draws the rows of a cell, ``_cf_draws``, by a generator
    seeded with the cell itself."""
    cells = cells.withColumn("_cf_key", F.xxhash64(F.lit(seed), *bins.getOutputCols(), *targets, *[F.col(c).isNull() for c in targets]))
    schema = T.StructType([*cells.schema.fields, T.StructField("_cf_draws", T.ArrayType(T.LongType()))])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = zip(b.column("_cf_key").to_pylist(), b.column("_cf_n").to_pylist(), strict=True)
            drawn = [np.random.Generator(np.random.Philox(key=k % 2**64)).poisson(n, trees) for k, n in of]
            offsets = pa.array(np.arange(len(drawn) + 1, dtype=np.int32) * trees)
            flat = pa.array(np.concatenate(drawn) if drawn else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(offsets, flat)], names=[*b.schema.names, "_cf_draws"])

    return cells.mapInArrow(draw, schema).drop("_cf_key")


def grow_forest(cells: DataFrame, label: str, bins: Bucketizer, numeric, more, seed: int, params: dict) -> TrainedModel:
    """A balanced forest of the rows that ``cells`` count.  ``more`` are features after the
    binned ones, which the cells hold as they are.  Each tree is one of Spark's, grown with
    the draws of its own as weights and its own choice of features."""
    data = cells.where(F.col(label).isNotNull())
    labels = label_dictionary(data, label)
    classes = read_classes(labels, label)
    coded = encode_columns(data, labels.withColumn("feature", F.lit(label)), [label], suffix="_cf_code")
    data = with_class_weights(coded.withColumn("_cf_label", F.col(f"{label}_cf_code").cast("double")), "_cf_label", "_cf_weight", rows="_cf_n")
    features = VectorAssembler(inputCols=[*bins.getOutputCols(), *[own(c) for c in more]], outputCol=FEATURES, handleInvalid="keep")
    known = {"ml_attr": {"type": "nominal", "num_vals": max(2, len(classes))}}  # a tree may draw no row of a class
    data = features.transform(prepare_features(data, more)).select(
        FEATURES, F.col("_cf_label").alias("_cf_label", metadata=known), "_cf_weight", "_cf_draws")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    whole = estimator("forest", seed=seed, **params)
    seeds = np.random.SeedSequence(seed).generate_state(whole.getNumTrees()).tolist()

    def tree(i: int):
        learner = estimator("forest", seed=seeds[i], **{**params, "numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "sqrt"})
        drawn = F.col("_cf_draws")[i]
        return fit_detached(learner, data.where(drawn > 0).withColumn("_cf_weight", drawn * F.col("_cf_weight")))

    try:
        with ThreadPool(PARALLEL_TREES) as pool:
            model = join_trees(pool.map(tree, range(whole.getNumTrees())), whole)
    finally:
        data.unpersist()
    return TrainedModel(PipelineModel([bins, features, model]), labels, label, [*numeric, *more], [], classes)


def join_trees(models: list, learner) -> RandomForestClassificationModel:
    """One forest of the trees of ``models``, with the parameters of ``learner``."""
    sc = SparkContext._active_spark_context
    ns, first = sc._jvm.org.apache.spark.ml.classification, models[0]._java_obj
    trees = sc._gateway.new_array(ns.DecisionTreeClassificationModel, len(models))
    for i, m in enumerate(models):
        trees[i] = m._java_obj.trees()[0]
    forest = learner._copyValues(RandomForestClassificationModel(
        ns.RandomForestClassificationModel(learner.uid, trees, first.numFeatures(), first.numClasses())))
    forest._transfer_params_to_java()
    return forest


def score_cells(cells: DataFrame, model: TrainedModel, more, name: str) -> DataFrame:
    """Adds the class code that ``model`` predicts for each cell as column ``name``."""
    pred = PipelineModel(model.pipeline.stages[1:]).transform(prepare_features(cells, more))
    return pred.select(*cells.columns, F.col("prediction").cast("bigint").cast("double").alias(name))


def fit_links(df: DataFrame, targets, numeric, seed: int, params: dict) -> list[TrainedModel] | None:
    """The models of a chain, or None if cells are not the shorter input: few rows, many
    bins, or almost as many cells as rows."""
    trees = estimator("forest", seed=seed, **params)
    counts = df.groupBy(*targets).agg(F.count(F.lit(1)).alias("_cf_n")).limit(MAX_CLASSES + 1).collect()
    rows = sum(r["_cf_n"] for r in counts)
    if rows < CELL_ROWS or len(counts) > MAX_CLASSES or trees.getNumTrees() < 2:
        return None
    bins = fit_bins(df, numeric, targets, counts, trees.getMaxBins(), seed)
    if bins is None:
        return None
    path = write_scratch(count_cells(df, bins, numeric, targets), "chain-counts")
    cells = df.sparkSession.read.parquet(path)
    n = cells.count()
    if n * ROWS_PER_CELL > rows:
        remove_scratch(df.sparkSession, path)
        return None
    cells = cells.repartition(-(-n // CELLS_PER_TASK))
    cells = materialize(with_draws(cells, bins, targets, trees.getNumTrees(), seed), "chain-cells")
    models, more = [], []
    for t in targets:
        m = grow_forest(cells, t, bins, numeric, more, seed, params)
        models.append(m)
        cells = score_cells(cells, m, more, f"{t}_pred")
        more.append(f"{t}_pred")
    return models


def shared_bins(models: list[TrainedModel]) -> Bucketizer | None:
    """The bins of the first features of all links, if the chain was fitted on cells."""
    first = [m.pipeline.stages[0] for m in models]
    if all(isinstance(b, Bucketizer) for b in first) and len({repr((b.getInputCols(), b.getSplitsArray())) for b in first}) == 1:
        return first[0]
    return None


def predict_links(df: DataFrame, models: list[TrainedModel], targets, bins: Bucketizer) -> DataFrame:
    """Adds ``<target>_pred`` for every link: every cell that the bins can make is scored
    once, and each row looks up its own."""
    numeric = models[0].numeric
    sizes = [len(s) - 1 for s in bins.getSplitsArray()]
    strides = [math.prod(sizes[:i]) for i in range(len(sizes))]
    n = grid_size(bins)
    grid = df.sparkSession.range(0, n, 1, -(-n // CELLS_PER_TASK)).withColumns(
        {b: (F.floor(F.col("id") / F.lit(s)) % k).cast("double") for b, s, k in zip(bins.getOutputCols(), strides, sizes)})
    made = [f"{t}_pred" for t in targets]
    for i, m in enumerate(models):
        grid = score_cells(grid, m, made[:i], made[i])
    table = grid.select(F.col("id").alias("_cf_cell"), *made)
    cell = sum((F.col(b).cast("bigint") * s for b, s in zip(bins.getOutputCols(), strides)), F.lit(0).cast("bigint"))
    drop = {*targets, *made, "prediction", "predicted", "rawPrediction", "probability", *[c for m in models for c in m.probability_columns]}
    kept = [c for c in df.columns if c not in drop]
    rows = bins.transform(prepare_features(df, numeric)).select(*[F.col(f"`{c}`") for c in kept], cell.alias("_cf_cell"))
    return rows.join(F.broadcast(table), "_cf_cell", "left").select(*[F.col(f"`{c}`") for c in kept], *made)
