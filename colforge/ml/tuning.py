"""Grid search with stratified folds (ML5) and per-fold scoring (EV5).

The fold column comes from ``stratified_folds`` (exact, seeded), so every grid point
sees the same stratification.
"""

from __future__ import annotations

from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.encode import encode_columns
from ..operators.evaluate import classification_report
from ..operators.profile import with_class_weights
from ..operators.split import stratified_folds
from .models import (FEATURES, TrainedModel, estimator, feature_stages, fit_detached, label_dictionary, prepare_features, train,
                     vector_size)


SCORES = ("accuracy", "precision_macro", "recall_macro", "f1_macro")


def confusion_scores(pred: DataFrame) -> dict[str, float]:
    """The four scores from one confusion table (at most classes² rows).  Macro scores are
    means over the classes seen as label or prediction, 0 where a class has no rows."""
    cells = pred.groupBy("_cf_label", "prediction").agg(F.count(F.lit(1)).alias("n")).collect()
    total, hit, label, called = 0, {}, {}, {}
    for c, p, n in cells:
        total += n
        label[c] = label.get(c, 0) + n
        called[p] = called.get(p, 0) + n
        if c == p:
            hit[c] = hit.get(c, 0) + n
    if not total:
        return dict.fromkeys(SCORES, 0.0)
    classes = sorted(set(label) | set(called))
    precision = [hit.get(c, 0) / called[c] if called.get(c) else 0.0 for c in classes]
    recall = [hit.get(c, 0) / label[c] if label.get(c) else 0.0 for c in classes]
    f1 = [2 * p * r / (p + r) if p + r else 0.0 for p, r in zip(precision, recall)]
    return dict(zip(SCORES, [sum(hit.values()) / total, *(sum(x) / len(classes) for x in (precision, recall, f1))]))


def grid_search(df: DataFrame, label: str, key_cols, numeric, categorical=(), kind: str = "forest",
                grid: dict | None = None, folds: int = 5, metric: str = "recall_macro", seed: int = 2,
                parallelism: int = 2, fixed: dict | None = None):
    """ML5: cross-validate every grid point on stratified folds, pick the best by
    ``metric`` (``recall_macro`` at level 0, ``f1_macro`` at level 1), refit on all rows.
    Each fold's model is scored from one confusion table and then let go; ``parallelism``
    of them are fitted at a time, each one distributed over the cluster.

    Returns ``(best TrainedModel, metrics DataFrame(params, four scores, refit_score))``.
    """
    numeric, categorical = list(numeric), list(categorical)
    grid, fixed = dict(grid or {}), dict(fixed or {})
    data = df.where(F.col(label).isNotNull())
    labels = label_dictionary(data, label)
    n_classes = labels.count()
    data = stratified_folds(data, label, list(key_cols), k=folds, seed=seed, fold_col="_cf_fold")
    data = encode_columns(data, labels.withColumn("feature", F.lit(label)), [label], suffix="_cf_code")
    data = data.withColumn("_cf_label", F.col(f"{label}_cf_code").cast("double"))
    data = prepare_features(with_class_weights(data, "_cf_label", "_cf_weight"), numeric, categorical)
    feats = Pipeline(stages=feature_stages(numeric, categorical)).fit(data)
    data = feats.transform(data).select(FEATURES, "_cf_label", "_cf_weight", "_cf_fold")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    try:
        size = vector_size(data) if kind == "perceptron" else None

        def score(job: tuple[dict, int]) -> dict[str, float]:
            point, fold = job
            learner = estimator(kind, size, n_classes, seed, **{**fixed, **point})
            model = fit_detached(learner, data.where(F.col("_cf_fold") != fold))
            return confusion_scores(model.transform(data.where(F.col("_cf_fold") == fold)))

        with ThreadPool(max(1, parallelism)) as pool:
            found = pool.map(score, [(p, f) for p in points for f in range(folds)])
    finally:
        data.unpersist()
    means = [{k: sum(s[k] for s in found[i * folds:(i + 1) * folds]) / folds for k in SCORES} for i in range(len(points))]
    best = max(range(len(points)), key=lambda i: means[i][metric])
    model = train(df, label, numeric, categorical, kind, seed=seed, labels=labels, **{**fixed, **points[best]})
    metrics = df.sparkSession.createDataFrame(
        [(str(p), *[float(m[k]) for k in SCORES], float(m[metric])) for p, m in zip(points, means)],
        "params string, " + ", ".join(f"{k} double" for k in SCORES) + ", refit_score double")
    return model, metrics


def score_folds(model: TrainedModel, frames: dict) -> DataFrame:
    """EV5: classification report of a stored model on named frames (train/test/...)."""
    out = None
    for name, frame in frames.items():
        pred = model.transform(frame).withColumn("_cf_true", F.col(model.label).cast("string"))
        rep = classification_report(pred, "_cf_true", "predicted").withColumn("frame", F.lit(name))
        out = rep if out is None else out.unionByName(rep)
    return out
