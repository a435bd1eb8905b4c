"""Model training, scoring and persistence on Spark ML (ML1–ML4, ML6–ML8, EN6, FS4, IO8).

Labels are dictionary-encoded (codes follow the sorted classes, numeric labels sort
numerically, as scikit-learn orders classes), features are assembled by a Spark ML
``Pipeline`` (one-hot for text, ``VectorAssembler``), and the fitted pipeline plus the
label dictionary is the persisted model.  Training frames are persisted once before a
fit because tree learners scan them once per level.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import to_double
from ..operators.encode import decode_columns, encode_columns, fit_dictionary, one_hot_pipeline_stages
from ..operators.profile import with_class_weights
from ..operators.split import first_by_hash
from ..presets import GBT_LEVEL0, MAX_TREE_DEPTH, MLP_LAYOUTS

# Probability column names of the three-class labels, in class order.
COMPAT_NAMES = {"FTR": ("D", "W", "L"), "trend": ("D", "O", "I")}
TREND_LABELS = {"NextTrend", "NextTrendRng"}
MAX_CLASSES = 10_000
#: Rows of a training frame in one partition, of which tree learners keep an object per row.
ROWS_PER_TASK = 1_000_000
#: The same for a network, whose every epoch computes all rows at least once: a task is
#: to take about a third of a second of it, so that all cores share the rows.
NETWORK_ROWS_PER_TASK = 20_000


def prob_name(c) -> str:
    """Column name of the probability of class ``c`` (dots and minus signs are renamed)."""
    return "p_" + str(c).replace(".", "_").replace("-", "m")


def clip_depth(depth: int) -> int:
    if depth > MAX_TREE_DEPTH:
        warnings.warn(f"maxDepth {depth} is above Spark's limit; using {MAX_TREE_DEPTH}")
        return MAX_TREE_DEPTH
    return depth


#: The assembled vector of a model's features.
FEATURES = "_cf_features"


def feature_stages(numeric, categorical=(), output: str = FEATURES):
    """EN6: one-hot stages for text columns (unknown → zero vector) + assembler, over the
    private copies that ``prepare_features`` makes."""
    stages = list(one_hot_pipeline_stages([own(c) for c in categorical])) if categorical else []
    inputs = [own(c) for c in numeric] + [f"{own(c)}_ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep"))
    return stages


def estimator(kind: str, n_features: int | None = None, n_classes: int | None = None, seed: int = 2, **params):
    """ML1 forest, ML2 boosted trees, ML3 perceptron by layout name."""
    common = {"featuresCol": FEATURES, "labelCol": "_cf_label"}
    if kind == "forest":
        p = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 1, **params}
        p["maxDepth"] = clip_depth(int(p["maxDepth"]))
        return RandomForestClassifier(seed=seed, weightCol="_cf_weight", **common, **p)
    if kind == "boosted":
        p = {**GBT_LEVEL0, **params}
        p["maxDepth"] = clip_depth(int(p["maxDepth"]))
        gbt = GBTClassifier(seed=seed, weightCol="_cf_weight", **common, **p)
        if n_classes is not None and n_classes > 2:
            return OneVsRest(classifier=gbt, weightCol="_cf_weight", rawPredictionCol="rawPrediction", **common)
        return gbt
    if kind == "perceptron":
        layout = params.pop("layout", "small")
        hidden = MLP_LAYOUTS[layout] if isinstance(layout, str) else list(layout)
        p = {"maxIter": 100, "blockSize": 128, **params}
        return MultilayerPerceptronClassifier(layers=[n_features, *hidden, n_classes], seed=seed, **common, **p)
    raise ValueError(f"unknown model kind {kind}")


def fit_detached(learner, data: DataFrame):
    """Fit, and leave out the training summary: of two classes it holds the session, which
    every task that scores would carry, and which cannot be sent once it has observed a
    frame.  A copy of a model has none."""
    return learner.fit(data).copy()


@dataclass
class TrainedModel:
    pipeline: PipelineModel
    labels: DataFrame            # dictionary (feature, value, code) of the label
    label: str
    numeric: list
    categorical: list
    classes: list

    @property
    def probability_columns(self) -> list[str]:
        return [prob_name(c) for c in self.classes]

    def transform(self, df: DataFrame, keep_vectors: bool = False) -> DataFrame:
        """ML6 predict: adds ``prediction`` (class code), ``predicted`` (class value as
        text, ML8) and ``p_<class>`` probability columns (ML7).  The caller's columns come
        back as they were; the filled features are the model's own and are dropped."""
        result = {"prediction", "predicted", "rawPrediction", "probability", *self.probability_columns}
        df = df.drop(*[c for c in df.columns if c in result])
        out = self.pipeline.transform(prepare_features(df, self.numeric, self.categorical))
        if "probability" not in out.columns:  # one boosted model per class: its probabilities, normalised
            each = F.transform(vector_to_array("rawPrediction"), lambda r: 1 / (1 + F.exp(-2 * r)))
            total = F.aggregate(each, F.lit(0.0), lambda a, b: a + b)
            out = out.withColumn("probability", array_to_vector(F.transform(each, lambda p: p / total)))
        arr = vector_to_array("probability")
        out = out.withColumns({prob_name(c): arr[i] for i, c in enumerate(self.classes)})
        out = out.withColumn("prediction", F.col("prediction").cast("bigint"))
        out = decode_columns(out.withColumn("predicted", F.col("prediction")), self.labels.withColumn(
            "feature", F.lit("predicted")), ["predicted"])
        extra = [FEATURES, "rawPrediction", "probability"] if keep_vectors else []
        return out.select(*[F.col(f"`{c}`") for c in df.columns], "prediction", *self.probability_columns, "predicted", *extra)

    def save(self, path: str) -> None:
        """IO8: pipeline, label dictionary and metadata under one folder."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")
        meta = {"label": self.label, "numeric": self.numeric, "categorical": self.categorical,
                "classes": [str(c) for c in self.classes]}
        spark = self.labels.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> "TrainedModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return TrainedModel(PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/labels"),
                            meta["label"], meta["numeric"], meta["categorical"], meta["classes"])


def own(c: str) -> str:
    """The model's private copy of a feature column."""
    return f"_cf_f_{c}"


def prepare_features(df: DataFrame, numeric, categorical=()) -> DataFrame:
    """Adds a private copy of each feature: numbers coerced to DOUBLE with missing → 0,
    text with missing → 'Unknown'.  The columns themselves stay as they are."""
    return df.withColumns({**{own(c): F.coalesce(to_double(c), F.lit(0.0)) for c in numeric},
                           **{own(c): F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in categorical}})


def label_dictionary(df: DataFrame, label: str) -> DataFrame:
    return fit_dictionary(df.select(label), [label])


def read_classes(labels: DataFrame, label: str) -> list:
    """The values of a label's dictionary in the order of their codes."""
    top = labels.limit(MAX_CLASSES + 1).collect()
    if len(top) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return [r["value"] for r in sorted(top, key=lambda r: r["code"])]


def train(df: DataFrame, label: str, numeric, categorical=(), kind: str = "forest", balanced: bool = True,
          seed: int = 2, labels: DataFrame | None = None, **params) -> TrainedModel:
    """ML1–ML4: fit one classifier on ``df``; rows with a missing label are skipped."""
    numeric, categorical = list(numeric), list(categorical)
    used = list(dict.fromkeys([label, *numeric, *categorical]))
    # Every step below reads these columns, and tree learners scan them once per level.
    source = df.where(F.col(label).isNotNull()).select(*used).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(source, label, numeric, categorical, kind, balanced, seed, labels, params)
    finally:
        source.unpersist()


def _fit(data: DataFrame, label, numeric, categorical, kind, balanced, seed, labels, params) -> TrainedModel:
    parts = partitions_wanted(data, min(ROWS_PER_TASK, NETWORK_ROWS_PER_TASK) if kind == "perceptron" else None)
    labels = labels if labels is not None else label_dictionary(data, label)
    classes = read_classes(labels, label)
    data = encode_columns(data, labels.withColumn("feature", F.lit(label)), [label], suffix="_cf_code")
    data = data.withColumn("_cf_label", F.col(f"{label}_cf_code").cast("double"))
    if balanced:
        data = with_class_weights(data, "_cf_label", "_cf_weight")
    else:
        data = data.withColumn("_cf_weight", F.lit(1.0))
    data = prepare_features(data, numeric, categorical)
    features = Pipeline(stages=feature_stages(numeric, categorical)).fit(data)
    if kind == "perceptron" and balanced:  # it takes no row weights
        data = replicate_by_weight(data, "_cf_label", "_cf_weight", [own(c) for c in [*numeric, *categorical]], seed)
    if parts:
        data = data.select(*[own(c) for c in [*numeric, *categorical]], "_cf_label", "_cf_weight").repartition(parts)
    data = features.transform(data).select(FEATURES, "_cf_label", "_cf_weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_features = vector_size(data) if kind == "perceptron" else None
        model = fit_detached(estimator(kind, n_features, len(classes), seed, **params), data)
    finally:
        data.unpersist()
    return TrainedModel(PipelineModel([*features.stages, model]), labels, label, numeric, categorical, classes)


def partitions_wanted(df: DataFrame, rows_per_task: int | None = None) -> int | None:
    """The number of partitions of ``rows_per_task`` rows (``ROWS_PER_TASK``) that ``df`` is to be dealt into;
    None if no partition has more.  What a task of a fit reads and keeps is bounded by it,
    however large the files or skewed the joins that ``df`` comes from."""
    rows_per_task = rows_per_task or ROWS_PER_TASK
    sizes = df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    r = sizes.agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.count(F.lit(1)).alias("parts")).first()
    if not r["most"] or r["most"] <= rows_per_task:
        return None
    return max(r["parts"], -(-r["rows"] // rows_per_task))


def replicate_by_weight(df: DataFrame, label: str, weight: str, key_cols, seed: int = 2) -> DataFrame:
    """Rows as often as their weight says, for a learner that takes none: each row the whole
    part of its class's weight, and of each class so many rows once more, those first in a
    seeded order, that the class has its weight's share of rows exactly (rounded)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.first(weight).alias("w")).collect()  # classes are few: MAX_CLASSES
    more = {r[label]: round(r["n"] * r["w"]) - r["n"] * int(r["w"]) for r in counts}
    marked = first_by_hash(df, label, list(key_cols), seed, more, "_cf_more")
    copies = F.floor(F.col(weight)).cast("int") + F.col("_cf_more").cast("int")
    return marked.where(copies > 0).withColumn("_cf_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_cf_copy", "_cf_more")


def vector_size(data: DataFrame) -> int | None:
    first = data.select(FEATURES).first()
    return len(first[0]) if first else None


def compat_columns(pred: DataFrame, label: str, classes, suffix: str = "_ML") -> DataFrame:
    """ML7: the reference's probability names next to the explicit ``p_<class>`` ones:
    ``D/W/L`` for FTR, ``D/O/I`` for trends, and for binary labels ``<label><suffix>``,
    which is P(class 0) for forests (``_ML``) and P(class 1) for perceptrons (``_DL``)."""
    classes = [str(c) for c in classes]
    if label == "FTR" and len(classes) == 3:
        return pred.withColumns({n: F.col(prob_name(c)) for n, c in zip(COMPAT_NAMES["FTR"], classes)})
    if label in TREND_LABELS and len(classes) == 3:
        return pred.withColumns({n: F.col(prob_name(c)) for n, c in zip(COMPAT_NAMES["trend"], classes)})
    if len(classes) == 2:
        return pred.withColumn(f"{label}{suffix}", F.col(prob_name(classes[0] if suffix == "_ML" else classes[1])))
    return pred


def forest_importances(df: DataFrame, features, label: str, n_iterations: int = 10, num_trees: int = 100,
                       seed: int = 2, max_depth: int = 5) -> DataFrame:
    """FS4: random-forest feature importances averaged over ``n_iterations`` seeds.
    Returns the feature-count sized table ``(feature, importance)``."""
    features = list(features)
    total = [0.0] * len(features)
    for i in range(n_iterations):
        m = train(df, label, features, kind="forest", balanced=False, seed=seed + i, numTrees=num_trees,
                  maxDepth=max_depth)
        imp = m.pipeline.stages[-1].featureImportances.toArray()
        total = [t + float(v) / n_iterations for t, v in zip(total, imp)]
    return df.sparkSession.createDataFrame(list(zip(features, total)), "feature string, importance double")


def fit_save(df: DataFrame, path: str, label: str, numeric, categorical=(), kind: str = "forest", **params):
    """ML6 train mode: fit and persist."""
    m = train(df, label, numeric, categorical, kind, **params)
    m.save(path)
    return m


def load_transform(spark, path: str, df: DataFrame) -> DataFrame:
    """ML6 predict mode: load and score."""
    return TrainedModel.load(spark, path).transform(df)


def load_report(spark, path: str, df: DataFrame) -> DataFrame:
    """ML6 evaluate mode: load, score and report (EV2) against the true label."""
    from ..operators.evaluate import classification_report
    m = TrainedModel.load(spark, path)
    pred = m.transform(df).withColumn("_cf_true", F.col(m.label).cast("string"))
    return classification_report(pred, "_cf_true", "predicted")
