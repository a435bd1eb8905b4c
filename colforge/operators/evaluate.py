"""Evaluation (EV1–EV4, EV6) from one confusion aggregation.

Everything is derived from ``groupBy(y, p).count()``, a table of at most k² rows, so a
report costs one pass over the predictions whatever the number of metrics.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import row_count_at_most


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """EV1: share of rows with y = p (missing counts as a miss)."""
    return df.agg(F.avg(F.coalesce((F.col(y) == F.col(p)).cast("double"), F.lit(0.0))).alias("accuracy"),
                  F.count(F.lit(1)).alias("rows"))


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """Confusion counts ``(y, p, n)``."""
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str, max_classes: int = 1000) -> DataFrame:
    """EV4: rows = true class, one column ``p_<class>`` per predicted class."""
    conf = confusion(df, y, p)
    labels = conf.select("p").union(conf.select("y")).distinct()
    if not row_count_at_most(labels, max_classes):
        raise ValueError("too many classes for a confusion matrix")
    values = sorted(r[0] for r in labels.collect() if r[0] is not None)
    wide = conf.groupBy("y").pivot("p", values).agg(F.first("n"))
    return wide.select("y", *[F.coalesce(F.col(str(v)), F.lit(0)).cast("bigint").alias(f"p_{v}") for v in values])


def per_class(df: DataFrame, y: str, p: str) -> DataFrame:
    """EV2 rows: per class precision, recall, F1, support; 0 where undefined."""
    conf = confusion(df, y, p)
    tp = conf.where(F.col("y") == F.col("p")).select(F.col("y").alias("label"), F.col("n").alias("tp"))
    sup = conf.groupBy(F.col("y").alias("label")).agg(F.sum("n").alias("support"))
    pred = conf.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    t = (sup.join(pred, "label", "full").join(tp, "label", "left")
            .select("label", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("support", "predicted", "tp")]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    t = t.withColumns({"precision": prec, "recall": rec})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return t.withColumn("f1", f1).select("label", "precision", "recall", "f1", "support")


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """EV2: per-class rows plus ``macro avg`` and ``weighted avg`` rows; ``label`` is text.
    The two summary rows are plain aggregations over the per-class table."""
    pc = per_class(df, y, p).withColumn("label", F.col("label").cast("string"))
    macro = pc.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("label"),
                      (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                      (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                      (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                      F.sum("support").alias("support"))
    return pc.unionByName(macro).unionByName(weighted)


def macro_scores(df: DataFrame, y: str, p: str) -> DataFrame:
    """EV3: macro precision, recall and F1 in one row."""
    pc = per_class(df, y, p)
    return pc.agg(F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
                  F.avg("f1").alias("f1_macro"))


def actual_vs_predicted(df: DataFrame, keys, y: str, p: str) -> DataFrame:
    """EV6: keyed listing of true and predicted values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys, F.col(y).alias("actual"), F.col(p).alias("predicted"))


class MacroEvaluator(Evaluator, Params):
    """EV3 as a Spark ML ``Evaluator`` (``f1_macro``, ``recall_macro``,
    ``precision_macro``, ``accuracy``) for ``CrossValidator``; larger is better."""

    metricName = Param(Params._dummy(), "metricName", "metric", typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", typeConverter=TypeConverters.toString)

    def __init__(self, metricName: str = "f1_macro", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(metricName=metricName, labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset):
        y, p = self.getOrDefault(self.labelCol), self.getOrDefault(self.predictionCol)
        metric = self.getOrDefault(self.metricName)
        if metric == "accuracy":
            return float(accuracy(dataset, y, p).first()["accuracy"])
        return float(macro_scores(dataset, y, p).first()[metric] or 0.0)

    def isLargerBetter(self):
        return True
