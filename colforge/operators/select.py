"""Feature selection (FS1–FS10).

The statistics are aggregations over the data (one pass each, or one shared pass in
``profile``); their results are feature-count sized tables, so the bookkeeping that
follows (thresholds, unions, the list of columns to drop) runs on those small tables.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import profile as pf
from .encode import one_hot_flags, vocabulary

METHODS = ("missing", "single_unique", "collinear", "zero_importance", "low_importance")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def text_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)]


def with_dummies(df: DataFrame, cols) -> DataFrame:
    """The 0/1 columns of the text columns next to the text columns themselves."""
    out = df
    for c in cols:
        out = one_hot_flags(out, c, vocabulary(df, c), drop=False)
    return out


def missing_above(stats: DataFrame, threshold: float) -> DataFrame:
    """FS1: features whose missing fraction is strictly above the threshold."""
    return stats.where(F.col("missing_fraction") > threshold)


def single_unique(stats: DataFrame) -> DataFrame:
    """FS2: features with exactly one distinct non-missing value."""
    return stats.where(F.col("nunique") == 1)


def collinear_pairs(corr: DataFrame, threshold: float) -> DataFrame:
    """FS3: pairs (earlier, later) with |r| > threshold; the later column is dropped."""
    return corr.where(F.abs(F.col("corr")) > threshold).select(
        F.col("feature_2").alias("drop_feature"), F.col("feature_1").alias("corr_feature"),
        F.col("corr").alias("corr_value"))


def low_importance(importances: DataFrame, cumulative: float) -> DataFrame:
    """FS5: features beyond the cumulative-importance threshold."""
    return importances.where(F.col("cumulative_importance") > cumulative)


def features_needed(importances: DataFrame, threshold: float) -> DataFrame:
    """FS9: number of features needed to pass a cumulative-importance threshold."""
    return importances.where(F.col("cumulative_importance") > threshold).agg(
        F.min("rank").cast("bigint").alias("features_needed"))


def collinear_submatrix(corr: DataFrame, pairs: DataFrame) -> DataFrame:
    """FS10: correlations between the flagged ``corr_feature`` set (rows) and the
    ``drop_feature`` set (columns), long form ``(row_feature, col_feature, corr)``."""
    sym = corr.select("feature_1", "feature_2", "corr").unionByName(
        corr.select(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "corr"))
    rows = pairs.select(F.col("corr_feature").alias("feature_1")).distinct()
    cols = pairs.select(F.col("drop_feature").alias("feature_2")).distinct()
    diag = rows.join(cols, F.col("feature_1") == F.col("feature_2")).select(
        "feature_1", "feature_2", F.lit(1.0).alias("corr"))
    off = sym.join(rows, "feature_1").join(cols, "feature_2")
    return off.unionByName(diag).select(F.col("feature_1").alias("row_feature"),
                                        F.col("feature_2").alias("col_feature"), "corr")


def _local(stats: DataFrame, schema: str) -> DataFrame:
    """A per-feature statistics table (one row per column) computed once and kept as a
    local relation, so later thresholds and unions do not rescan the data."""
    return stats.sparkSession.createDataFrame(stats.collect(), schema)


class FeatureSelector:
    """The five identification methods and removal over one DataFrame.

    ``data`` holds the features only; ``labels`` (optional) is a frame with the key and
    label for the importance methods.  Results are small DataFrames in ``records`` and
    lists of names in ``ops``.
    """

    def __init__(self, data: DataFrame, label_df: DataFrame | None = None, key: str | None = None,
                 label: str | None = None):
        self._full = None
        if label is not None and label_df is None and label in data.columns:
            self._full, data = data, data.drop(label)
        self.data = data
        self.label_df, self.key, self.label = label_df, key, label
        self.base_features = list(data.columns)
        self.one_hot_features: list[str] = []
        self.data_all = data
        self.ops: dict[str, list[str]] = {}
        self.records: dict[str, DataFrame] = {}
        self.corr: DataFrame | None = None
        self.feature_importances: DataFrame | None = None

    def identify_missing(self, threshold: float):
        stats = _local(pf.missing_fraction(self.data), "feature string, missing_fraction double")
        self.records["missing_stats"] = stats
        rec = missing_above(stats, threshold)
        self.records["missing"] = rec
        self.ops["missing"] = [r["feature"] for r in rec.collect()]
        return rec

    def identify_single_unique(self):
        stats = _local(pf.distinct_counts(self.data), "feature string, nunique bigint")
        self.records["unique_stats"] = stats
        rec = single_unique(stats)
        self.records["single_unique"] = rec
        self.ops["single_unique"] = [r["feature"] for r in rec.collect()]
        return rec

    def identify_collinear(self, threshold: float, one_hot: bool = False):
        data = self.data
        if one_hot:
            data = with_dummies(self.data, text_columns(self.data))
            self.one_hot_features = [c for c in data.columns if c not in self.base_features]
            self.data_all = data
        # the pair table is feature-count sized (p(p-1)/2 rows): read it once, keep it local
        corr = pf.pairwise_corr(data, numeric_columns(data)).collect()
        self.corr = data.sparkSession.createDataFrame(corr, "feature_1 string, feature_2 string, corr double")
        rec = collinear_pairs(self.corr, threshold)
        self.records["collinear"] = rec
        self.ops["collinear"] = list(dict.fromkeys(r["drop_feature"] for r in rec.collect()))
        return rec

    def identify_zero_importance(self, n_iterations: int = 10, num_trees: int = 100, seed: int = 2,
                                 max_depth: int = 5):
        if self.label_df is None and self._full is None:
            raise ValueError("labels are needed for importance-based selection")
        from ..ml.models import forest_importances
        if self._full is not None:
            joined = with_dummies(self._full, text_columns(self._full, exclude=[self.label]))
            data = joined.drop(self.label)
        else:
            data = with_dummies(self.data, text_columns(self.data))
            joined = data.join(self.label_df, self.key)
        self.one_hot_features = [c for c in data.columns if c not in self.base_features]
        self.data_all = data
        feats = numeric_columns(data, exclude=[self.key] if self.key else [])
        imp = forest_importances(joined, feats, self.label, n_iterations, num_trees, seed, max_depth)
        self.feature_importances = pf.cumulative_share(imp)
        rec = self.feature_importances.where(F.col("importance") == 0.0)
        self.records["zero_importance"] = rec
        self.ops["zero_importance"] = [r["feature"] for r in rec.collect()]
        return rec

    def identify_low_importance(self, cumulative: float):
        if self.feature_importances is None:
            raise RuntimeError("feature importances have not been determined; run identify_zero_importance first")
        rec = low_importance(self.feature_importances, cumulative)
        self.records["low_importance"] = rec
        self.ops["low_importance"] = [r["feature"] for r in rec.collect()]
        return rec

    def identify_all(self, params: dict):
        # the five keys of the reference's call; ``eval_metric`` and ``task`` are accepted
        # and, as there, do not change the forest that ranks the features
        for p in ("missing_threshold", "correlation_threshold", "eval_metric", "task", "cumulative_importance"):
            if p not in params:
                raise ValueError(f"identify_all needs the parameter {p!r}")
        if self.label_df is None and self._full is None:
            raise ValueError("identify_all runs all five methods, and two of them need labels")
        self.identify_missing(params["missing_threshold"])
        self.identify_single_unique()
        self.identify_collinear(params["correlation_threshold"])
        self.identify_zero_importance(params.get("n_iterations", 10), params.get("num_trees", 100))
        self.identify_low_importance(params["cumulative_importance"])
        return self.check_removal()

    def check_removal(self, keep_one_hot: bool = True) -> list[str]:
        """FS7: every identified feature, each once."""
        found = list(dict.fromkeys(chain(*self.ops.values())))
        if not keep_one_hot:
            found += [c for c in self.one_hot_features if c not in found]
        return found

    def remove(self, methods="all", keep_one_hot: bool = True) -> DataFrame:
        """FS8: drop the identified features (one-hot columns are part of the data when
        an importance method or one-hot collinearity ran)."""
        if methods == "all":
            methods = list(self.ops)
        for m in methods:
            if m not in self.ops:
                raise RuntimeError(f"nothing identified by {m!r} yet")
        drop = list(dict.fromkeys(chain(*[self.ops[m] for m in methods])))
        data = self.data_all if self.one_hot_features else self.data
        if not keep_one_hot:
            drop += [c for c in self.one_hot_features if c not in drop]
        return data.drop(*drop)

    def n_features_needed(self, threshold: float) -> DataFrame:
        if self.feature_importances is None:
            raise RuntimeError("run identify_zero_importance first")
        return features_needed(self.feature_importances, threshold)

    def collinear_matrix(self) -> DataFrame:
        if self.corr is None:
            raise RuntimeError("run identify_collinear first")
        return collinear_submatrix(self.corr, self.records["collinear"])
