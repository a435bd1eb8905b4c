"""Two-level stacking (ML9, ML10) and classifier chains (ML11, ML12).

Level-0 models are applied one after another as narrow ``transform`` steps that add
probability columns to the same frame, so stacking needs no join at all; rows are
matched by their own identity, never by position.  Level-1 rows are disjoint from the
level-0 training rows (SP3), so level-1 features are out-of-sample.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.split import stacking_split, stratified_split
from ..presets import RF_LEVEL0, RF_LEVEL1
from ..session import materialize
from .cells import CELL_PARAMS, fit_links, predict_links, shared_bins
from .models import TrainedModel, prob_name, train


def add_level0(model: TrainedModel, df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """Score ``df`` and keep only the probabilities, renamed ``<name>_<p_class>``."""
    before = set(df.columns)
    pred = model.transform(df)
    probs = {prob_name(c): f"{name}_{prob_name(c)}" for c in model.classes}
    pred = pred.withColumnsRenamed(probs)
    extra = [c for c in pred.columns if c not in before and c not in probs.values()]
    return pred.drop(*extra), list(probs.values())


def _write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def _read_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/meta").first()[0])


@dataclass
class StackedModel:
    level0: dict                       # name -> TrainedModel
    level1: TrainedModel
    base_numeric: list
    categorical: list
    level0_cols: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name, m in self.level0.items():
            out, _ = add_level0(m, out, name)
        return self.level1.transform(out)

    @property
    def classes(self) -> list:
        return self.level1.classes

    def save(self, path: str) -> None:
        for name, m in self.level0.items():
            m.save(f"{path}/level0/{name}")
        self.level1.save(f"{path}/level1")
        _write_meta(self.level1.labels.sparkSession, path, {"level0": list(self.level0), "numeric": self.base_numeric,
                                                            "categorical": self.categorical, "cols": self.level0_cols})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "StackedModel":
        meta = _read_meta(spark, path)
        return StackedModel({n: TrainedModel.load(spark, f"{path}/level0/{n}") for n in meta["level0"]},
                            TrainedModel.load(spark, f"{path}/level1"), meta["numeric"], meta["categorical"], meta["cols"])


def fit_stack(df: DataFrame, label: str, key_cols, numeric, categorical=(), level0=None, level1=None,
              seed: int = 2, level0_labels: dict | None = None):
    """ML9 / ML10: SP3 split → level-0 models on ``level0_train`` → their probabilities
    on ``level1`` rows → level-1 forest on a stratified half, reported on the other.

    ``level0`` maps a name to ``(kind, params)``; ``level0_labels`` optionally gives a
    different label per level-0 model (ML10: several targets feeding one).
    Returns ``(StackedModel, level-1 predictions of the held-out half)``.
    """
    numeric, categorical, key_cols = list(numeric), list(categorical), list(key_cols)
    level0 = level0 or {"forest": ("forest", RF_LEVEL0)}
    level1 = level1 or RF_LEVEL1
    level0_labels = level0_labels or {}
    split = stacking_split(df, label, key_cols, seed=seed, fold_col="_cf_stack")
    l0 = split.where(F.col("_cf_stack") == "level0_train")
    l1 = split.where(F.col("_cf_stack") == "level1").drop("_cf_stack")
    models, cols = {}, []
    for name, (kind, params) in level0.items():
        m = train(l0, level0_labels.get(name, label), numeric, categorical, kind, seed=seed, **params)
        models[name] = m
        l1, new = add_level0(m, l1, name)
        cols += new
    l1 = materialize(l1, "stack-level1")
    halves = stratified_split(l1, label, key_cols, 0.5, seed=seed, split_col="_cf_half")
    top = train(halves.where(F.col("_cf_half") == "train"), label, numeric + cols, categorical, "forest",
                seed=seed, **level1)
    held = top.transform(halves.where(F.col("_cf_half") == "test").drop("_cf_half"))
    return StackedModel(models, top, numeric, categorical, cols), held


@dataclass
class ChainModel:
    targets: list
    models: list

    def save(self, path: str) -> None:
        for i, m in enumerate(self.models):
            m.save(f"{path}/link{i}")
        _write_meta(self.models[0].labels.sparkSession, path, {"targets": self.targets})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ChainModel":
        targets = _read_meta(spark, path)["targets"]
        return ChainModel(targets, [TrainedModel.load(spark, f"{path}/link{i}") for i in range(len(targets))])

    def transform(self, df: DataFrame, checkpoint_every: int = 5) -> DataFrame:
        """ML11: apply the chain in order; each prediction becomes a feature of the next.
        The plan is materialised every few links to keep the lineage short; a chain fitted
        on cells is scored on cells, which needs no more than one join."""
        bins = shared_bins(self.models)
        if bins is not None:
            return predict_links(df, self.models, self.targets, bins)
        out = df
        for i, (t, m) in enumerate(zip(self.targets, self.models), start=1):
            pred = m.transform(out.drop(*[c for c in (t,) if c in out.columns]))
            out = pred.withColumn(f"{t}_pred", F.col("prediction").cast("double")).drop(
                "prediction", "predicted", *[prob_name(c) for c in m.classes])
            if i % checkpoint_every == 0:
                out = materialize(out, "chain")
        return out


def fit_chain(df: DataFrame, targets, numeric, categorical=(), kind: str = "forest", seed: int = 2,
              checkpoint_every: int = 5, **params) -> ChainModel:
    """ML12: target *i* is trained on the base features plus the predictions of the
    targets before it (predictions, not true values, so training matches scoring).
    Forests of many rows are fitted on counted cells where those are far fewer."""
    targets, numeric = list(targets), list(numeric)
    if kind == "forest" and not categorical and set(params) <= CELL_PARAMS:
        models = fit_links(df, targets, numeric, seed, params)
        if models is not None:
            return ChainModel(targets, models)
    models = []
    cur = df
    feats = list(numeric)
    for i, t in enumerate(targets, start=1):
        m = train(cur, t, feats, categorical, kind, seed=seed, **params)
        models.append(m)
        pred = m.transform(cur)
        cur = pred.withColumn(f"{t}_pred", F.col("prediction").cast("double")).drop(
            "prediction", "predicted", *[prob_name(c) for c in m.classes])
        feats.append(f"{t}_pred")
        if i % checkpoint_every == 0:
            cur = materialize(cur, "chain-fit")
    return ChainModel(targets, models)
