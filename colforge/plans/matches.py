"""Match-level plans: prediction (CL5, ML13), validation (CL6) and single-label training (CL7).

``fit_matches`` trains and stores the models and the name dictionary; ``predict_matches``
loads them and scores new fixtures (the prediction load, IO5).  Each label adds its call
and probabilities to the same frame through a narrow ``transform``, so the per-label
results are assembled without any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml.models import TrainedModel, prob_name, train
from ..ml.stack import StackedModel, fit_stack
from ..operators.encode import encode_columns, fit_dictionary, load_dictionary, save_dictionary
from ..operators.evaluate import classification_report
from ..presets import RF_LEVEL0, RF_LEVEL1
from ..session import materialize
from .fixtures import format_fixtures, prepare_fixtures

NAMES = ["country_name", "league_name", "homeTeam", "awayTeam"]


def _prepare(raw: DataFrame, halftime, preset, ids, scores, probas) -> DataFrame:
    return prepare_fixtures(raw, None, preset, halftime, id_cols=ids, score_cols=scores, proba_cols=probas)


#: Level 0 of a stack: a forest and a network.
def _level0(params: dict, network: dict) -> dict:
    return {"forest": ("forest", params), "mlp": ("perceptron", network)}


#: Labels whose call is a single forest's class and not a stack's.
FOREST_LABELS = ("TeamNWin",)
#: Epochs of a network at level 0.
NETWORK = {"layout": "small", "maxIter": 100}


def fit_matches(raw: DataFrame, halftime: DataFrame, labels, features, root: str, preset: str = "v5", ids=None,
                scores=None, probas=None, params=None, network=None, stacked: bool = True) -> None:
    """Train mode of CL5 / ML13: prepare the fixtures once, fit the name dictionary (CL3)
    and one model per label, and store all of it below ``root``."""
    top, params, network = params or RF_LEVEL1, params or RF_LEVEL0, network or NETWORK
    hist = _prepare(raw, halftime, preset, ids, scores, probas)
    names = [c for c in NAMES if c in hist.columns]
    hist = materialize(hist.select("fixture_id", *names, *features, *labels), "matches-train")
    dictionary = materialize(fit_dictionary(hist, names), "matches-names")
    save_dictionary(dictionary, f"{root}/names")
    hist = materialize(encode_columns(hist, dictionary, names, suffix="_code"), "matches-encoded")
    feats = [*features, *[f"{c}_code" for c in names]]
    for label in labels:
        if stacked and label not in FOREST_LABELS:
            model, _ = fit_stack(hist, label, ["fixture_id"], feats, level0=_level0(params, network), level1=top)
        else:
            model = train(hist, label, feats, kind="forest", **params)
        model.save(f"{root}/{label}")


def predict_matches(raw: DataFrame, halftime: DataFrame, labels, features, root: str, preset: str = "v5", ids=None,
                    scores=None, probas=None, stacked: bool = True, raw_columns=()) -> DataFrame:
    """Predict mode of CL5 / ML13: one call per label for every fixture of ``raw``, by the
    models and the name dictionary that ``fit_matches`` stored; nothing is fitted.
    ``raw_columns`` are joined back from the raw rows by fixture (JN2)."""
    spark = raw.sparkSession
    new = _prepare(raw, halftime, preset, ids, scores, probas)
    names = [c for c in NAMES if c in new.columns]
    out = encode_columns(new.select("fixture_id", *names, *features), load_dictionary(spark, f"{root}/names"), names, suffix="_code")
    out = materialize(out, "matches-new")
    calls = [c for c in out.columns if c not in features and not c.endswith("_code")]
    for label in labels:
        kind = StackedModel if stacked and label not in FOREST_LABELS else TrainedModel
        model = kind.load(spark, f"{root}/{label}")
        keep = {"predicted": f"{label}_call", **{prob_name(c): f"{label}_{prob_name(c)}" for c in model.classes}}
        scored = model.transform(out).withColumnsRenamed(keep)
        out = scored.select(*out.columns, *keep.values())
        calls += keep.values()
    out = out.select(*calls)
    if raw_columns:
        back = raw.select(F.col("fixture_id").alias("_cf_id"), *raw_columns)
        out = out.join(back, F.col("fixture_id") == F.col("_cf_id"), "left").drop("_cf_id")
    return out


def validate_matches(raw: DataFrame, halftime: DataFrame, label: str, features, preset: str = "stack",
                     ids=None, scores=None, probas=None, params=None, network=None) -> DataFrame:
    """CL6: prepare, stack (SP3 split; a forest and a network at level 0, a forest at level
    1) and report the level-1 model on its held-out half."""
    top, params, network = params or RF_LEVEL1, params or RF_LEVEL0, network or NETWORK
    data = materialize(_prepare(raw, halftime, preset, ids, scores, probas).select("fixture_id", *features, label), "validate")
    _, held = fit_stack(data, label, ["fixture_id"], features, level0=_level0(params, network), level1=top)
    held = held.withColumn("_cf_true", F.col(label).cast("string"))
    return classification_report(held, "_cf_true", "predicted")


def train_label(raw: DataFrame, halftime: DataFrame, label: str, features, preset: str = "v5", ids=None,
                scores=None, probas=None, layout: str = "small", split_ratio: float = 0.8, epochs: int = 100) -> DataFrame:
    """CL7: the old single-label trainer: format (CL3: prepared and dictionary-encoded rows,
    head/tail split in fixture order), perceptron on the head, report on the tail."""
    parts, _ = format_fixtures(raw, label, preset, halftime, split_ratio=split_ratio, id_cols=ids, score_cols=scores, proba_cols=probas)
    feats = [*features, *[c for c in NAMES if c in parts.columns]]
    parts = materialize(parts.select("fixture_id", "split", label, *feats), "train-label")
    m = train(parts.where(F.col("split") == "head"), label, feats, kind="perceptron", layout=layout,
              maxIter=epochs, balanced=False)
    pred = m.transform(parts.where(F.col("split") == "tail")).withColumn("_cf_true", F.col(label).cast("string"))
    return classification_report(pred, "_cf_true", "predicted")
