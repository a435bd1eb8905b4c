"""Model registry (IO8): a table of what was trained, and where it is stored.

A model is known by kind, label, half-time flag and version.  An entry also has the
features with their types, the classes, metrics and a running number, by which ``latest``
is resolved.  Entries are rows of a keyed table, so registering a version again replaces
it.  Before a model scores a frame, the frame's columns are compared with its entry.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .keyed import read_keyed, upsert_keyed, versions

KEY = ["kind", "label", "halftime", "version"]
SCHEMA = ("kind string, label string, halftime boolean, version string, number bigint, path string, "
          "features array<struct<name:string,type:string>>, classes array<string>, schema_hash string, metrics map<string,double>, created timestamp")


def model_path(root: str, kind: str, label: str, version: str, halftime: bool = False) -> str:
    """One folder per kind, label, version and half-time flag, like ``<root>/forest/Team1Win/v5/ht``."""
    return "/".join([root.rstrip("/"), kind, label, version, *(["ht"] if halftime else [])])


def _table(root: str) -> str:
    return f"{root.rstrip('/')}/_registry"


def schema_hash(features) -> str:
    """A hash of (name, type) pairs in their order."""
    return hashlib.sha256(json.dumps([list(f) for f in features]).encode()).hexdigest()


def features_of(df: DataFrame, names) -> list[tuple[str, str]]:
    types = dict(df.dtypes)
    return [(n, types[n]) for n in names]


def entries(spark: SparkSession, root: str) -> DataFrame:
    """All entries; empty before the first."""
    if not versions(spark, _table(root)):
        return spark.createDataFrame([], SCHEMA)
    return read_keyed(spark, _table(root))


def register(spark: SparkSession, root: str, kind: str, label: str, version: str, features, classes=(), metrics: dict | None = None,
             halftime: bool = False, created: datetime | None = None) -> str:
    """Enter a model (or enter it again) and return its folder.  ``features`` are (name,
    type) pairs, as ``features_of`` gives them."""
    features = [tuple(f) for f in features]
    path = model_path(root, kind, label, version, halftime)
    number = (entries(spark, root).agg(F.max("number")).first()[0] or 0) + 1
    row = (kind, label, halftime, version, number, path, features, list(classes), schema_hash(features),
           {k: float(v) for k, v in (metrics or {}).items()}, created or datetime.now(timezone.utc))
    upsert_keyed(spark.createDataFrame([row], SCHEMA), _table(root), KEY, buckets=1)
    return path


def resolve(spark: SparkSession, root: str, kind: str, label: str, version: str = "latest", halftime: bool = False) -> Row:
    """The entry of a model; ``latest`` is the one entered last."""
    found = entries(spark, root).where((F.col("kind") == kind) & (F.col("label") == label) & (F.col("halftime") == halftime))
    if version != "latest":
        found = found.where(F.col("version") == version)
    row = found.orderBy(F.desc("number")).limit(1).collect()
    if not row:
        raise LookupError(f"no {kind} model for {label}{' at half-time' if halftime else ''}, version {version}, in {root}")
    return row[0]


def check_frame(entry: Row, df: DataFrame) -> None:
    """Refuse a frame that lacks one of the model's features or has it with another type."""
    types = dict(df.dtypes)
    wrong = [f"{f['name']} ({types.get(f['name'], 'missing')}, not {f['type']})" for f in entry["features"] if types.get(f["name"]) != f["type"]]
    if wrong:
        raise ValueError(f"{entry['kind']} model for {entry['label']}, version {entry['version']}, cannot score this frame: {', '.join(wrong)}")


def save_model(model, df: DataFrame, root: str, kind: str, version: str, metrics: dict | None = None, halftime: bool = False) -> str:
    """Store a trained model and enter it with the features it reads from ``df``."""
    path = model_path(root, kind, model.label, version, halftime)
    model.save(path)
    names = [*model.numeric, *model.categorical]
    return register(df.sparkSession, root, kind, model.label, version, features_of(df, names), [str(c) for c in model.classes], metrics, halftime)


def load_model(spark: SparkSession, root: str, kind: str, label: str, version: str = "latest", halftime: bool = False, df: DataFrame | None = None):
    """The stored model; with ``df``, only if it can score that frame."""
    from ..ml.models import TrainedModel
    entry = resolve(spark, root, kind, label, version, halftime)
    if df is not None:
        check_frame(entry, df)
    return TrainedModel.load(spark, entry["path"])
