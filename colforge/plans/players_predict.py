"""Player rating prediction (CL4).

``fit_players`` prepares past player-match rows (CL2), trains the classifier chain with the
rating itself as its last link, and stores dictionary and chain; ``predict_players`` loads
them, prepares and scores new rows, and shapes the keyed export table (IO7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml.stack import ChainModel, fit_chain
from ..operators.encode import decode_columns, load_dictionary, save_dictionary
from ..presets import PlayerPreset
from ..session import materialize
from ..sources.files import write_keyed
from .players import prepare_players

KEYS = ("Nextfixture_id", "player_id")
RATING = "NextRating"


def fit_players(df: DataFrame, targets, features, root: str, keys=KEYS, preset: PlayerPreset = PlayerPreset(),
                params=None) -> None:
    """Train mode: ``df`` has raw player rows with their targets (TG11).  The chain's links
    are ``targets`` and then the rating, each with a decoder of its own."""
    params = params or {"numTrees": 100, "maxDepth": 10}
    prepared, dictionary = prepare_players(df, False, preset)
    dictionary = materialize(dictionary, "players-dictionary")
    save_dictionary(dictionary, f"{root}/dictionary")
    links = [*targets, RATING]
    hist = materialize(prepared.select(*dict.fromkeys([*keys, *features, *links])), "players-train")
    fit_chain(hist, links, list(features), **params).save(f"{root}/chain")


def predict_players(df: DataFrame, features, root: str, keys=KEYS, preset: PlayerPreset = PlayerPreset(),
                    sink: str | None = None, sink_by=()) -> DataFrame:
    """CL4 predict mode: keys, one ``<target>_pred`` per link and ``NextRating``, the last
    link's call.  With ``sink`` the rows are also written there (IO7), replacing the
    partitions (``sink_by``) that they belong to."""
    spark = df.sparkSession
    prepared, _ = prepare_players(df, True, preset, load_dictionary(spark, f"{root}/dictionary"))
    chain = ChainModel.load(spark, f"{root}/chain")
    new = prepared.select(*dict.fromkeys([*keys, *features, *sink_by]))
    out = chain.transform(new).withColumn(RATING, F.col(f"{RATING}_pred").cast("bigint"))
    out = decode_columns(out, chain.models[-1].labels.withColumn("feature", F.lit(RATING)), [RATING])
    out = out.select(*keys, *[c for c in sink_by if c not in keys], *[f"{t}_pred" for t in chain.targets], RATING)
    if sink:
        write_keyed(out, sink, list(sink_by))
        out = spark.read.parquet(sink)
    return out
