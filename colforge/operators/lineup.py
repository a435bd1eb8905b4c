"""Line-up operators: the 18-slot-per-side repetition kept long inside, wide at the edge
(JN3 enrichment, RL9 listing, slot unpivot).

Unpivoting is a narrow ``inline`` over an array of structs (no shuffle); the only
shuffles are the statistics join and the pivot back, both keyed by the fixture.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import nan_to_null
from ..session import materialize

SIDES = ("HT", "AT")
# Slot names of one side, in the reference's order.
SLOTS = ("G", "D1", "D2", "D3", "D4", "D5", "D6", "M1", "M2", "M3", "M4", "M5", "M6", "M7", "F1", "F2", "F3", "F4")


def slot_id_columns(sides=SIDES, slots=SLOTS) -> list[str]:
    return [f"{s}Player{k}" for s in sides for k in slots]


def slot_score_columns(sides=SIDES, slots=SLOTS) -> list[str]:
    return [f"{c}Score" for c in slot_id_columns(sides, slots)]


def slots_long(df: DataFrame, keys, slot_cols, score_suffix: str | None = "Score",
               id_name: str = "player_id", score_name: str = "score") -> DataFrame:
    """Unpivot slot columns to ``(keys…, slot, slot_no, player_id[, score])``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    items = []
    for i, c in enumerate(slot_cols):
        fields = [F.lit(c).alias("slot"), F.lit(i).alias("slot_no"), F.col(c).alias(id_name)]
        if score_suffix is not None:
            fields.append(nan_to_null(F.col(f"{c}{score_suffix}").cast("double")).alias(score_name))
        items.append(F.struct(*fields))
    return df.select(*keys, F.inline(F.array(*items)))


def lineup_listing(df: DataFrame, keys, slot_cols, score_suffix: str = "Score") -> DataFrame:
    """RL9: slot → score for the slots that hold a player, in slot order (all rows)."""
    long = slots_long(df, keys, slot_cols, score_suffix)
    return long.where(F.col("player_id").isNotNull()).drop("player_id")


def _first_statistics(stats: DataFrame, stat_key, stats_cols, order_cols, extra_keys) -> DataFrame:
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    first = F.min_by(F.struct(*[F.col(c) for c in stats_cols]), F.struct(*[F.col(c) for c in order_cols]))
    return (stats.where(F.col(stat_key).isNotNull())
            .groupBy(F.col(stat_key).alias("_cf_pid"), *[F.col(e).alias(f"_cf_{e}") for e in extra_keys]).agg(first.alias("_cf_s")))


def store_statistics(stats: DataFrame, table: str, path: str, stat_key, stats_cols, order_cols, extra_keys=(), buckets: int | None = None) -> str:
    """JN3 for repeated runs: the statistics, one row per player with an entry for each of the
    player's extra keys (leagues: few), as a table bucketed and sorted by player.  Line-ups joined with it by ``enrich_lineup`` shuffle
    their own slots only.  ``buckets`` is ``spark.sql.shuffle.partitions`` by default; fewer
    would make Spark deal out both sides again.  Returns the table's name."""
    n = buckets or int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = _first_statistics(stats, stat_key, list(stats_cols), order_cols, list(extra_keys))
    entry = F.struct(*[F.col(f"_cf_{e}") for e in extra_keys], "_cf_s")
    first = first.groupBy("_cf_pid").agg(F.collect_list(entry).alias("_cf_by"))
    first.repartition(n, "_cf_pid").write.mode("overwrite").option("path", path).bucketBy(n, "_cf_pid").sortBy("_cf_pid").saveAsTable(table)
    return table


def enrich_lineup(df: DataFrame, key: str, slot_cols, stats: DataFrame | str, stat_key, stats_cols,
                  order_cols, extra_keys=(), drop_scores: bool = True, score_suffix: str = "Score",
                  absent=("IDnull", "0")) -> DataFrame:
    """JN3: for every fixture and slot, look up the player's statistics and add
    ``<slot>_<stat>`` columns; the first statistics row in ``order_cols`` wins.

    ``stat_key`` names the player column of ``stats``; ``extra_keys`` are further
    columns present on both sides (league) that must match as well, a missing one
    matching a missing one.  The statistics are deduplicated with a partial-aggregating
    ``min_by``, or ``stats`` names a table of ``store_statistics``, which is read bucket by
    bucket without a shuffle.  The slots are unpivoted, those that are empty or hold one of the
    ``absent`` markers (of text ids) are dropped before the shuffle, the rest joined once and pivoted back by a row
    number of the materialised fixtures, so fixtures that share a key stay apart.
    """
    extra_keys, stats_cols = list(extra_keys), list(stats_cols)
    stored = isinstance(stats, str)
    dedup = df.sparkSession.table(stats) if stored else _first_statistics(stats, stat_key, stats_cols, order_cols, extra_keys)
    rows = materialize(df.withColumn("_cf_row", F.monotonically_increasing_id()), "lineup")
    long = slots_long(rows, ["_cf_row", *extra_keys], slot_cols, None)
    held = long.where(F.col("player_id").isNotNull())
    if absent and isinstance(long.schema["player_id"].dataType, T.StringType):
        held = held.where(~F.col("player_id").isin(*absent))
    if stored:  # the player alone is the key of the join, as the buckets are by player
        held = held.withColumn("player_id", F.col("player_id").cast(dedup.schema["_cf_pid"].dataType))
        fits = lambda r: reduce(lambda a, b: a & b, [r[f"_cf_{e}"].eqNullSafe(F.col(e)) for e in extra_keys], F.lit(True))
        found = held.join(dedup, F.col("player_id") == F.col("_cf_pid")).withColumn("_cf_fit", F.get(F.filter("_cf_by", fits), F.lit(0)))
        found = found.where(F.col("_cf_fit").isNotNull()).select("_cf_row", "slot", F.col("_cf_fit")["_cf_s"].alias("_cf_s"))
    else:
        cond = [F.col("player_id") == F.col("_cf_pid")] + [F.col(e).eqNullSafe(F.col(f"_cf_{e}")) for e in extra_keys]
        found = held.join(dedup, cond).select("_cf_row", "slot", "_cf_s")
    wide = found.groupBy("_cf_row").agg(*[F.max(F.when(F.col("slot") == s, F.col("_cf_s"))).alias(s) for s in slot_cols])
    wide = wide.select(F.col("_cf_row").alias("_cf_r"), *[F.col(s)[c].alias(f"{s}_{c}") for s in slot_cols for c in stats_cols])
    out = rows.join(wide, F.col("_cf_row") == F.col("_cf_r"), "left").drop("_cf_row", "_cf_r")
    if drop_scores:
        out = out.drop(*[f"{c}{score_suffix}" for c in slot_cols])
    return out
