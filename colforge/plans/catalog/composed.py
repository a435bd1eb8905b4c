"""Registered queries for sources and composed plans: IO1–IO6, CL1–CL3.

The fixtures and players tables are synthetic renames of the driver's ``orders`` and
``lineitem`` tables (FIXTURES.md §4).  Their columns are SQL expressions that read the
same in Spark and DuckDB, so the raw stand-in is built from one text in both engines;
the preparation itself is the library's plan on the Spark side and hand-written SQL on
the oracle side.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions import bands
from ...plans.fixtures import format_fixtures, prepare_fixtures
from ...plans.players import prepare_players
from ...presets import PlayerPreset
from ...session import materialize, scratch_path
from ...sources import files
from .common import table

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- IO sources

_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@register("io1_read_csv", "SELECT * FROM customer")
def io1(spark, sf):
    path = scratch_path(spark, "io1-customer-csv")
    files.write_table_csv(table(spark, sf, "customer"), path)
    return files.read_table_csv(spark, path, _CUSTOMER_SCHEMA)


_IO2 = {"k": "o_orderkey", "status": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END",
        "price": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END"}


@register("io2_write_csv_tab", "SELECT " + ", ".join(f"{e} AS {k}" for k, e in _IO2.items()) + " FROM orders")
def io2(spark, sf):
    df = table(spark, sf, "orders").select(*[F.expr(e).alias(k) for k, e in _IO2.items()])
    path = scratch_path(spark, "io2-orders-tsv")
    files.write_table_csv(df, path, sep="\t")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("status", T.StringType()),
                           T.StructField("price", T.DoubleType())])
    return files.read_table_csv(spark, path, schema, sep="\t")


_SCORES = {"s1": "l_quantity / 5.0", "s2": "1 + l_discount * 90", "s3": "1 + l_tax * 100", "s4": "l_quantity / 4.0"}
_IO_FLAG = "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END"


def _band_sql(x):
    parts = [f"WHEN {x} > {k - 0.5} AND {x} <= {k + 0.5} THEN {k}" for k in bands.UNIT_BAND_CENTRES]
    return f"CASE {' '.join(parts)} WHEN {x} > 9.5 THEN 10 ELSE 0 END"


def _io_frame(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr(_IO_FLAG).alias("flag"),
        *[F.expr(e).alias(k) for k, e in _SCORES.items()])


_IO_BANDED = ", ".join(f"{_band_sql('(' + e + ')')} AS {k}" for k, e in _SCORES.items())


@register("io3_training_load", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_IO_FLAG} AS flag, {_IO_BANDED} FROM lineitem
WHERE NOT coalesce(({_IO_FLAG}) IN ('A', 'R'), false)""")
def io3(spark, sf):
    return files.load_training(_io_frame(spark, sf), list(_SCORES), "flag", ["A", "R"])


@register("io4_validation_load", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_IO_FLAG} AS flag, {_IO_BANDED} FROM lineitem""")
def io4(spark, sf):
    return files.load_validation(_io_frame(spark, sf), list(_SCORES))


@register("io5_prediction_load", f"""
SELECT event_id, ts, {_band_sql('(value / 40)')} AS v FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""")
def io5(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", (F.col("value") / 40).alias("v"))
    since = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return files.load_for_prediction(e, ["v"], "ts", since).orderBy("ts", "event_id")


# ---------------------------------------------------------------- synthetic players (CL2, IO6)

PLAYERS_RAW = {
    "Nextfixture_id": "l_orderkey", "player_id": "l_partkey", "fixture_id": "l_orderkey - 1",
    "H2Hid": "l_suppkey", "team2_id": "l_suppkey % 20", "Nextteam2Id": "l_partkey % 20",
    "event_date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "season": "CAST(year(l_shipdate) + 20 AS INT)", "round": "CAST(l_linenumber * 5 AS INT)",
    "country_code": "l_returnflag",
    "team1": "'T' || CAST(l_suppkey % 20 AS STRING)", "team2": "'T' || CAST(l_partkey % 20 AS STRING)",
    "Nextteam2": "'T' || CAST((l_partkey + 3) % 20 AS STRING)",
    "position": "CASE l_linenumber % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'D' WHEN 2 THEN 'M' ELSE NULL END",
    "birth_country": "nullif(l_linestatus, 'O')",
    "rating": "l_quantity / 5.0", "PrevRating": "CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_quantity / 4.0 END",
    "PrevRating2": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity / 6.0 END",
    "NextRating": "CAST(1 + l_discount * 90 AS STRING)",
    "avg": "1 + l_tax * 100", "avg2": "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 1 + l_discount * 50 END",
    "std2": "l_tax * 10", "LastTrend": "CASE WHEN l_orderkey % 9 = 0 THEN 'x' ELSE CAST(l_linenumber % 3 - 1 AS STRING) END",
    "CumulTrend": "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE CAST(l_partkey % 5 - 2 AS STRING) END",
    "OverAvg": "CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(l_suppkey % 2 AS DOUBLE) END",
    "age": "CAST(18 + l_partkey % 20 AS STRING)", "height": "CAST(170 + l_suppkey % 25 AS STRING)",
    "weight": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(60 + l_partkey % 30 AS STRING) END",
    "teamPoints": "CAST(l_orderkey % 60 AS DOUBLE)",
    "LH2Hrating": "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_extendedprice / 20000 END",
}


def players_raw(spark, sf):
    return table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in PLAYERS_RAW.items()])


def _players_sql(extra_filter: str = "", season_ge: int = 2018) -> str:
    raw = ", ".join(f"{e} AS {k}" for k, e in PLAYERS_RAW.items())
    enc = ["team1", "team2", "Nextteam2", "position", "birth_country"]
    return f"""
WITH raw AS (SELECT {raw} FROM lineitem {extra_filter}),
num AS (SELECT * REPLACE (try_cast(LastTrend AS DOUBLE) AS LastTrend, try_cast(CumulTrend AS DOUBLE) AS CumulTrend,
                          try_cast(NextRating AS DOUBLE) AS NextRating, try_cast(age AS DOUBLE) AS age,
                          try_cast(height AS DOUBLE) AS height, try_cast(weight AS DOUBLE) AS weight) FROM raw),
flt AS (SELECT * EXCLUDE (event_date, H2Hid, fixture_id, country_code, team2_id, Nextteam2Id) FROM num
        WHERE CAST(event_date AS STRING) <= '2020-12-01' AND NextRating > 0 AND avg > 0 AND round > 2
          AND season >= {season_ge} AND NextRating IS DISTINCT FROM 3.5 AND NextRating IS DISTINCT FROM 3.7),
txt AS (SELECT * REPLACE (coalesce(position, 'Unknown') AS position, coalesce(birth_country, 'Unknown') AS birth_country) FROM flt),
enc AS (SELECT * REPLACE ({', '.join(f'dense_rank() OVER (ORDER BY {c}) - 1 AS {c}' for c in enc)}) FROM txt),
fil AS (SELECT * REPLACE (coalesce(avg, 0) AS avg, coalesce(avg2, 0) AS avg2, coalesce(std2, 0) AS std2,
                          coalesce(rating, 0) AS rating, coalesce(PrevRating2, 0) AS PrevRating2,
                          coalesce(teamPoints, 0) AS teamPoints, coalesce(age, 0) AS age, coalesce(height, 0) AS height,
                          coalesce(weight, 0) AS weight, coalesce(LH2Hrating, 0) AS LH2Hrating,
                          coalesce(OverAvg, -9999) AS OverAvg, coalesce(LastTrend, -9999) AS LastTrend) FROM enc),
sib AS (SELECT * REPLACE (coalesce(PrevRating, rating) AS PrevRating) FROM fil),
sib2 AS (SELECT * REPLACE (coalesce(CumulTrend, LastTrend) AS CumulTrend) FROM sib),
ints AS (SELECT * REPLACE (CAST(trunc(coalesce(OverAvg, 0)) AS INTEGER) AS OverAvg,
                           CAST(trunc(coalesce(LastTrend, 0)) AS INTEGER) AS LastTrend,
                           CAST(trunc(coalesce(CumulTrend, 0)) AS INTEGER) AS CumulTrend,
                           CAST(trunc(coalesce(Nextfixture_id, 0)) AS BIGINT) AS Nextfixture_id,
                           CAST(trunc(coalesce(teamPoints, 0)) AS INTEGER) AS teamPoints,
                           CAST(trunc(coalesce(age, 0)) AS INTEGER) AS age, CAST(trunc(coalesce(height, 0)) AS INTEGER) AS height,
                           CAST(trunc(coalesce(weight, 0)) AS INTEGER) AS weight) FROM sib2)
SELECT * FROM ints WHERE PrevRating <> 0 AND rating <> 0"""


_PLAYER_PRESET = PlayerPreset(season_ge=2016)


@register("cl2_prepare_players", _players_sql(season_ge=2016))
def cl2(spark, sf):
    out, _ = prepare_players(players_raw(spark, sf), predict=False, preset=_PLAYER_PRESET)
    return out


@register("io6_player_import", _players_sql("WHERE NOT coalesce(l_returnflag IN ('A'), false)", season_ge=2016))
def io6(spark, sf):
    raw = players_raw(spark, sf)
    raw = files.load_training(raw, [], "country_code", ["A"])
    out, _ = prepare_players(raw, predict=False, preset=_PLAYER_PRESET)
    path = scratch_path(spark, "io6-players")
    out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- synthetic fixtures (CL1, CL3)

SIDE_SLOTS = ("G", "D1", "D2", "M1", "M2", "F1")
IDS = [f"{s}Player{k}" for s in ("HT", "AT") for k in SIDE_SLOTS]
SCORES = [f"{c}Score" for c in IDS]
PROBAS = ["W1", "WN", "W2", "Over0_5goals", "Over1_5goals", "Over2_5goals", "Over3_5goals", "Over4_5goals", "LDEM_YES"]

FIXTURES_RAW = {
    "fixture_id": "o_orderkey", "league_id": "o_custkey % 10",
    "event_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "season": "CAST(year(o_orderdate) + 20 AS INT)",
    "round": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey % 38 AS DOUBLE) END",
    "country_code": "substr(o_orderpriority, 1, 1)", "country_name": "o_orderpriority",
    "league_name": "'L' || CAST(o_custkey % 10 AS STRING)", "homeTeam": "'T' || CAST(o_custkey % 20 AS STRING)",
    "awayTeam": "'T' || CAST((o_custkey + 7) % 20 AS STRING)", "region_name": "o_orderstatus",
    "homeUpdated": "'x'", "awayUpdated": "'x'", "statusShort": "'FT'", "status": "'Match Finished'",
    "goalsHomeTeam": "CAST(o_orderkey % 5 AS DOUBLE)", "goalsAwayTeam": "CAST(nullif(o_custkey % 4, 3) AS DOUBLE)",
    "HTGS": "o_totalprice / 10000", "HTGC": "CAST(o_orderkey % 13 AS DOUBLE)", "HTP": "CAST(o_custkey % 17 AS DOUBLE)",
    "ATGS": "o_totalprice / 20000", "ATGC": "CAST(o_custkey % 11 AS DOUBLE)", "ATP": "CAST(o_orderkey % 19 AS DOUBLE)",
    "HTF": "CAST(o_orderkey % 3 AS DOUBLE)",
    "ATF": "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS DOUBLE) END",
    "pred_match_winner": ("CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CASE substr(o_orderpriority, 1, 1) "
                          "WHEN '3' THEN 'N' WHEN '4' THEN '1 N' WHEN '5' THEN 'N 2' "
                          "ELSE substr(o_orderpriority, 1, 1) END END"),
    "pred_under_over": "CAST(o_orderkey % 4 AS DOUBLE) - 1.5",
    "pred_goals_home": "CAST(o_orderkey % 7 AS DOUBLE) - 3.0", "pred_goals_away": "CAST(o_custkey % 5 AS DOUBLE) - 2.0",
    "BW1": "o_totalprice / 100000", "BWN": "CAST(o_orderkey % 11 AS DOUBLE) / 10",
    "BW2": "CAST(o_custkey % 9 AS DOUBLE) * 0.5", "BLDEM_YES": "CAST(o_custkey % 6 AS DOUBLE) / 3",
    "W1": "CAST(o_orderkey % 90 AS STRING) || 'e-2'", "WN": "CAST(o_custkey % 50 AS STRING) || 'e-2'",
    "W2": "CASE WHEN o_orderkey % 17 = 0 THEN 'abc' ELSE CAST((o_orderkey + o_custkey) % 60 AS STRING) || 'e-2' END",
    "Over0_5goals": "CAST(o_orderkey % 120 AS STRING) || 'e-2'",
    "Over1_5goals": "CAST(o_custkey % 100 AS STRING) || 'e-2'",
    "Over2_5goals": "CAST(o_orderkey % 80 AS STRING) || 'e-2'",
    "Over3_5goals": "CAST(o_orderkey % 70 AS STRING) || 'e-2'",
    "Over4_5goals": "CAST(o_custkey % 101 AS STRING) || 'e-2'",
    "LDEM_YES": "CASE WHEN o_custkey % 23 = 0 THEN 'NA' ELSE CAST(o_custkey % 90 AS STRING) || 'e-2' END",
}
FIXTURES_RAW["homeWin_halftime"] = "CAST(o_orderkey % 10 AS DOUBLE) / 10"
FIXTURES_RAW["awayWin_halftime"] = "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE CAST(o_custkey % 7 AS DOUBLE) / 10 END"
for _i, _c in enumerate(IDS):
    FIXTURES_RAW[_c] = (f"CASE WHEN o_orderkey % {7 + _i} = 0 THEN NULL WHEN o_orderkey % {17 + _i} = 0 THEN '0' "
                        f"ELSE 'ID' || CAST(o_custkey + {_i} AS STRING) END")
    FIXTURES_RAW[f"{_c}Score"] = (f"CASE WHEN o_orderkey % {5 + _i} = 0 THEN NULL "
                                  f"ELSE CAST((o_orderkey + {_i}) % 9 AS DOUBLE) * 0.5 END")

HALFTIME_RAW = {"league_id": "CAST(r_regionkey AS BIGINT)", "homeWin_halftime": "CAST(r_regionkey AS DOUBLE) / 10",
                "awayWin_halftime": "CAST(5 - r_regionkey AS DOUBLE) / 10"}


def fixtures_raw(spark, sf):
    return table(spark, sf, "orders").select(*[F.expr(e).alias(k) for k, e in FIXTURES_RAW.items()])


def halftime_table(spark, sf):
    return table(spark, sf, "region").select(*[F.expr(e).alias(k) for k, e in HALFTIME_RAW.items()])


def _mean_sql(cols):
    present = [f"CASE WHEN {c} <> 0 THEN {c} END" for c in cols]
    total = " + ".join(f"coalesce({p}, 0.0)" for p in present)
    cnt = " + ".join(f"CAST(({p}) IS NOT NULL AS INTEGER)" for p in present)
    return f"CASE WHEN ({cnt}) > 0 THEN ({total}) / CAST(({cnt}) AS DOUBLE) END"


#: What the oracles know of the presets, written out and not read from the library.
_SQL_PRESETS = {
    "base": SimpleNamespace(season_gt=2015, round_ge=2, check_over05=True, numeric_cols=("W1", "W2"), int_cols=("HTF", "ATF", "round"), halftime="group_mean",
                            required_slots=("HTPlayerG", "HTPlayerD1", "HTPlayerM1", "HTPlayerF1", "ATPlayerG", "ATPlayerD1", "ATPlayerM1", "ATPlayerF1"),
                            exact_goal_labels=False, keep_ftr_totgoal=False, drop_ids=False),
    "vocab": SimpleNamespace(season_gt=2015, round_ge=2, check_over05=True, numeric_cols=("W1", "W2"), int_cols=("round",), halftime="lookup",
                             required_slots=("HTPlayerG", "ATPlayerG"), exact_goal_labels=True, keep_ftr_totgoal=False, drop_ids=False),
    "stack": SimpleNamespace(season_gt=2015, round_ge=3, check_over05=False, numeric_cols=("W1", "W2"), int_cols=("HTF", "ATF", "round"), halftime="lookup",
                             required_slots=("HTPlayerG", "ATPlayerG"), exact_goal_labels=True, keep_ftr_totgoal=True, drop_ids=False),
    "v5": SimpleNamespace(season_gt=2016, round_ge=2),
}


def _fixtures_sql(label: str = "Team1Win") -> str:
    p = _SQL_PRESETS["v5"]
    raw = ", ".join(f"{e} AS {k}" for k, e in FIXTURES_RAW.items())
    ht = ", ".join(f"{e} AS {k}" for k, e in HALFTIME_RAW.items())
    probas = ", ".join(f"try_cast({c} AS DOUBLE) AS {c}" for c in PROBAS)
    ids = ", ".join(f"CASE WHEN {c} IS NULL OR {c} = '0' THEN 'IDnull' ELSE {c} END AS {c}" for c in IDS)
    groups = {}
    for c in SCORES:
        side, slot = c[:2], c[len("HTPlayer"):-len("Score")]
        if slot[0] in "DMF":
            groups.setdefault(f"{side}Player{slot[0]}Score", []).append(c)
    means = ", ".join(f"{_mean_sql(cols)} AS {g}" for g, cols in groups.items())
    scores_out = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in SCORES)
    ranged = [c for c in PROBAS if c != "Over0_5goals"]
    where = " AND ".join([f"season > {p.season_gt}", f"round >= {p.round_ge}", "BW1 > 0", "BW2 > 0", "BWN > 0"]
                         + [f"{c} BETWEEN 0 AND 1" for c in ranged] + ["HTPlayerG <> 'IDnull'"])
    ftr = "CASE WHEN h - a > 0 THEN 1 WHEN h - a < 0 THEN 2 WHEN h - a = 0 THEN 0 ELSE -1 END"
    labels = {"Team1Win": f"coalesce(CAST(({ftr}) = 1 AS INTEGER), 0)", "FTR": ftr,
              "LDEM": "coalesce(CAST(h > 0 AND a > 0 AS INTEGER), 0)"}
    nums_fill = (["HTGS", "HTGC", "HTP", "ATGS", "ATGC", "ATP", "HTGD", "ATGD", "DiffWin12", "DiffWin1N", "DiffWin2N",
                  "homeWin_halftime", "awayWin_halftime", "pred_under_over", "BLDEM_YES"] + PROBAS
                 + ["HTPlayerDScore", "HTPlayerMScore", "HTPlayerFScore", "ATPlayerDScore", "ATPlayerMScore",
                    "ATPlayerFScore"])
    return f"""
WITH raw AS (SELECT {raw} FROM orders),
ht AS (SELECT {ht} FROM region),
s1 AS (SELECT fixture_id, league_id, season, country_name, league_name, homeTeam, awayTeam, region_name,
              CAST(trunc(coalesce(round, 0)) AS INTEGER) AS round, CAST(trunc(coalesce(HTF, 0)) AS INTEGER) AS HTF,
              CAST(trunc(coalesce(ATF, 0)) AS INTEGER) AS ATF, HTGS, HTGC, HTP, ATGS, ATGC, ATP, {probas},
              BW1, BWN, BW2, BLDEM_YES, pred_under_over, pred_goals_home, pred_goals_away, pred_match_winner,
              goalsHomeTeam AS h, goalsAwayTeam AS a, {ids},
              {', '.join(f'CASE WHEN {c} = 0 THEN NULL ELSE {c} END AS {c}' for c in SCORES)} FROM raw),
s2 AS (SELECT * EXCLUDE ({', '.join(SCORES)}), {means}, {scores_out}, {labels[label]} AS {label} FROM s1),
s3 AS (SELECT s2.*, ht.homeWin_halftime, ht.awayWin_halftime FROM s2 LEFT JOIN ht ON s2.league_id = ht.league_id),
s4 AS (SELECT * REPLACE (CASE WHEN pred_goals_home < 0 THEN pred_goals_home + 4 ELSE 0.0 END AS pred_goals_home,
                         CASE WHEN pred_goals_away < 0 THEN pred_goals_away + 4 ELSE 0.0 END AS pred_goals_away),
              coalesce(CAST(pred_match_winner = '1' AS INTEGER), 0) AS pred_match_winner_1,
              coalesce(CAST(pred_match_winner = '2' AS INTEGER), 0) AS pred_match_winner_2,
              coalesce(CAST(pred_match_winner = 'N' AS INTEGER), 0) AS pred_match_winner_N,
              coalesce(CAST(pred_match_winner = '1 N' AS INTEGER), 0) AS pred_match_winner_1N,
              coalesce(CAST(pred_match_winner = 'N 2' AS INTEGER), 0) AS pred_match_winner_N2 FROM s3),
s5 AS (SELECT * FROM s4 WHERE {where}),
s6 AS (SELECT * REPLACE (HTGS / round AS HTGS, HTGC / round AS HTGC, HTP / round AS HTP,
                         ATGS / round AS ATGS, ATGC / round AS ATGC, ATP / round AS ATP),
              W1 - W2 AS DiffWin12, W1 - WN AS DiffWin1N, W2 - WN AS DiffWin2N FROM s5),
s7 AS (SELECT *, HTGS - HTGC AS HTGD, ATGS - ATGC AS ATGD FROM s6)
SELECT * EXCLUDE (h, a, pred_match_winner, {', '.join(IDS)})
       REPLACE ({', '.join(f'coalesce({c}, 0.0) AS {c}' for c in nums_fill)})
FROM s7"""


CL1_SQL = _fixtures_sql("Team1Win")


def _cl1(spark, sf):
    return prepare_fixtures(fixtures_raw(spark, sf), "Team1Win", "v5", halftime_table(spark, sf),
                            id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)


@register("cl1_prepare_fixtures", CL1_SQL)
def cl1(spark, sf):
    return _cl1(spark, sf)


def _fixtures_base_sql(label: str = "Team1Win", preset: str = "base") -> str:
    """The presets that replace ids after the fill (*base*, *vocab*, *stack*): only
    W1/W2 coerced, ids kept, required slots checked after the fill; half-time rates
    from a group mean over all rows (*base*) or the lookup table (*vocab*, *stack*)."""
    p = _SQL_PRESETS[preset]
    raw = ", ".join(f"{e} AS {k}" for k, e in FIXTURES_RAW.items())
    ht = ", ".join(f"{e} AS {k}" for k, e in HALFTIME_RAW.items())
    text_probas = [c for c in PROBAS if c not in p.numeric_cols]
    groups = {}
    for c in SCORES:
        side, slot = c[:2], c[len("HTPlayer"):-len("Score")]
        if slot[0] in "DMF":
            groups.setdefault(f"{side}Player{slot[0]}Score", []).append(c)
    means = ", ".join(f"{_mean_sql(cols)} AS {g}" for g, cols in groups.items())
    ranged = [c for c in PROBAS if p.check_over05 or c != "Over0_5goals"]
    where = " AND ".join([f"season > {p.season_gt}", f"round >= {p.round_ge}", "BW1 > 0", "BW2 > 0", "BWN > 0"]
                         + [f"try_cast({c} AS DOUBLE) BETWEEN 0 AND 1" for c in ranged])
    ftr = "CASE WHEN h - a > 0 THEN 1 WHEN h - a < 0 THEN 2 WHEN h - a = 0 THEN 0 ELSE -1 END"
    required = [s for s in p.required_slots if s in IDS]
    ints = {c: f"CAST(trunc(coalesce({c}, 0)) AS INTEGER) AS {c}" for c in p.int_cols}
    int_sql = ", ".join(ints.get(c, c) for c in ("round", "HTF", "ATF"))
    kept = ", ".join([f"{ftr} AS FTR", "h + a AS totgoal"]) + ", " if p.keep_ftr_totgoal else ""
    if p.halftime == "group_mean":
        halftime = ("s3 AS (SELECT * REPLACE (avg(homeWin_halftime) OVER (PARTITION BY league_id) AS homeWin_halftime, "
                    "avg(awayWin_halftime) OVER (PARTITION BY league_id) AS awayWin_halftime) FROM s2),")
    else:
        halftime = ("s3 AS (SELECT s2.* EXCLUDE (homeWin_halftime, awayWin_halftime), ht.homeWin_halftime, "
                    "ht.awayWin_halftime FROM s2 LEFT JOIN ht ON s2.league_id = ht.league_id),")
    nums_fill = (["HTGS", "HTGC", "HTP", "ATGS", "ATGC", "ATP", "HTGD", "ATGD", "DiffWin12", "DiffWin1N", "DiffWin2N",
                  "homeWin_halftime", "awayWin_halftime", "pred_under_over", "BLDEM_YES", "W1", "W2"]
                 + [c for c in ("HTF", "ATF") if c not in p.int_cols] + list(groups)
                 + (["totgoal"] if p.keep_ftr_totgoal else []))
    text_fill = ["country_name", "league_name", "homeTeam", "awayTeam", "region_name"] + text_probas + IDS
    return f"""
WITH raw AS (SELECT {raw} FROM orders),
ht AS (SELECT {ht} FROM region),
s1 AS (SELECT fixture_id, league_id, season, country_name, league_name, homeTeam, awayTeam, region_name,
              {int_sql}, HTGS, HTGC, HTP, ATGS, ATGC, ATP,
              try_cast(W1 AS DOUBLE) AS W1, try_cast(W2 AS DOUBLE) AS W2, {', '.join(text_probas)},
              BW1, BWN, BW2, BLDEM_YES, pred_under_over, pred_goals_home, pred_goals_away, pred_match_winner,
              homeWin_halftime, awayWin_halftime, goalsHomeTeam AS h, goalsAwayTeam AS a, {', '.join(IDS)},
              {', '.join(f'CASE WHEN {c} = 0 THEN NULL ELSE {c} END AS {c}' for c in SCORES)} FROM raw),
s2 AS (SELECT * EXCLUDE ({', '.join(SCORES)}), {means}, {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in SCORES)},
              {kept}coalesce(CAST(({ftr}) = 1 AS INTEGER), 0) AS {label} FROM s1),
{halftime}
s4 AS (SELECT * REPLACE (CASE WHEN pred_goals_home < 0 THEN pred_goals_home + 4 ELSE 0.0 END AS pred_goals_home,
                         CASE WHEN pred_goals_away < 0 THEN pred_goals_away + 4 ELSE 0.0 END AS pred_goals_away),
              coalesce(CAST(pred_match_winner = '1' AS INTEGER), 0) AS pred_match_winner_1,
              coalesce(CAST(pred_match_winner = '2' AS INTEGER), 0) AS pred_match_winner_2,
              coalesce(CAST(pred_match_winner = 'N' AS INTEGER), 0) AS pred_match_winner_N,
              coalesce(CAST(pred_match_winner = '1 N' AS INTEGER), 0) AS pred_match_winner_1N,
              coalesce(CAST(pred_match_winner = 'N 2' AS INTEGER), 0) AS pred_match_winner_N2 FROM s3),
s5 AS (SELECT * FROM s4 WHERE {where}),
s6 AS (SELECT * REPLACE (HTGS / round AS HTGS, HTGC / round AS HTGC, HTP / round AS HTP,
                         ATGS / round AS ATGS, ATGC / round AS ATGC, ATP / round AS ATP),
              W1 - W2 AS DiffWin12, W1 - try_cast(WN AS DOUBLE) AS DiffWin1N, W2 - try_cast(WN AS DOUBLE) AS DiffWin2N FROM s5),
s7 AS (SELECT *, HTGS - HTGC AS HTGD, ATGS - ATGC AS ATGD FROM s6),
s8 AS (SELECT * EXCLUDE (h, a, pred_match_winner)
       REPLACE ({', '.join(f'coalesce({c}, 0.0) AS {c}' for c in nums_fill)},
                {', '.join(f"coalesce({c}, '0') AS {c}" for c in text_fill)}) FROM s7),
s9 AS (SELECT * REPLACE ({', '.join(f"CASE WHEN {c} = '0' THEN 'IDnull' ELSE {c} END AS {c}" for c in IDS)}) FROM s8)
SELECT * FROM s9 WHERE {' AND '.join(f"{c} <> 'IDnull'" for c in required)}"""


@register("cl1_prepare_fixtures_base", _fixtures_base_sql("Team1Win"))
def cl1_base(spark, sf):
    return prepare_fixtures(fixtures_raw(spark, sf), "Team1Win", "base", None,
                            id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)


@register("cl1_prepare_fixtures_stack", _fixtures_base_sql("Team1Win", "stack"))
def cl1_stack(spark, sf):
    return prepare_fixtures(fixtures_raw(spark, sf), "Team1Win", "stack", halftime_table(spark, sf),
                            id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)


@register("cl1_prepare_fixtures_vocab", _fixtures_base_sql("Team1Win", "vocab"))
def cl1_vocab(spark, sf):
    return prepare_fixtures(fixtures_raw(spark, sf), "Team1Win", "vocab", halftime_table(spark, sf),
                            id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)


_NAMES = ["country_name", "league_name", "homeTeam", "awayTeam", "region_name"]


@register("cl3_format_fixtures", f"""
WITH prepared AS ({CL1_SQL}),
coded AS (SELECT * REPLACE ({', '.join(f'dense_rank() OVER (ORDER BY {c}) - 1 AS {c}' for c in _NAMES + SCORES)})
          FROM prepared),
ranked AS (SELECT *, row_number() OVER (ORDER BY fixture_id) AS _rn FROM coded)
SELECT * EXCLUDE (_rn), CASE WHEN _rn <= (SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM prepared)
                             THEN 'head' ELSE 'tail' END AS split FROM ranked""")
def cl3(spark, sf):
    out, _ = format_fixtures(fixtures_raw(spark, sf), "Team1Win", "v5", halftime_table(spark, sf),
                             split_ratio=0.8, order_cols=["fixture_id"], id_cols=IDS, score_cols=SCORES,
                             proba_cols=PROBAS)
    return out


def _fixture_report_sql() -> str:
    raw = ", ".join(f"{e} AS {k}" for k, e in FIXTURES_RAW.items())
    p = _SQL_PRESETS["v5"]
    ranged = [c for c in PROBAS if c != "Over0_5goals"]
    steps = [("season", f"season > {p.season_gt}"),
             ("round", f"CAST(trunc(coalesce(round, 0)) AS INTEGER) >= {p.round_ge}"),
             ("BW1", "BW1 > 0"), ("BW2", "BW2 > 0"), ("BWN", "BWN > 0"),
             ("probabilities", " AND ".join(f"try_cast({c} AS DOUBLE) BETWEEN 0 AND 1" for c in ranged)),
             ("lineup", "NOT (HTPlayerG IS NULL OR HTPlayerG = '0')")]
    case = " ".join(f"WHEN NOT coalesce({c}, false) THEN {i}" for i, (_, c) in enumerate(steps, 1))
    sums = ", ".join(f"CAST(sum(CASE WHEN fs = {i} THEN 1 ELSE 0 END) AS BIGINT) AS r{i}" for i in range(1, len(steps) + 1))
    parts, before = [], "n0"
    for i, (name, _) in enumerate(steps, 1):
        parts.append(f"SELECT {i} AS step_no, '{name}' AS step, {before} AS rows_before, r{i} AS rows_removed, "
                     f"{before} - r{i} AS rows_after FROM c")
        before = f"({before} - r{i})"
    parts.append(f"SELECT 0, 'total', n0, n0 - {before}, {before} FROM c")
    return (f"WITH raw AS (SELECT {raw} FROM orders), f AS (SELECT CASE {case} ELSE 0 END AS fs FROM raw), "
            f"c AS (SELECT count(*) AS n0, {sums} FROM f) " + " UNION ALL ".join(parts))


@register("fl7_fixture_cleaning_report", _fixture_report_sql())
def fl7b(spark, sf):
    from ...plans.fixtures import fixture_cleaning_report
    return fixture_cleaning_report(fixtures_raw(spark, sf), "v5", proba_cols=PROBAS, id_cols=IDS)



@register("fl7_observed_report", _fixture_report_sql())
def fl7_observed(spark, sf):
    """FL7 from the pass that prepares and stores the fixtures."""
    from ...operators.clean import ObservedSteps
    observed = ObservedSteps()
    materialize(prepare_fixtures(fixtures_raw(spark, sf), "Team1Win", "v5", halftime_table(spark, sf), id_cols=IDS, score_cols=SCORES,
                                 proba_cols=PROBAS, observed=observed), "fl7-prepared")
    return observed.report(spark)


@register("sm3_stream_report", _fixture_report_sql())
def sm3(spark, sf):
    """FL7 of a stream, added up over its micro-batches."""
    from ...streaming.scoring import file_stream, prepare_with_report
    stream = file_stream(spark, f"{sf.rstrip('/')}/orders*.parquet", table(spark, sf, "orders").schema)
    raw = stream.select(*[F.expr(e).alias(k) for k, e in FIXTURES_RAW.items()])
    halftime = halftime_table(spark, sf)
    sink, reports = scratch_path(spark, "sm3-sink"), scratch_path(spark, "sm3-report")
    prepare_with_report(raw, sink, reports, lambda batch, observed: prepare_fixtures(
        batch, "Team1Win", "v5", halftime, id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS, observed=observed))
    report = spark.read.parquet(reports)
    return report.groupBy("step_no", "step").agg(*[F.sum(c).alias(c) for c in ("rows_before", "rows_removed", "rows_after")])


@register("sm1_stream_prepare_fixtures", CL1_SQL)
def sm1(spark, sf):
    """CL1 over a file stream of the orders table: the streamed result equals the batch one."""
    from ...streaming.scoring import file_stream, read_sink, run_available_now
    schema = table(spark, sf, "orders").schema
    stream = file_stream(spark, f"{sf.rstrip('/')}/orders*.parquet", schema)
    raw = stream.select(*[F.expr(e).alias(k) for k, e in FIXTURES_RAW.items()])
    prepared = prepare_fixtures(raw, "Team1Win", "v5", halftime_table(spark, sf),
                                id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)
    sink = scratch_path(spark, "sm1-sink")
    run_available_now(prepared, sink)
    return read_sink(spark, sink)


@register("sm2_stream_scoring")
def sm2(spark, sf):
    """A model fitted on the batch table scores the same rows arriving as a stream."""
    from ...ml.models import train
    from ...streaming.scoring import file_stream, read_sink, score_stream
    o = table(spark, sf, "orders")
    feats = ["o_totalprice"]
    model = train(o, "o_orderstatus", feats, kind="forest", numTrees=10, maxDepth=4)
    stream = file_stream(spark, f"{sf.rstrip('/')}/orders*.parquet", o.schema)
    sink = scratch_path(spark, "sm2-sink")
    score_stream(stream, model, sink, ["o_orderkey", "o_orderstatus"])
    return read_sink(spark, sink)
