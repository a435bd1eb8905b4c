"""Registered queries for the column-level operators: PJ, FL, BD, TG, RL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import bands, columns as pj, rules, targets as tg
from ...functions.missing import fill_int
from ...operators import clean
from ...operators.lineup import lineup_listing
from .common import AWAY_SQL, HOME_SQL, away_goals, count_by, home_goals, table

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- PJ projections

@register("pj1_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def pj1(spark, sf):
    return clean.drop_columns(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "no_such_column"])


@register("pj2_to_numeric", """
SELECT p_partkey, try_cast(p_name AS DOUBLE) AS p_name, try_cast(substr(p_brand, 7) AS DOUBLE) AS brand_no
FROM part""")
def pj2(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", F.substring("p_brand", 7, 100).alias("brand_no"))
    return clean.to_numeric(df, ["p_name", "brand_no"])


@register("pj3_to_date", """
SELECT o_orderkey, CAST(CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS VARCHAR) AS order_day,
       CAST(try_strptime(strftime(o_orderdate, '%Y-%m-%d') || 'x', '%Y-%m-%d') IS NULL AS INTEGER) AS bad_is_null
FROM orders""")
def pj3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("txt"))
    return o.select("o_orderkey", pj.to_date("txt").cast("string").alias("order_day"),
                    pj.to_date(F.concat("txt", F.lit("x"))).isNull().cast("int").alias("bad_is_null"))


@register("pj4_fill_int", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(trunc(coalesce(nullif(l_discount, 0) * 100, 0)) AS INTEGER) AS disc_pct
FROM lineitem""")
def pj4(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     fill_int(F.expr("nullif(l_discount, 0) * 100")).alias("disc_pct"))


@register("pj5_sum_diff", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       {HOME_SQL} + {AWAY_SQL} AS totgoal, {HOME_SQL} - {AWAY_SQL} AS goalDiff,
       {HOME_SQL} AS FTHG, {AWAY_SQL} AS FTAG
FROM lineitem""")
def pj5(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     pj.sum_pair(home_goals(), away_goals()).alias("totgoal"),
                     pj.diff_pair(home_goals(), away_goals()).alias("goalDiff"),
                     home_goals().alias("FTHG"), away_goals().alias("FTAG"))


@register("pj6_pair_differences", """
SELECT l_orderkey, l_linenumber, l_partkey,
       l_discount - l_tax AS DiffWin12, l_discount - l_quantity / 50 AS DiffWin1N, l_tax - l_quantity / 50 AS DiffWin2N
FROM lineitem""")
def pj6(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("q", F.col("l_quantity") / 50)
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     pj.diff_pair("l_discount", "l_tax").alias("DiffWin12"),
                     pj.diff_pair("l_discount", "q").alias("DiffWin1N"),
                     pj.diff_pair("l_tax", "q").alias("DiffWin2N"))


@register("pj7_per_round", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber - 1 AS DOUBLE) AS rnd,
                  l_extendedprice AS gs, l_quantity AS gc FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN rnd = 0 THEN NULL ELSE gs / rnd END AS HTGS,
       CASE WHEN rnd = 0 THEN NULL ELSE gc / rnd END AS HTGC,
       (CASE WHEN rnd = 0 THEN NULL ELSE gs / rnd END) - (CASE WHEN rnd = 0 THEN NULL ELSE gc / rnd END) AS HTGD
FROM t""")
def pj7(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("rnd", F.col("l_linenumber") - 1)
    out = li.select("l_orderkey", "l_linenumber", "l_partkey",
                    pj.per_unit("l_extendedprice", "rnd").alias("HTGS"),
                    pj.per_unit("l_quantity", "rnd").alias("HTGC"))
    return out.withColumn("HTGD", F.col("HTGS") - F.col("HTGC"))


_PJ8_CODE = ("CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CASE substr(o_orderpriority, 1, 1) "
             "WHEN '3' THEN 'N' WHEN '4' THEN '1 N' WHEN '5' THEN 'N 2' ELSE substr(o_orderpriority, 1, 1) END END")


@register("pj8_indicator_flags", f"""
WITH t AS (SELECT o_orderkey, {_PJ8_CODE} AS w FROM orders)
SELECT o_orderkey,
  coalesce(CAST(w = '1' AS INTEGER), 0) AS w_1, coalesce(CAST(w = '2' AS INTEGER), 0) AS w_2,
  coalesce(CAST(w = 'N' AS INTEGER), 0) AS w_N, coalesce(CAST(w = '1 N' AS INTEGER), 0) AS w_1N,
  coalesce(CAST(w = 'N 2' AS INTEGER), 0) AS w_N2
FROM t""")
def pj8(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_PJ8_CODE).alias("w"))
    return o.select("o_orderkey", *[v.alias(k) for k, v in pj.indicator_flags("w").items()])


@register("pj9_shift_negative", """
SELECT c_custkey, CASE WHEN c_acctbal / 100 < 0 THEN c_acctbal / 100 + 4 ELSE 0.0 END AS pred_goals
FROM customer""")
def pj9(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", pj.shift_negative(F.col("c_acctbal") / 100).alias("pred_goals"))


@register("pj10_coalesce_sibling", """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_tax, 0), l_discount) AS prev_rating FROM lineitem""")
def pj10(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     pj.coalesce_sibling(F.expr("nullif(l_tax, 0)"), "l_discount").alias("prev_rating"))


@register("pj11_fill_groups", """
SELECT l_orderkey, l_linenumber, l_partkey,
       coalesce(nullif(l_tax, 0), 0.0) AS stat_a, coalesce(nullif(l_discount, 0), 0.0) AS stat_b,
       coalesce(nullif(l_linenumber, 1), -9999) AS trend, coalesce(nullif(l_returnflag, 'A'), 'Unknown') AS flag
FROM lineitem""")
def pj11(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.expr("nullif(l_tax, 0)").alias("stat_a"), F.expr("nullif(l_discount, 0)").alias("stat_b"),
        F.expr("nullif(l_linenumber, 1)").alias("trend"), F.expr("nullif(l_returnflag, 'A')").alias("flag"))
    return clean.fill_groups(li, {0: ["stat_a", "stat_b"], -9999: ["trend"], "Unknown": ["flag"]})


_PJ12_ID = "CASE l_partkey % 7 WHEN 0 THEN '0' WHEN 1 THEN NULL ELSE 'ID' || CAST(l_partkey AS STRING) END"
_PJ12_ID2 = "CASE l_suppkey % 5 WHEN 0 THEN '0' WHEN 1 THEN NULL ELSE 'ID' || CAST(l_suppkey AS STRING) END"


@register("pj12_replace_values", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_PJ12_ID} AS pid, l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN pid IS NULL OR pid = '0' THEN 'IDnull' ELSE pid END AS player_id,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS score
FROM t""")
def pj12(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("pid", F.expr(_PJ12_ID))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     pj.replace_idnull("pid").alias("player_id"), pj.zero_to_null("l_tax").alias("score"))


@register("pj13_strip_id", """
SELECT c_custkey, try_cast(replace(c_name, 'Customer#', '') AS BIGINT) AS cust_no FROM customer""")
def pj13(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", pj.strip_id("c_name", "Customer#").alias("cust_no"))


_PJ14_COLS = ("l_discount", "l_tax", "nullif(l_quantity, 50) / 50", "CAST(l_linenumber - 1 AS DOUBLE)")


def _pj14_sql():
    present = [f"CASE WHEN ({c}) <> 0 THEN ({c}) END" for c in _PJ14_COLS]
    total = " + ".join(f"coalesce({p}, 0.0)" for p in present)
    cnt = " + ".join(f"CAST(({p}) IS NOT NULL AS INTEGER)" for p in present)
    return (f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN ({cnt}) > 0 THEN ({total}) / CAST(({cnt}) AS DOUBLE) END "
            f"AS slot_mean FROM lineitem")


@register("pj14_row_mean_nonzero", _pj14_sql())
def pj14(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     pj.row_mean_nonzero([F.expr(c) for c in _PJ14_COLS]).alias("slot_mean"))


@register("pj15_local_time", """
SELECT event_id,
       strftime(timezone('Europe/Paris', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS paris_time,
       strftime(timezone('Europe/Paris', timezone('UTC', ts)), '%H:%M') AS paris_hhmm,
       CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s
FROM events""")
def pj15(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", pj.local_time_text("ts").alias("paris_time"),
                    pj.local_time_text("ts", fmt="HH:mm").alias("paris_hhmm"), pj.epoch_seconds("ts").alias("epoch_s"))


@register("pj16_minutes_between", """
SELECT event_id, (epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(ts))) / 60.0 AS minutes_to_go FROM events""")
def pj16(spark, sf):
    e = table(spark, sf, "events")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return e.select("event_id", pj.minutes_between(now, "ts").alias("minutes_to_go"))


@register("pj17_round_half_even", """
SELECT round_even(l_discount * 10, 0) AS rounded, count(*) AS n FROM lineitem GROUP BY ALL""")
def pj17(spark, sf):
    li = table(spark, sf, "lineitem")
    return count_by(li.select(pj.round_half_even(F.col("l_discount") * 10).alias("rounded")), "rounded")


# ---------------------------------------------------------------- FL filters

_FL1_FLAG = "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END"


@register("fl1_exclude_values", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_FL1_FLAG} AS rf FROM lineitem)
SELECT * FROM t WHERE NOT coalesce(rf IN ('A', 'R'), false)""")
def fl1(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_FL1_FLAG).alias("rf"))
    return clean.exclude_values(li, "rf", ["A", "R"])


@register("fl2_threshold_chain", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE year(l_shipdate) > 1996 AND l_linenumber >= 2 AND l_discount > 0 AND l_tax > 0 AND l_quantity > 0""")
def fl2(spark, sf):
    li = table(spark, sf, "lineitem")
    out = clean.filter_all(li, [F.year("l_shipdate") > 1996, F.col("l_linenumber") >= 2,
                                F.col("l_discount") > 0, F.col("l_tax") > 0, F.col("l_quantity") > 0])
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@register("fl3_all_between", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE (l_discount * 10 + l_tax) BETWEEN 0 AND 1 AND (l_discount * 10) BETWEEN 0 AND 1 AND (l_tax * 12) BETWEEN 0 AND 1""")
def fl3(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({
        "p1": F.col("l_discount") * 10 + F.col("l_tax"), "p2": F.col("l_discount") * 10, "p3": F.col("l_tax") * 12})
    return clean.all_between(li, ["p1", "p2", "p3"]).select("l_orderkey", "l_linenumber", "l_partkey")


@register("fl4_require_present", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_PJ12_ID} AS g, {_PJ12_ID2} AS d1 FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN g IS NULL OR g = '0' THEN 'IDnull' ELSE g END AS g,
             CASE WHEN d1 IS NULL OR d1 = '0' THEN 'IDnull' ELSE d1 END AS d1 FROM t)
SELECT * FROM u WHERE g <> 'IDnull' AND d1 <> 'IDnull'""")
def fl4(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        pj.replace_idnull(F.expr(_PJ12_ID)).alias("g"), pj.replace_idnull(F.expr(_PJ12_ID2)).alias("d1"))
    return clean.require_present(li, ["g", "d1"])


_FL5_NEXT = "CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE 1 + l_discount * 90 END"


@register("fl5_player_filters", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_FL5_NEXT} AS nxt, 1 + l_tax * 100 AS avg_r,
                  year(l_shipdate) AS season FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, nxt FROM t
WHERE avg_r > 0 AND l_linenumber > 2 AND season >= 1996 AND nxt IS DISTINCT FROM 3.5 AND nxt IS DISTINCT FROM 3.7""")
def fl5(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr(_FL5_NEXT).alias("nxt"),
        (1 + F.col("l_tax") * 100).alias("avg_r"), F.year("l_shipdate").alias("season"))
    from ...plans.players import player_filters
    from ...presets import PlayerPreset
    return player_filters(li, predict=True, preset=PlayerPreset(season_ge=1996), next_rating="nxt", avg="avg_r",
                          round_col="l_linenumber", season="season").select("l_orderkey", "l_linenumber", "l_partkey", "nxt")


@register("fl6_noise_filter", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_tax <> 0 AND l_discount <> 0""")
def fl6(spark, sf):
    li = table(spark, sf, "lineitem")
    return clean.filter_all(li, [F.col("l_tax") != 0, F.col("l_discount") != 0]).select(
        "l_orderkey", "l_linenumber", "l_partkey")


_FL7_STEPS = [("season", "year(l_shipdate) > 1995"), ("round", "l_linenumber >= 2"),
              ("odds", "l_discount > 0"), ("range", "(l_discount * 10) BETWEEN 0 AND 1"),
              ("flag", "l_returnflag <> 'R'")]


def _fl7_sql():
    case = " ".join(f"WHEN NOT coalesce({p}, false) THEN {i}" for i, (_, p) in enumerate(_FL7_STEPS, 1))
    sums = ", ".join(f"CAST(sum(CASE WHEN fs = {i} THEN 1 ELSE 0 END) AS BIGINT) AS r{i}"
                     for i in range(1, len(_FL7_STEPS) + 1))
    parts, before = [], "n0"
    for i, (name, _) in enumerate(_FL7_STEPS, 1):
        parts.append(f"SELECT {i} AS step_no, '{name}' AS step, {before} AS rows_before, r{i} AS rows_removed, "
                     f"{before} - r{i} AS rows_after FROM c")
        before = f"({before} - r{i})"
    parts.append(f"SELECT 0, 'total', n0, n0 - {before}, {before} FROM c")
    return (f"WITH f AS (SELECT CASE {case} ELSE 0 END AS fs FROM lineitem), "
            f"c AS (SELECT count(*) AS n0, {sums} FROM f) " + " UNION ALL ".join(parts))


@register("fl7_cleaning_report", _fl7_sql())
def fl7(spark, sf):
    li = table(spark, sf, "lineitem")
    return clean.cleaning_report(li, [(n, F.expr(p)) for n, p in _FL7_STEPS])


@register("fl8_rows_with_missing", """
SELECT CAST(sum(CASE WHEN nullif(l_tax, 0) IS NULL OR nullif(l_discount, 0) IS NULL THEN 1 ELSE 0 END) AS BIGINT)
       AS rows_with_missing, count(*) AS rows FROM lineitem""")
def fl8(spark, sf):
    li = table(spark, sf, "lineitem").select(F.expr("nullif(l_tax, 0)").alias("a"),
                                             F.expr("nullif(l_discount, 0)").alias("b"), "l_orderkey")
    return clean.count_rows_with_missing(li)


# ---------------------------------------------------------------- BD bands

def _band_half_sql(x):
    parts = [f"WHEN {x} >= 3 AND {x} < 3.25 THEN 3.0"]
    parts += [f"WHEN {x} > {c - 0.25} AND {x} < {c + 0.25} THEN {c}" for c in bands.HALF_BAND_CENTRES]
    return f"CASE {' '.join(parts)} WHEN {x} > 9.75 THEN 10.0 ELSE 0.0 END"


def _band_unit_sql(x):
    parts = [f"WHEN {x} > {k - 0.5} AND {x} <= {k + 0.5} THEN {k}" for k in bands.UNIT_BAND_CENTRES]
    return f"CASE {' '.join(parts)} WHEN {x} > 9.5 THEN 10 ELSE 0 END"


@register("bd1_band_half", f"""
SELECT l_quantity / 4.0 AS x, CAST({_band_half_sql('(l_quantity / 4.0)')} AS DOUBLE) AS band, count(*) AS n
FROM lineitem GROUP BY ALL""")
def bd1(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("x", F.col("l_quantity") / 4.0)
    return count_by(li.select("x", bands.band_half("x").alias("band")), "x", "band")


@register("bd2_band_unit", f"""
SELECT l_quantity / 4.0 AS x, {_band_unit_sql('(l_quantity / 4.0)')} AS band, count(*) AS n
FROM lineitem GROUP BY ALL""")
def bd2(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("x", F.col("l_quantity") / 4.0)
    return count_by(li.select("x", bands.band_unit("x").alias("band")), "x", "band")


_BD3 = {"s1": "l_quantity / 5.0", "s2": "1 + l_discount * 90", "s3": "1 + l_tax * 100", "s4": "l_quantity / 4.0"}


@register("bd3_band_columns", "SELECT " + ", ".join(f"{_band_unit_sql('(' + e + ')')} AS {k}" for k, e in _BD3.items())
          + ", count(*) AS n FROM lineitem GROUP BY ALL")
def bd3(spark, sf):
    li = table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in _BD3.items()])
    return count_by(bands.band_columns(li, list(_BD3)), *_BD3)


# ---------------------------------------------------------------- TG targets

_FTR_SQL = (f"CASE WHEN {HOME_SQL} - {AWAY_SQL} > 0 THEN 1 WHEN {HOME_SQL} - {AWAY_SQL} < 0 THEN 2 "
            f"WHEN {HOME_SQL} - {AWAY_SQL} = 0 THEN 0 ELSE -1 END")


def _fixture_frame(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(home_goals().alias("h"), away_goals().alias("a"))


@register("tg1_match_result", f"SELECT {HOME_SQL} AS h, {AWAY_SQL} AS a, {_FTR_SQL} AS FTR, count(*) AS n "
          "FROM lineitem GROUP BY ALL")
def tg1(spark, sf):
    df = _fixture_frame(spark, sf)
    return count_by(df.withColumn("FTR", tg.match_result(F.col("h") - F.col("a"))), "h", "a", "FTR")


@register("tg2_result_flags", f"""
WITH t AS (SELECT {_FTR_SQL} AS FTR FROM lineitem)
SELECT FTR, CAST(FTR = 1 AS INTEGER) AS Team1Win, CAST(FTR <> 1 AS INTEGER) AS NotTeam1Win,
       CAST(FTR = 2 AS INTEGER) AS Team2Win, CAST(FTR <> 2 AS INTEGER) AS NotTeam2Win,
       CAST(FTR = 0 AS INTEGER) AS TeamNWin, CAST(FTR <> 0 AS INTEGER) AS NotTeamNWin, count(*) AS n
FROM t GROUP BY ALL""")
def tg2(spark, sf):
    df = _fixture_frame(spark, sf).withColumn("FTR", tg.match_result(F.col("h") - F.col("a")))
    flags = tg.result_flags("FTR")
    return count_by(df.select("FTR", *[v.alias(k) for k, v in flags.items()]), "FTR", *flags)


@register("tg3_double_chance", f"""
WITH t AS (SELECT {_FTR_SQL} AS FTR FROM lineitem)
SELECT FTR, CAST(FTR IN (1, 0) AS INTEGER) AS Team1N, CAST(FTR IN (2, 0) AS INTEGER) AS Team2N, count(*) AS n
FROM t GROUP BY ALL""")
def tg3(spark, sf):
    df = _fixture_frame(spark, sf).withColumn("FTR", tg.match_result(F.col("h") - F.col("a")))
    flags = tg.double_chance("FTR")
    return count_by(df.select("FTR", *[v.alias(k) for k, v in flags.items()]), "FTR", *flags)


@register("tg4_over_goals", f"""
WITH t AS (SELECT {HOME_SQL} + {AWAY_SQL} AS tot FROM lineitem)
SELECT tot, coalesce(CAST(tot > 0 AS INTEGER), 0) AS Ov05, coalesce(CAST(tot > 1 AS INTEGER), 0) AS Ov15,
       coalesce(CAST(tot > 2 AS INTEGER), 0) AS Ov25, coalesce(CAST(tot > 3 AS INTEGER), 0) AS Ov35,
       coalesce(CAST(tot > 4 AS INTEGER), 0) AS Ov45, count(*) AS n
FROM t GROUP BY ALL""")
def tg4(spark, sf):
    df = _fixture_frame(spark, sf).withColumn("tot", F.col("h") + F.col("a"))
    flags = tg.over_goals("tot")
    return count_by(df.select("tot", *[v.alias(k) for k, v in flags.items()]), "tot", *flags)


@register("tg5_exact_goals", f"""
WITH t AS (SELECT {HOME_SQL} + {AWAY_SQL} AS tot FROM lineitem)
SELECT tot, """ + ", ".join(f"coalesce(CAST(tot = {k} AS INTEGER), 0) AS totgoal{k}" for k in range(6)) + """,
       count(*) AS n FROM t GROUP BY ALL""")
def tg5(spark, sf):
    df = _fixture_frame(spark, sf).withColumn("tot", F.col("h") + F.col("a"))
    flags = tg.exact_goals("tot")
    return count_by(df.select("tot", *[v.alias(k) for k, v in flags.items()]), "tot", *flags)


@register("tg6_both_score", f"""
SELECT {HOME_SQL} AS h, {AWAY_SQL} AS a, coalesce(CAST({HOME_SQL} > 0 AND {AWAY_SQL} > 0 AS INTEGER), 0) AS LDEM,
       count(*) AS n FROM lineitem GROUP BY ALL""")
def tg6(spark, sf):
    df = _fixture_frame(spark, sf)
    return count_by(df.withColumn("LDEM", tg.both_score("h", "a")), "h", "a", "LDEM")


_NEXT, _CUR, _AVG = "1 + l_discount * 90", "l_quantity / 5.0", "1 + l_tax * 100"


def _sign_sql(d):
    return f"CASE WHEN {d} > 0 THEN 1 WHEN {d} < 0 THEN -1 ELSE 0 END"


@register("tg7_trend", f"""
WITH t AS (SELECT {_NEXT} AS nxt, {_CUR} AS cur FROM lineitem),
u AS (SELECT nxt, cur, {_band_unit_sql('nxt')} AS nb, {_band_half_sql('cur')} AS cb FROM t)
SELECT {_sign_sql('(nxt - cur)')} AS NextTrend, {_sign_sql('(nb - cb)')} AS NextTrendRng, count(*) AS n
FROM u GROUP BY ALL""")
def tg7(spark, sf):
    li = table(spark, sf, "lineitem").select(F.expr(_NEXT).alias("nxt"), F.expr(_CUR).alias("cur"))
    li = li.withColumns({"nb": bands.band_unit("nxt"), "cb": bands.band_half("cur")})
    return count_by(li.select(tg.trend("nxt", "cur").alias("NextTrend"), tg.trend("nb", "cb").alias("NextTrendRng")),
                    "NextTrend", "NextTrendRng")


@register("tg8_at_or_above", f"""
WITH t AS (SELECT {_NEXT} AS nxt, {_AVG} AS av FROM lineitem),
u AS (SELECT nxt, av, {_band_unit_sql('nxt')} AS nb, {_band_half_sql('av')} AS ab FROM t)
SELECT CAST(nxt - av >= 0 AS INTEGER) AS NextOvAvg, CAST(nb - av >= 0 AS INTEGER) AS NextRngOvAvg,
       CAST(nb - ab >= 0 AS INTEGER) AS NextRngOvAvgRng, CAST(nxt - ab >= 0 AS INTEGER) AS NextOvAvgRng, count(*) AS n
FROM u GROUP BY ALL""")
def tg8(spark, sf):
    li = table(spark, sf, "lineitem").select(F.expr(_NEXT).alias("nxt"), F.expr(_AVG).alias("av"))
    li = li.withColumns({"nb": bands.band_unit("nxt"), "ab": bands.band_half("av")})
    out = li.select(tg.at_or_above("nxt", "av").alias("NextOvAvg"), tg.at_or_above("nb", "av").alias("NextRngOvAvg"),
                    tg.at_or_above("nb", "ab").alias("NextRngOvAvgRng"), tg.at_or_above("nxt", "ab").alias("NextOvAvgRng"))
    return count_by(out, *out.columns)


#: The thresholds as the oracle knows them, written out and not read from the library.
_DISTANCES = (("15", 1.5), ("10", 1.0), ("07", 0.7), ("05", 0.5), ("03", 0.3), ("02", 0.2))


def _dist_sql(a, b, prefix):
    return ", ".join(f"CAST(abs(({a}) - ({b})) >= {d} AS INTEGER) AS {prefix}{s}" for s, d in _DISTANCES)


@register("tg9_distance_flags", f"SELECT {_dist_sql(_NEXT, _CUR, 'NextRatingDiffOv')}, count(*) AS n FROM lineitem GROUP BY ALL")
def tg9(spark, sf):
    li = table(spark, sf, "lineitem").select(F.expr(_NEXT).alias("nxt"), F.expr(_CUR).alias("cur"))
    flags = tg.distance_flags("nxt", "cur", "NextRatingDiffOv")
    return count_by(li.select(*[v.alias(k) for k, v in flags.items()]), *flags)


@register("tg10_distance_to_avg", f"SELECT {_dist_sql(_NEXT, _AVG, 'NextRatingDiffAvgOv')}, count(*) AS n FROM lineitem GROUP BY ALL")
def tg10(spark, sf):
    li = table(spark, sf, "lineitem").select(F.expr(_NEXT).alias("nxt"), F.expr(_AVG).alias("av"))
    flags = tg.distance_flags("nxt", "av", "NextRatingDiffAvgOv")
    return count_by(li.select(*[v.alias(k) for k, v in flags.items()]), *flags)


_TG11 = {"rating": "l_quantity / 5.0", "PrevRating": "l_quantity / 4.0",
         "PrevRating2": "nullif(l_quantity, 25) / 6.0", "avg": "1 + l_tax * 100",
         "avg2": "1 + l_discount * 50", "NextRating": "1 + l_discount * 90"}


def _tg11_sql(compat: bool) -> str:
    base = ", ".join(f"{e} AS {k}" for k, e in _TG11.items())
    bands_sql = (f"{_band_half_sql('rating')} AS RatingRange, {_band_half_sql('PrevRating')} AS PrevRatingRange, "
                 f"{_band_half_sql('PrevRating2')} AS PrevRating2Range, {_band_half_sql('avg')} AS avgRange, "
                 f"{_band_half_sql('avg2')} AS avg2Range, {_band_unit_sql('NextRating')} AS NextRatingRange")
    thresholds = [(s, (0.2 if (s == "07" and compat) else d)) for s, d in _DISTANCES]
    diffs = ", ".join(f"CAST(abs(NextRating - rating) >= {d} AS INTEGER) AS NextRatingDiffOv{s}" for s, d in thresholds)
    davg = ", ".join(f"CAST(abs(NextRating - avg) >= {d} AS INTEGER) AS NextRatingDiffAvgOv{s}"
                     for s, d in _DISTANCES)
    outs = ", ".join(tg.PLAYER_TARGETS)
    return f"""
WITH t AS (SELECT {base} FROM lineitem),
u AS (SELECT *, {bands_sql} FROM t),
v AS (SELECT *, {_sign_sql('(NextRating - rating)')} AS NextTrend,
             {_sign_sql('(NextRatingRange - RatingRange)')} AS NextTrendRng,
             coalesce(CAST(NextRating - avg >= 0 AS INTEGER), 0) AS NextOvAvg,
             coalesce(CAST(NextRatingRange - avg >= 0 AS INTEGER), 0) AS NextRngOvAvg,
             coalesce(CAST(NextRatingRange - avgRange >= 0 AS INTEGER), 0) AS NextRngOvAvgRng,
             coalesce(CAST(NextRating - avgRange >= 0 AS INTEGER), 0) AS NextOvAvgRng,
             {diffs}, {davg} FROM u)
SELECT {outs}, count(*) AS n FROM v GROUP BY ALL"""


def _tg11(spark, sf, compat):
    li = table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in _TG11.items()])
    return count_by(tg.player_targets(li, reference_compat=compat).select(*tg.PLAYER_TARGETS), *tg.PLAYER_TARGETS)


@register("tg11_player_targets", _tg11_sql(True))
def tg11(spark, sf):
    return _tg11(spark, sf, True)


@register("tg11_player_targets_corrected", _tg11_sql(False))
def tg11b(spark, sf):
    return _tg11(spark, sf, False)


# ---------------------------------------------------------------- RL decision rules

_RL_PROBS = {"Team1Win": "l_discount * 10", "Team2Win": "l_tax * 12", "NotTeam1Win": "1 - l_discount * 10",
             "NotTeam2Win": "1 - l_tax * 12", "W": "l_quantity / 50", "D": "l_extendedprice / 105000",
             "L": "1 - l_quantity / 50", "TeamNWin": "CAST(l_linenumber % 2 AS DOUBLE)"}
_RL_PCT = {"NotTeam1Win": "1 - l_discount * 10", "NotTeam2Win": "1 - l_tax * 12", "W": "l_quantity * 2",
           "D": "l_extendedprice / 1050", "L": "100 - l_quantity * 2", "TeamNWin": "CAST(l_linenumber % 2 AS DOUBLE)"}
_RL_OVER = {"Ov05": "CAST(l_linenumber - 1 AS DOUBLE)", "Ov15": "CAST(l_quantity > 10 AS INTEGER)",
            "Ov25": "CAST(l_quantity > 20 AS INTEGER)", "Ov35": "CAST(l_quantity > 30 AS INTEGER)",
            "Ov45": "CAST(l_quantity > 40 AS INTEGER)"}
_RL_UNDER = {"Ov05": "l_discount * 100 - 5", "Ov15": "l_tax * 100 - 4", "Ov25": "CAST(l_quantity > 20 AS INTEGER)",
             "Ov35": "CAST(l_quantity > 30 AS INTEGER)", "Ov45": "CAST(l_quantity > 40 AS INTEGER)"}


def _with(d):
    return "SELECT " + ", ".join(f"{e} AS {k}" for k, e in d.items()) + " FROM lineitem"


def _frame(spark, sf, d):
    return table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in d.items()])


@register("rl1_final_call", f"""
WITH t AS ({_with(_RL_PROBS)})
SELECT CASE WHEN Team1Win > 0.51 AND NotTeam2Win > 0.51 AND W > L AND W > D AND TeamNWin = 0 THEN '1'
            WHEN Team2Win > 0.51 AND NotTeam1Win > 0.51 AND L > W AND L > D AND TeamNWin = 0 THEN '2'
            WHEN NotTeam1Win > 0.55 AND NotTeam2Win > 0.55 AND D > 0.51 AND D > W AND D > L AND TeamNWin = 1 THEN 'N'
            ELSE ' ? ' END AS call, count(*) AS n FROM t GROUP BY ALL""")
def rl1(spark, sf):
    return count_by(_frame(spark, sf, _RL_PROBS).select(rules.final_call().alias("call")), "call")


@register("rl2_over_line", f"""
WITH t AS ({_with(_RL_OVER)})
SELECT CASE WHEN Ov45 > 0 AND Ov35 > 0 AND Ov25 > 0 AND Ov15 > 0 AND Ov05 > 0 THEN 'Over 4.5'
            WHEN Ov35 > 0 AND Ov25 > 0 AND Ov15 > 0 AND Ov05 > 0 THEN 'Over 3.5'
            WHEN Ov25 > 0 AND Ov15 > 0 AND Ov05 > 0 THEN 'Over 2.5'
            WHEN Ov15 > 0 AND Ov05 > 0 THEN 'Over 1.5'
            WHEN Ov05 > 1 THEN 'Over 1.5' ELSE '' END AS line, count(*) AS n FROM t GROUP BY ALL""")
def rl2(spark, sf):
    return count_by(_frame(spark, sf, _RL_OVER).select(rules.over_line().alias("line")), "line")


@register("rl3_under_line", f"""
WITH t AS ({_with(_RL_UNDER)})
SELECT CASE WHEN Ov45 < 1 AND Ov35 < 1 AND Ov25 < 1 AND Ov15 < 0 AND Ov05 < 0 THEN 'under 0.5'
            WHEN Ov45 < 1 AND Ov35 < 1 AND Ov25 < 1 AND Ov15 < 0 THEN 'Under 1.5'
            WHEN Ov45 < 1 AND Ov35 < 1 AND Ov25 < 1 THEN 'Under 2.5'
            WHEN Ov45 < 1 AND Ov35 < 1 THEN 'Under 3.5'
            WHEN Ov45 < 1 THEN 'Under 4.5' ELSE '' END AS line, count(*) AS n FROM t GROUP BY ALL""")
def rl3(spark, sf):
    return count_by(_frame(spark, sf, _RL_UNDER).select(rules.under_line().alias("line")), "line")


@register("rl4_over_call", """
SELECT CASE WHEN l_discount * 10 > 0.5 THEN 'Over' ELSE '' END AS ou35,
       CASE WHEN l_tax * 12 > 0.5 THEN 'Over' ELSE '' END AS ou15, count(*) AS n FROM lineitem GROUP BY ALL""")
def rl4(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("Ov35Win"), (F.col("l_tax") * 12).alias("Ov15Win"))
    return count_by(li.select(rules.over_call("Ov35Win").alias("ou35"), rules.over_call("Ov15Win").alias("ou15")),
                    "ou35", "ou15")


@register("rl5_single_calls", f"""
WITH t AS ({_with(_RL_PROBS)})
SELECT CASE WHEN Team1Win > 0.5 AND NotTeam2Win > 0.51 AND W > L AND TeamNWin = 0 THEN '1' ELSE '' END AS home,
       CASE WHEN Team2Win > 0.5 AND NotTeam1Win > 0.51 AND L > W AND TeamNWin = 0 THEN '2' ELSE '' END AS away,
       CASE WHEN NotTeam1Win > 0.60 AND NotTeam2Win > 0.60 AND D > W AND D > L AND TeamNWin = 1 THEN 'N' ELSE '' END AS draw,
       count(*) AS n FROM t GROUP BY ALL""")
def rl5(spark, sf):
    df = _frame(spark, sf, _RL_PROBS)
    return count_by(df.select(rules.home_call().alias("home"), rules.away_call().alias("away"),
                              rules.draw_call().alias("draw")), "home", "away", "draw")


@register("rl6_five_way_call", f"""
WITH t AS ({_with(_RL_PCT)})
SELECT CASE WHEN W > D AND W > L AND W > 0.5 AND TeamNWin = 0 THEN '1'
            WHEN L > D AND L > W AND L > 0.5 AND TeamNWin = 0 THEN '2'
            WHEN D > W AND W > L AND (50 - D) > (D - W) AND (W - L) > 6 AND TeamNWin = 1 THEN '1N'
            WHEN D > L AND L > W AND (50 - D) > (D - L) AND (L - W) > 6 AND TeamNWin = 1 THEN 'N2'
            WHEN D > W AND D > L AND NotTeam1Win > 0.60 AND NotTeam2Win > 0.60 AND TeamNWin = 1 THEN 'N'
            ELSE '' END AS call, count(*) AS n FROM t GROUP BY ALL""")
def rl6(spark, sf):
    return count_by(_frame(spark, sf, _RL_PCT).select(rules.five_way_call().alias("call")), "call")


_RL_SLOTS = {"s_g": "l_quantity / 4", "s_d1": "l_quantity / 2", "s_m1": "l_discount * 100",
             "s_f1": "nullif(l_tax, 0) * 100"}


def _not_whole_sql(c):
    return f"coalesce({c} <> floor({c}), true)"


@register("rl7_rating_errors", f"""
WITH t AS ({_with(_RL_SLOTS)})
SELECT {' + '.join(f'CAST({_not_whole_sql(c)} AS INTEGER)' for c in _RL_SLOTS)} AS playerErrors, count(*) AS n
FROM t GROUP BY ALL""")
def rl7(spark, sf):
    df = _frame(spark, sf, _RL_SLOTS)
    return count_by(df.select(rules.rating_errors(list(_RL_SLOTS)).alias("playerErrors")), "playerErrors")


@register("rl8_lineup_verdict", f"""
WITH t AS ({_with(_RL_SLOTS)})
SELECT CASE WHEN NOT ({' OR '.join(_not_whole_sql(c) for c in _RL_SLOTS)}) THEN 'OK'
            WHEN {_not_whole_sql('s_g')} THEN 'ERROR' ELSE 'WARNING' END AS verdict,
       concat_ws(', ', {', '.join(f"CASE WHEN {_not_whole_sql(c)} THEN '{c}' END" for c in _RL_SLOTS)}) AS invalid,
       count(*) AS n FROM t GROUP BY ALL""")
def rl8(spark, sf):
    df = _frame(spark, sf, _RL_SLOTS)
    return count_by(df.select(rules.lineup_verdict(list(_RL_SLOTS), ["s_g"]).alias("verdict"),
                              rules.invalid_slots(list(_RL_SLOTS)).alias("invalid")), "verdict", "invalid")


_RL9_IDS = {"s_g": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_partkey END",
            "s_d1": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_suppkey END"}
_RL9_SCORES = {"s_g": "l_quantity / 4", "s_d1": "l_discount * 100"}


@register("rl9_lineup_listing", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {', '.join(f'{e} AS {k}' for k, e in _RL9_IDS.items())},
                  {', '.join(f'{e} AS {k}Score' for k, e in _RL9_SCORES.items())} FROM lineitem)
SELECT l_orderkey, l_linenumber, slot, score, count(*) AS n FROM (
  SELECT l_orderkey, l_linenumber, 's_g' AS slot, 0 AS slot_no, s_gScore AS score FROM t WHERE s_g IS NOT NULL
  UNION ALL
  SELECT l_orderkey, l_linenumber, 's_d1', 1, s_d1Score FROM t WHERE s_d1 IS NOT NULL) GROUP BY ALL""")
def rl9(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.expr(e).alias(k) for k, e in _RL9_IDS.items()],
        *[F.expr(e).alias(f"{k}Score") for k, e in _RL9_SCORES.items()])
    listing = lineup_listing(li, ["l_orderkey", "l_linenumber"], list(_RL9_IDS))
    return count_by(listing, "l_orderkey", "l_linenumber", "slot", "score")

