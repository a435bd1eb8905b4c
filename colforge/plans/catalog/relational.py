"""Registered queries for joins, set operations, encoders, splits and rebalancing:
JN, ST, EN, SP, SR3, RB1."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import balance, encode, joins, lineup, split
from ...session import scratch_path
from .common import count_by, table

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- JN joins

@register("jn1_lookup", """
SELECT c.c_custkey, c.c_nationkey, n.n_name, n.n_regionkey
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def jn1(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.lookup(c, table(spark, sf, "nation"), "c_nationkey", ["n_name", "n_regionkey"], dim_key="n_nationkey")


@register("jn2_keyed_join", """
SELECT o.o_orderkey AS fixture_id, o.o_custkey AS key, o.o_totalprice AS price_x, c.c_acctbal AS price_y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def jn2(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("fixture_id"), F.col("o_custkey").alias("key"),
                                          F.col("o_totalprice").alias("price"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("price"))
    return joins.keyed_join(o, c, "key")


_SLOTS = [f"S{k}" for k in range(1, 8)]


def _jn3_wide(spark, sf):
    li = table(spark, sf, "lineitem")
    ids = [F.min(F.when(F.col("l_linenumber") == k, F.col("l_partkey"))).alias(f"S{k}") for k in range(1, 8)]
    scores = [F.min(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(f"S{k}Score") for k in range(1, 8)]
    return li.groupBy("l_orderkey").agg(*ids, *scores)


def _jn3_sql():
    ids = ", ".join(f"min(CASE WHEN l_linenumber = {k} THEN l_partkey END) AS S{k}" for k in range(1, 8))
    joins_sql = " ".join(f"LEFT JOIN part p{k} ON w.S{k} = p{k}.p_partkey" for k in range(1, 8))
    cols = ", ".join(f"w.S{k}, p{k}.p_size AS S{k}_p_size, p{k}.p_retailprice AS S{k}_p_retailprice" for k in range(1, 8))
    return f"WITH w AS (SELECT l_orderkey, {ids} FROM lineitem GROUP BY l_orderkey) SELECT w.l_orderkey, {cols} FROM w {joins_sql}"


@register("jn3_lineup_enrich", _jn3_sql())
def jn3(spark, sf):
    wide = _jn3_wide(spark, sf)
    part = table(spark, sf, "part")
    return lineup.enrich_lineup(wide, "l_orderkey", _SLOTS, part, "p_partkey", ["p_size", "p_retailprice"],
                                ["p_partkey"])


@register("jn3_stored_statistics", _jn3_sql())
def jn3_stored(spark, sf):
    """JN3 from statistics stored once, bucketed by player."""
    path = scratch_path(spark, "jn3-statistics")
    name = lineup.store_statistics(table(spark, sf, "part"), f"colforge_{path.rsplit('-', 1)[-1]}", path, "p_partkey", ["p_size", "p_retailprice"], ["p_partkey"])
    return lineup.enrich_lineup(_jn3_wide(spark, sf), "l_orderkey", _SLOTS, name, "p_partkey", ["p_size", "p_retailprice"], ["p_partkey"])


_JN4_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("jn4_first_per_key", f"""
WITH f AS (SELECT l_orderkey, l_quantity, l_discount,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_JN4_ORDER)}) AS rn FROM lineitem)
SELECT o.o_orderkey, o.o_totalprice, f.l_quantity, f.l_discount
FROM orders o LEFT JOIN (SELECT * FROM f WHERE rn = 1) f ON o.o_orderkey = f.l_orderkey""")
def jn4(spark, sf):
    first = joins.first_per_key(table(spark, sf, "lineitem"), "l_orderkey", _JN4_ORDER, ["l_quantity", "l_discount"])
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.join(first, o.o_orderkey == first.l_orderkey, "left").drop("l_orderkey")


@register("jn5_keyed_concat", """
WITH a AS (SELECT o_orderkey AS fixture_id, o_totalprice / 1000 AS Team1Win_ML FROM orders),
b AS (SELECT l_orderkey AS fixture_id, count(*) AS TeamNWin_class FROM lineitem GROUP BY l_orderkey)
SELECT a.fixture_id, Team1Win_ML, TeamNWin_class FROM a JOIN b ON a.fixture_id = b.fixture_id""")
def jn5(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("fixture_id"),
                                          (F.col("o_totalprice") / 1000).alias("Team1Win_ML"))
    b = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("fixture_id")).agg(
        F.count(F.lit(1)).alias("TeamNWin_class"))
    return joins.join_all([a, b], "fixture_id")


# ---------------------------------------------------------------- ST set operations

@register("st1_union_all", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def st1(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                            F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                            F.col("s_acctbal").alias("acctbal"))
    return joins.union_all([c, s])


@register("st2_distinct_values", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def st2(spark, sf):
    return joins.distinct_values(table(spark, sf, "part"), "p_type")


@register("st3_columns_equal", """
SELECT 'tax' AS pair, CAST(bool_and(l_tax IS NOT DISTINCT FROM coalesce(nullif(l_tax, 0), 0.0)) AS INTEGER) AS equal,
       CAST(sum(CASE WHEN l_tax IS NOT DISTINCT FROM coalesce(nullif(l_tax, 0), 0.0) THEN 0 ELSE 1 END) AS BIGINT) AS mismatches,
       count(*) AS rows FROM lineitem
UNION ALL
SELECT 'discount', CAST(bool_and(l_discount IS NOT DISTINCT FROM nullif(l_discount, 0.05)) AS INTEGER),
       CAST(sum(CASE WHEN l_discount IS NOT DISTINCT FROM nullif(l_discount, 0.05) THEN 0 ELSE 1 END) AS BIGINT),
       count(*) FROM lineitem""")
def st3(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_tax", F.expr("coalesce(nullif(l_tax, 0), 0.0)").alias("tax2"),
        "l_discount", F.expr("nullif(l_discount, 0.05D)").alias("disc2"))
    a = joins.columns_equal(li, "l_tax", "tax2").select(F.lit("tax").alias("pair"), "*")
    b = joins.columns_equal(li, "l_discount", "disc2").select(F.lit("discount").alias("pair"), "*")
    return a.unionByName(b)


# ---------------------------------------------------------------- EN encoders

@register("en1_label_encode", """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_size) - 1 AS p_size, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type,
       dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand FROM part""")
def en1(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    d = encode.fit_dictionary(p, ["p_size", "p_type", "p_brand"])
    return encode.encode_columns(p, d, ["p_size", "p_type", "p_brand"])


@register("en2_dictionary", """
SELECT 'c_mktsegment' AS feature, c_mktsegment AS value, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code
FROM (SELECT DISTINCT c_mktsegment FROM customer)
UNION ALL
SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), dense_rank() OVER (ORDER BY c_nationkey) - 1
FROM (SELECT DISTINCT c_nationkey FROM customer)
UNION ALL
SELECT 'c_acctbal_band', CAST(b AS VARCHAR), dense_rank() OVER (ORDER BY b) - 1
FROM (SELECT DISTINCT floor(c_acctbal / 1000) * 1.5 AS b FROM customer)""")
def en2(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_acctbal_band", F.floor(F.col("c_acctbal") / 1000) * 1.5)
    return encode.fit_dictionary(c, ["c_mktsegment", "c_nationkey", "c_acctbal_band"])


@register("en3_decode", "SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def en3(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    d = encode.fit_dictionary(c, ["c_mktsegment", "c_nationkey"])
    coded = encode.encode_columns(c, d, ["c_mktsegment", "c_nationkey"])
    return encode.decode_columns(coded, d, ["c_mktsegment", "c_nationkey"])


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@register("en4_one_hot_fixed", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS \"o_orderpriority_{v}\"" for v in _PRIOS)
    + " FROM orders")
def en4(spark, sf):
    """Vocabulary fitted on the orders that have a set priority, applied to every order;
    the unseen value ('5-LOW') becomes all zeros."""
    o = table(spark, sf, "orders")
    vocab = encode.vocabulary(o.where(F.col("o_orderpriority") != "5-LOW"), "o_orderpriority")
    return encode.one_hot_flags(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority", vocab)


@register("en5_get_dummies", """
SELECT CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag_A, CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N,
       CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R, CAST(l_linestatus = 'F' AS INTEGER) AS l_linestatus_F,
       CAST(l_linestatus = 'O' AS INTEGER) AS l_linestatus_O, count(*) AS n FROM lineitem GROUP BY ALL""")
def en5(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    d = encode.get_dummies(li, ["l_returnflag", "l_linestatus"])
    return count_by(d, *d.columns)


@register("en8_min_max_scale", """
SELECT l_orderkey, l_linenumber, l_partkey,
       (l_quantity - (SELECT min(l_quantity) FROM lineitem)) / ((SELECT max(l_quantity) FROM lineitem) - (SELECT min(l_quantity) FROM lineitem)) AS q_scaled,
       (l_extendedprice - (SELECT min(l_extendedprice) FROM lineitem)) / ((SELECT max(l_extendedprice) FROM lineitem) - (SELECT min(l_extendedprice) FROM lineitem)) AS p_scaled
FROM lineitem""")
def en8(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                             F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p"))
    out = encode.min_max_scale(li, ["q", "p"], suffix="_scaled")
    return out.drop("q", "p")


@register("en8_robust_scale", """
WITH q AS (SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS qm, quantile_cont(l_quantity, 0.75) AS q3,
                  quantile_cont(l_extendedprice, 0.25) AS p1, quantile_cont(l_extendedprice, 0.5) AS pm, quantile_cont(l_extendedprice, 0.75) AS p3
           FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - qm) / (q3 - q1) AS q_scaled, (l_extendedprice - pm) / (p3 - p1) AS p_scaled FROM lineitem, q""")
def en8_robust(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p"))
    return encode.robust_scale(li, ["q", "p"], suffix="_scaled").drop("q", "p")


# ---------------------------------------------------------------- SP splits

def _alloc_sql(src: str, cls: str, ratio: float) -> str:
    """DuckDB text of the exact stratified allocation used by ``split.allocate``."""
    return f"""
c AS (SELECT {cls} AS cls, count(*) AS cnt FROM {src} GROUP BY 1),
t AS (SELECT sum(cnt) AS n, CAST(floor(sum(cnt) * CAST({ratio} AS DOUBLE)) AS BIGINT) AS k FROM c),
a AS (SELECT cls, cnt, k * cnt / n AS ex, floor(k * cnt / n) AS base, k FROM c, t),
r AS (SELECT *, row_number() OVER (ORDER BY ex - base DESC, cls) AS rr, k - sum(base) OVER () AS rem FROM a),
alloc AS (SELECT cls, CAST(base AS BIGINT) + CASE WHEN rr <= rem THEN 1 ELSE 0 END AS quota FROM r)"""


def _md5(key: str, seed: int = 42) -> str:
    return f"md5('{seed}' || ':' || CAST({key} AS VARCHAR))"


@register("sp1_stratified_split", f"""
WITH {_alloc_sql('orders', 'o_orderstatus', 0.15)},
ranked AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_md5('o_orderkey')}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN alloc ON ranked.o_orderstatus = alloc.cls""")
def sp1(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(o, "o_orderstatus", ["o_orderkey"], 0.15, seed=42)


@register("sp2_stratified_split_labels", f"""
WITH {_alloc_sql('labels', 'quality', 0.15)},
ranked AS (SELECT doc_id, quality, toxic,
                  row_number() OVER (PARTITION BY quality ORDER BY {_md5('doc_id', 7)}, doc_id) AS rn FROM labels)
SELECT doc_id, quality, toxic, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN alloc ON ranked.quality = alloc.cls""")
def sp2(spark, sf):
    return split.stratified_split(table(spark, sf, "labels"), "quality", ["doc_id"], 0.15, seed=7)


def _sp3_sql():
    return f"""
WITH {_alloc_sql('orders', 'o_orderstatus', 0.33)},
c2 AS (SELECT cls, quota AS cnt FROM alloc),
t2 AS (SELECT sum(cnt) AS n, CAST(floor(sum(cnt) * CAST(0.15 AS DOUBLE)) AS BIGINT) AS k FROM c2),
a2 AS (SELECT cls, cnt, k * cnt / n AS ex, floor(k * cnt / n) AS base, k FROM c2, t2),
r2 AS (SELECT *, row_number() OVER (ORDER BY ex - base DESC, cls) AS rr, k - sum(base) OVER () AS rem FROM a2),
alloc2 AS (SELECT cls, CAST(base AS BIGINT) + CASE WHEN rr <= rem THEN 1 ELSE 0 END AS quota FROM r2),
ranked AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_md5('o_orderkey', 3)}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus,
       CASE WHEN rn <= alloc2.quota THEN 'level0_test' WHEN rn <= alloc.quota THEN 'level0_train' ELSE 'level1' END AS fold
FROM ranked JOIN alloc ON ranked.o_orderstatus = alloc.cls JOIN alloc2 ON ranked.o_orderstatus = alloc2.cls"""


@register("sp3_stacking_split", _sp3_sql())
def sp3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stacking_split(o, "o_orderstatus", ["o_orderkey"], 0.33, 0.15, seed=3)


@register("sp4_head_tail_split", """
WITH r AS (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, CASE WHEN rn <= (SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM orders)
                        THEN 'head' ELSE 'tail' END AS split FROM r""")
def sp4(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return split.head_tail_split(o, ["o_orderdate", "o_orderkey"], 0.8).drop("o_orderdate")


@register("sp5_stratified_folds", f"""
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_md5('o_orderkey', 5)}, o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def sp5(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_folds(o, "o_orderstatus", ["o_orderkey"], k=5, seed=5)


@register("sr3_permutation", f"""
SELECT c_custkey, row_number() OVER (ORDER BY {_md5('c_custkey', 11)}, c_custkey) AS position FROM customer""")
def sr3(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    return split.permutation_rank(c, ["c_custkey"], seed=11)


# ---------------------------------------------------------------- RB1 undersampling

@register("rb1_undersample_two_class", f"""
WITH m AS (SELECT min(cnt) AS target FROM (SELECT count(*) AS cnt FROM labels GROUP BY quality)),
r AS (SELECT doc_id, quality, toxic,
             row_number() OVER (PARTITION BY quality ORDER BY {_md5('doc_id')}, doc_id) AS rn FROM labels)
SELECT doc_id, quality, toxic FROM r WHERE rn <= (SELECT target FROM m)""")
def rb1(spark, sf):
    return balance.undersample(table(spark, sf, "labels"), "quality", ["doc_id"], seed=42)


@register("rb1_undersample_three_class", f"""
WITH m AS (SELECT min(cnt) AS target FROM (SELECT count(*) AS cnt FROM orders GROUP BY o_orderstatus)),
r AS (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_md5('o_orderkey')}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus FROM r WHERE o_orderstatus <> 'P' OR rn <= (SELECT target FROM m)""")
def rb1b(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return balance.undersample(o, "o_orderstatus", ["o_orderkey"], cut=["P"], seed=42)
