"""Registered queries for aggregates, windows, sorting, histograms and evaluation:
AG, WN1, SR1, SR2, HG, EV."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import evaluate as ev
from ...operators import profile as pf
from .common import table

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


@register("ag1_group_mean", """
SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id), 6) AS value_mean FROM events""")
def ag1(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    out = pf.group_mean(e, "user_id", "value", "value_mean")
    return out.select("event_id", "user_id", F.round("value_mean", 6).alias("value_mean"))


@register("ag2_class_distribution", """
SELECT event_type, count(*) AS count, count(*) / sum(count(*)) OVER () AS ratio FROM events GROUP BY event_type""")
def ag2(spark, sf):
    return pf.class_distribution(table(spark, sf, "events"), "event_type")


@register("ag3_class_weights", """
SELECT event_type, count(*) AS count, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
FROM events GROUP BY event_type""")
def ag3(spark, sf):
    return pf.class_weights(table(spark, sf, "events"), "event_type")


@register("ag3_class_weights_labels", """
SELECT quality, count(*) AS count, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
FROM labels GROUP BY quality""")
def ag3b(spark, sf):
    return pf.class_weights(table(spark, sf, "labels"), "quality")


_AG4 = {"tax": "nullif(l_tax, 0)", "discount": "nullif(l_discount, 0)",
        "late_qty": "CASE WHEN l_linenumber > 3 THEN NULL ELSE l_quantity END", "price": "l_extendedprice",
        "flag": "nullif(l_returnflag, 'R')"}


def _ag4_frame(spark, sf):
    return table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in _AG4.items()])


@register("ag4_missing_fraction", " UNION ALL ".join(
    f"SELECT '{k}' AS feature, avg(CASE WHEN {e} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_fraction FROM lineitem"
    for k, e in _AG4.items()))
def ag4(spark, sf):
    return pf.missing_fraction(_ag4_frame(spark, sf))


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("ag5_distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS nunique FROM orders" for c in _ORDER_COLS))
def ag5(spark, sf):
    return pf.distinct_counts(table(spark, sf, "orders"))


_CORR = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount",
         "l_tax": "l_tax", "net_price": "l_extendedprice * (1 - l_discount)"}


def _corr_sql():
    names = list(_CORR)
    parts = []
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            parts.append(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({_CORR[a]}, {_CORR[b]}), 6) AS corr "
                         f"FROM lineitem")
    return " UNION ALL ".join(parts)


@register("ag6_pairwise_corr", _corr_sql())
def ag6(spark, sf):
    li = table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in _CORR.items()])
    return pf.pairwise_corr(li, list(_CORR)).withColumn("corr", F.round("corr", 6))


BRAND_IMPORTANCE_SQL = """
SELECT p_brand AS feature, CAST(sum(l_quantity) AS DOUBLE) AS importance
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""


def brand_importance(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).groupBy(F.col("p_brand").alias("feature")).agg(
        F.sum("l_quantity").cast("double").alias("importance"))


CUMULATIVE_SQL = f"""
WITH imp AS ({BRAND_IMPORTANCE_SQL}),
n AS (SELECT feature, importance, importance / sum(importance) OVER () AS normalized_importance FROM imp)
SELECT feature, importance, round(normalized_importance, 9) AS normalized_importance,
       round(sum(normalized_importance) OVER (ORDER BY importance DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9)
         AS cumulative_importance,
       row_number() OVER (ORDER BY importance DESC, feature) AS rank
FROM n"""


def cumulative(spark, sf):
    out = pf.cumulative_share(brand_importance(spark, sf))
    return out.withColumns({"normalized_importance": F.round("normalized_importance", 9),
                            "cumulative_importance": F.round("cumulative_importance", 9),
                            "rank": F.col("rank").cast("bigint")})


@register("wn1_cumulative_share", CUMULATIVE_SQL)
def wn1(spark, sf):
    return cumulative(spark, sf)


@register("sr1_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sr1(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@register("sr2_top_n", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def sr2(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return c.orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)


@register("hg1_unit_histogram", """
SELECT CAST(least(floor(l_discount * 10 * 10) + 1, 10) AS INTEGER) AS bin, count(*) AS count,
       (least(floor(l_discount * 10 * 10) + 1, 10) - 1) / 10.0 AS bin_lo, least(floor(l_discount * 10 * 10) + 1, 10) / 10.0 AS bin_hi
FROM lineitem GROUP BY ALL""")
def hg1(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("x"))
    return pf.unit_histogram(li, "x", 10)


@register("hg2_range_histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 10 AS w FROM orders),
x AS (SELECT CAST(least(floor((o_totalprice - lo) / w) + 1, 10) AS INTEGER) AS bin, lo, w FROM orders, b)
SELECT bin, count(*) AS count, lo + (bin - 1) * w AS bin_lo, lo + bin * w AS bin_hi FROM x GROUP BY bin, lo, w""")
def hg2(spark, sf):
    return pf.range_histogram(table(spark, sf, "orders"), "o_totalprice", 10)


# ---------------------------------------------------------------- EV evaluation

PRED_SQL = ("SELECT l.doc_id, l.quality AS y, CAST(d.n_chars > 1000 AS INTEGER) AS p "
            "FROM labels l JOIN documents d ON l.doc_id = d.doc_id")


def predictions(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("p"))
    return lab.join(docs, "doc_id")


@register("ev1_accuracy", f"""
WITH t AS ({PRED_SQL}) SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS rows FROM t""")
def ev1(spark, sf):
    return ev.accuracy(predictions(spark, sf), "y", "p")


_PER_CLASS_SQL = f"""
t AS ({PRED_SQL}),
c AS (SELECT y, p, count(*) AS n FROM t GROUP BY y, p),
labs AS (SELECT y AS label FROM c UNION SELECT p FROM c),
s AS (SELECT labs.label,
             coalesce((SELECT sum(n) FROM c WHERE c.y = labs.label), 0) AS support,
             coalesce((SELECT sum(n) FROM c WHERE c.p = labs.label), 0) AS predicted,
             coalesce((SELECT sum(n) FROM c WHERE c.y = labs.label AND c.p = labs.label), 0) AS tp FROM labs),
m AS (SELECT label, support,
             CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
             CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM s),
f AS (SELECT label, precision, recall,
             CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
             CAST(support AS BIGINT) AS support FROM m)"""


@register("ev2_classification_report", f"""
WITH {_PER_CLASS_SQL}
SELECT CAST(label AS VARCHAR) AS label, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
       CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
       round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
       CAST(sum(support) AS BIGINT) FROM f""")
def ev2(spark, sf):
    rep = ev.classification_report(predictions(spark, sf), "y", "p")
    return rep.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


@register("ev3_macro_scores", f"""
WITH {_PER_CLASS_SQL}
SELECT round(avg(precision), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro,
       round(avg(f1), 9) AS f1_macro FROM f""")
def ev3(spark, sf):
    m = ev.macro_scores(predictions(spark, sf), "y", "p")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@register("ev4_confusion_matrix", f"""
WITH t AS ({PRED_SQL})
SELECT y, CAST(sum(CASE WHEN p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS p_0,
       CAST(sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS p_1 FROM t GROUP BY y""")
def ev4(spark, sf):
    return ev.confusion_matrix(predictions(spark, sf), "y", "p")


@register("ev6_actual_vs_predicted", f"WITH t AS ({PRED_SQL}) SELECT doc_id, y AS actual, p AS predicted FROM t")
def ev6(spark, sf):
    return ev.actual_vs_predicted(predictions(spark, sf), "doc_id", "y", "p")
