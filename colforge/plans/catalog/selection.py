"""Registered queries for feature selection: FS1–FS3, FS5, FS7–FS10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import select as fsel
from .aggregates import CUMULATIVE_SQL, cumulative
from .common import table

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# One feature frame over the whole lineitem table with a missing-heavy column, a
# single-valued column, an all-missing column and a collinear pair.
_FEATS = {
    "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount",
    "l_tax": "l_tax", "net_price": "l_extendedprice * (1 - l_discount)",
    "late_qty": "CASE WHEN l_linenumber > 2 THEN NULL ELSE l_quantity END",
    "one_value": "CASE WHEN l_linenumber = 1 THEN 1.0 ELSE NULL END",
    "nothing": "CAST(NULL AS DOUBLE)",
    "qty_twice": "l_quantity * 2 + l_tax",
}
_MISSING_T, _CORR_T = 0.5, 0.9


def features(spark, sf):
    return table(spark, sf, "lineitem").select(*[F.expr(e).alias(k) for k, e in _FEATS.items()])


def _missing_sql():
    return " UNION ALL ".join(
        f"SELECT '{k}' AS feature, avg(CASE WHEN {e} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_fraction FROM lineitem"
        for k, e in _FEATS.items())


def _unique_sql():
    return " UNION ALL ".join(f"SELECT '{k}' AS feature, count(DISTINCT {e}) AS nunique FROM lineitem"
                              for k, e in _FEATS.items())


def _corr_sql():
    names = list(_FEATS)
    parts = []
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            ea, eb = _FEATS[a], _FEATS[b]
            parts.append(
                f"SELECT '{b}' AS drop_feature, '{a}' AS corr_feature, "
                f"CASE WHEN min(CASE WHEN ({eb}) IS NOT NULL THEN {ea} END) = max(CASE WHEN ({eb}) IS NOT NULL THEN {ea} END) "
                f"OR min(CASE WHEN ({ea}) IS NOT NULL THEN {eb} END) = max(CASE WHEN ({ea}) IS NOT NULL THEN {eb} END) "
                f"THEN NULL ELSE corr({ea}, {eb}) END AS corr_value FROM lineitem")
    return " UNION ALL ".join(parts)


FS1_SQL = f"SELECT * FROM ({_missing_sql()}) WHERE missing_fraction > {_MISSING_T}"
FS2_SQL = f"SELECT * FROM ({_unique_sql()}) WHERE nunique = 1"
FS3_SQL = f"SELECT drop_feature, corr_feature, round(corr_value, 6) AS corr_value FROM ({_corr_sql()}) WHERE abs(corr_value) > {_CORR_T}"


def _selector(spark, sf):
    s = fsel.FeatureSelector(features(spark, sf))
    s.identify_missing(_MISSING_T)
    s.identify_single_unique()
    s.identify_collinear(_CORR_T)
    return s


@register("fs1_identify_missing", FS1_SQL)
def fs1(spark, sf):
    stats = fsel.FeatureSelector(features(spark, sf)).identify_missing(_MISSING_T)
    return stats


@register("fs2_identify_single_unique", FS2_SQL)
def fs2(spark, sf):
    return fsel.FeatureSelector(features(spark, sf)).identify_single_unique()


@register("fs3_identify_collinear", FS3_SQL)
def fs3(spark, sf):
    rec = fsel.FeatureSelector(features(spark, sf)).identify_collinear(_CORR_T)
    return rec.withColumn("corr_value", F.round("corr_value", 6))


@register("fs5_identify_low_importance", f"SELECT * FROM ({CUMULATIVE_SQL}) WHERE cumulative_importance > 0.8")
def fs5(spark, sf):
    return fsel.low_importance(cumulative(spark, sf), 0.8)


@register("fs7_check_removal", f"""
SELECT feature FROM ({FS1_SQL}) UNION SELECT feature FROM ({FS2_SQL}) UNION SELECT drop_feature FROM ({FS3_SQL})""")
def fs7(spark, sf):
    names = _selector(spark, sf).check_removal()
    return spark.createDataFrame([(n,) for n in names], "feature string")


def _fs8_sql():
    keep = [k for k in _FEATS if k not in ("late_qty", "one_value", "nothing", "net_price", "qty_twice")]
    return "SELECT " + ", ".join(f"{_FEATS[k]} AS {k}" for k in keep) + " FROM lineitem"


@register("fs8_remove", _fs8_sql())
def fs8(spark, sf):
    return _selector(spark, sf).remove("all")


@register("fs9_features_needed", f"SELECT min(rank) AS features_needed FROM ({CUMULATIVE_SQL}) WHERE cumulative_importance > 0.9")
def fs9(spark, sf):
    return fsel.features_needed(cumulative(spark, sf), 0.9)


@register("fs10_collinear_submatrix", f"""
WITH pairs AS ({FS3_SQL}),
allc AS ({_corr_sql().replace('drop_feature', 'f2').replace('corr_feature', 'f1')}),
sym AS (SELECT f1, f2, corr_value FROM allc UNION ALL SELECT f2, f1, corr_value FROM allc),
r AS (SELECT DISTINCT corr_feature AS f FROM pairs), c AS (SELECT DISTINCT drop_feature AS f FROM pairs)
SELECT sym.f1 AS row_feature, sym.f2 AS col_feature, round(sym.corr_value, 6) AS corr
FROM sym JOIN r ON sym.f1 = r.f JOIN c ON sym.f2 = c.f
UNION ALL SELECT r.f, c.f, 1.0 FROM r JOIN c ON r.f = c.f""")
def fs10(spark, sf):
    s = fsel.FeatureSelector(features(spark, sf))
    s.identify_collinear(_CORR_T)
    return s.collinear_matrix().withColumn("corr", F.round("corr", 6))
