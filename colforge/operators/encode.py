"""Encoding and scaling (EN1–EN5, EN8).

Label encoding is a persisted dictionary table ``(feature, value, code)``: one fit covers
every column (one unpivot, one distinct, one exact ranking), and decoding is the same
join in reverse, so each column keeps its own classes (the reference kept only the last
column's).  Codes follow the sorted distinct values; numeric columns sort numerically.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import nan_to_null
from ..session import row_count_at_most
from .ranking import exact_row_number
from .selection import exact_quantiles

DICT_SCHEMA = "feature string, value string, code bigint"
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

#: Bytes of all dictionaries that one projection looks up by itself; they are part of the plan.
MAX_LOOKUP_BYTES = 1024 * 1024


def _value_text(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    x = F.col(c)
    if t in ("double", "float"):
        x = nan_to_null(x)
        x = F.when(x == 0, F.lit(0.0)).otherwise(x)
    return x.cast("string")


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def fit_dictionary(df: DataFrame, cols, max_local: int = 20_000) -> DataFrame:
    """EN1 / EN2: dictionary ``(feature, value, code)`` with code = rank of the sorted
    distinct non-missing value, 0-based, per column.

    The distinct values are found in one aggregation.  When there are at most
    ``max_local`` of them (read with a bounded ``limit``), they are ranked on the driver;
    otherwise the ranking is the distributed ``exact_row_number``.
    """
    cols = list(cols)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], DICT_SCHEMA)
    items = []
    for c in cols:
        num = nan_to_null(F.col(c).cast("double")) if _is_numeric(df, c) else F.lit(None).cast("double")
        items.append(F.struct(F.lit(c).alias("feature"), _value_text(df, c).alias("value"), num.alias("_num")))
    long = df.select(F.inline(F.array(*items))).where(F.col("value").isNotNull())
    distinct = long.groupBy("feature", "value").agg(F.first("_num").alias("_num"))
    few = distinct.limit(max_local + 1).collect()
    if len(few) <= max_local:
        rows, by_col = [], {}
        for r in few:
            by_col.setdefault(r["feature"], []).append((r["_num"] is None, r["_num"] or 0.0, r["value"]))
        for c, vals in by_col.items():
            rows += [(c, v[2], i) for i, v in enumerate(sorted(vals))]
        return spark.createDataFrame(rows, DICT_SCHEMA)
    ranked = exact_row_number(distinct, ["feature"], [F.col("_num").asc_nulls_last(), F.col("value")], name="_rn",
                              max_groups=max(len(cols), 1))
    return ranked.select("feature", "value", (F.col("_rn") - 1).alias("code"))


def _sides(dictionary: DataFrame, cols, types: dict, max_broadcast_rows: int, max_lookup_rows: int):
    """How the entries of each column are brought to the rows.  One small aggregation gives
    the entries of each column and the width of the longest.  The smallest dictionaries, up
    to ``max_lookup_rows`` entries and ``MAX_LOOKUP_BYTES`` together, come to the driver and
    are looked up in the projection; each of the others is the right side of a join,
    broadcast where its size is proven."""
    used = dictionary.where(F.col("feature").isin(list(cols)))
    size = {r["feature"]: (r["n"], r["w"] or 0) for r in
            used.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("value")).alias("w")).collect()}
    small, left, room = [], max_lookup_rows, MAX_LOOKUP_BYTES
    for c in sorted(cols, key=lambda c: size.get(c, (0, 0))):
        n, w = size.get(c, (0, 0))
        if n > left or n * (w + 32) > room:
            break
        small.append(c)
        left, room = left - n, room - n * (w + 32)
    joined = {}
    for c in (c for c in cols if c not in small):
        d = used.where(F.col("feature") == c).select(F.col("value").alias("_cf_v"), F.col("code").alias("_cf_code"))
        n, w = size.get(c, (0, 0))
        joined[c] = F.broadcast(d) if n <= max_broadcast_rows and n * (w + 64) <= MAX_BROADCAST_BYTES else d
    entries: dict = {c: [] for c in small}
    if small:
        key = F.lit(None).cast("bigint")  # NULL for a value that the column's type cannot hold
        for t in sorted({types[c] for c in small}):
            typed = F.col("value").try_cast(t)
            key = F.when(F.col("feature").isin([c for c in small if types[c] == t]), F.when(typed.isNotNull(), F.xxhash64(typed))).otherwise(key)
        for r in used.where(F.col("feature").isin(small)).select("feature", "value", "code", key.alias("h")).collect():
            if r["h"] is not None:
                entries[r["feature"]].append((r["h"], r["value"], r["code"]))
    return entries, joined


def _constant(value, kind: str) -> Column:
    """A literal of text values that Catalyst folds, cast to ``kind``: one call to the JVM
    whatever its length."""
    text = "array<struct<k:array<string>,c:array<bigint>>>" if kind.startswith("array<struct") else "array<string>"
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), text).cast(kind)


def _lookup(x: Column, entries: list, kind: str) -> Column:
    """The code of ``x``: its hash gives a bucket of about one entry, held by value.  NULL if
    there is none.  ``entries`` are (hash, value as text, code)."""
    n = max(1, len(entries))
    buckets: list[dict] = [{"k": [], "c": []} for _ in range(n)]
    for h, value, code in entries:
        at = buckets[h % n]
        at["k"].append(value)
        at["c"].append(code)
    table = _constant(buckets, f"array<struct<k:array<{kind}>,c:array<bigint>>>")
    bucket = F.get(table, F.pmod(F.xxhash64(x), F.lit(n)).cast("int"))
    return F.get(bucket["c"], (F.array_position(bucket["k"], x) - 1).cast("int"))


#: Types that are looked up as they are; values of other types are looked up as text.
_OWN_KEY = ("tinyint", "smallint", "int", "bigint", "double")


def _key(df: DataFrame, c: str) -> tuple[str, Column]:
    t = dict(df.dtypes)[c]
    if t == "float":  # the dictionary holds it as the double of the same value
        t = "double"
    if t not in _OWN_KEY:
        return "string", _value_text(df, c)
    if t != "double":
        return t, F.col(c)
    x = nan_to_null(F.col(c).cast("double"))
    return t, F.when(x == 0, F.lit(0.0)).otherwise(x)


def encode_columns(df: DataFrame, dictionary: DataFrame, cols, unseen: int | None = -1, suffix: str = "",
                   max_broadcast_rows: int = 1_000_000, max_lookup_rows: int = 20_000) -> DataFrame:
    """EN1: replace each column by its code (``suffix`` keeps the original).  A value
    missing from the dictionary gets ``unseen`` (NULL when None); missing stays NULL.

    All small dictionaries are looked up in one projection, without a join.  A column whose
    dictionary is too big for that is joined with its entries, broadcast where their size
    is proven."""
    cols = list(cols)
    keys = {c: _key(df, c) for c in cols}
    entries, joined = _sides(dictionary, cols, {c: t for c, (t, _) in keys.items()}, max_broadcast_rows, max_lookup_rows)

    def coded(c: str, found: Column) -> Column:
        return F.when(F.col(c).isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce(found, F.lit(unseen).cast("bigint")))

    out = df
    for c, d in joined.items():
        out = out.join(d, _value_text(out, c) == F.col("_cf_v"), "left")
        out = out.withColumn(f"{c}{suffix}", coded(c, F.col("_cf_code"))).drop("_cf_v", "_cf_code")
    return out.withColumns({f"{c}{suffix}": coded(c, _lookup(keys[c][1], entries[c], keys[c][0])) for c in cols if c in entries})


def decode_columns(df: DataFrame, dictionary: DataFrame, cols, suffix: str = "", max_broadcast_rows: int = 1_000_000,
                   max_lookup_rows: int = 20_000) -> DataFrame:
    """EN3: codes back to their values (text) through the same dictionary: the place in an
    array where the codes are 0 to n - 1 and the dictionary is small, else a join."""
    cols = list(cols)
    entries, joined = _sides(dictionary, cols, {c: "string" for c in cols}, max_broadcast_rows, max_lookup_rows)
    out, found = df, {}
    for c, rows in entries.items():
        values = {code: value for _, value, code in rows}
        if sorted(values) != list(range(len(rows))):
            d = dictionary.where(F.col("feature") == c).select(F.col("value").alias("_cf_v"), F.col("code").alias("_cf_code"))
            joined[c] = F.broadcast(d)  # at most max_lookup_rows entries
            continue
        code = F.col(c)
        at = F.when((code >= 0) & (code < len(rows)) & (code == F.floor(code)), code).cast("int")
        found[f"{c}{suffix}"] = F.get(_constant([values[k] for k in range(len(rows))], "array<string>"), at)
    for c, d in joined.items():
        out = out.join(d, F.col(c) == F.col("_cf_code"), "left")
        out = out.withColumn(f"{c}{suffix}", F.col("_cf_v")).drop("_cf_v", "_cf_code")
    return out.withColumns(found)


def save_dictionary(dictionary: DataFrame, path: str) -> None:
    dictionary.write.mode("overwrite").parquet(path)


def load_dictionary(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def vocabulary(df: DataFrame, col: str, max_values: int = 10_000) -> list:
    """Sorted distinct non-missing values of one column, collected behind a size check."""
    d = df.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
    if not row_count_at_most(d, max_values):
        raise ValueError(f"{col} has more than {max_values} distinct values; use the dictionary encoder")
    return sorted(r[0] for r in d.collect())


def one_hot_flags(df: DataFrame, col: str, values, prefix: str | None = None, drop: bool = True) -> DataFrame:
    """EN4 / EN5: one 0/1 column ``<col>_<value>`` per vocabulary value; a missing or
    unknown value gives all zeros."""
    prefix = prefix or col
    x = F.col(col)
    flags = {f"{prefix}_{v}": F.coalesce((x == F.lit(v)).cast("int"), F.lit(0)) for v in values}
    out = df.withColumns(flags)
    return out.drop(col) if drop else out


def get_dummies(df: DataFrame, cols, max_values: int = 10_000) -> DataFrame:
    """EN5: ``pd.get_dummies`` over text columns, vocabulary from the data itself."""
    out = df
    for c in cols:
        out = one_hot_flags(out, c, vocabulary(df, c, max_values))
    return out


def one_hot_pipeline_stages(cols, handle_invalid: str = "keep"):
    """EN4 / EN6 in Spark ML form: StringIndexer(keep) + OneHotEncoder(dropLast) per
    column; an unknown value becomes the all-zero vector."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid=handle_invalid,
                         stringOrderType="alphabetAsc") for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols], dropLast=True)
    return idx + [ohe]


def min_max_scale(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """EN8: (x − min) / (max − min) per column from one aggregation; constant → 0."""
    cols = list(cols)
    stats = df.agg(*[F.min(nan_to_null(F.col(c).cast("double"))).alias(f"lo{i}") for i, c in enumerate(cols)],
                   *[F.max(nan_to_null(F.col(c).cast("double"))).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        lo, hi = stats[f"lo{i}"], stats[f"hi{i}"]
        rng = (hi - lo) if (lo is not None and hi is not None and hi > lo) else None
        x = nan_to_null(F.col(c).cast("double"))
        out[f"{c}{suffix}"] = (x - F.lit(lo)) / F.lit(rng) if rng else F.when(x.isNotNull(), F.lit(0.0))
    return df.withColumns(out)


def standard_scale(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """EN8: (x − mean) / population std per column; constant → 0."""
    cols = list(cols)
    stats = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(nan_to_null(F.col(c).cast("double"))).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        x = nan_to_null(F.col(c).cast("double"))
        out[f"{c}{suffix}"] = (x - F.lit(m)) / F.lit(s) if s else F.when(x.isNotNull(), F.lit(0.0))
    return df.withColumns(out)


def robust_scale(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """EN8: (x − median) / IQR per column, from exact quartiles found by counting (no sort,
    no column in one task); an IQR of 0 only centres."""
    out = {}
    for c, (q1, med, q3) in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).items():
        x = nan_to_null(F.col(c).cast("double"))
        iqr = q3 - q1 if q1 is not None else None
        out[f"{c}{suffix}"] = (x - F.lit(med)) / F.lit(iqr) if iqr else (x - F.lit(med or 0.0))
    return df.withColumns(out)
