"""Joins and set operations (JN1, JN2, JN4, JN5, ST1–ST3).

Rows are always matched by key, never by position (the reference's ``concat(axis=1)``
pairs rows by index after a shuffle; here every concatenation is a keyed join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast


def assert_unique(df: DataFrame, keys) -> None:
    """Raise when ``keys`` repeat in ``df`` (one aggregation; stops at the first repeat)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"key {keys} is not unique, e.g. {dup[0].asDict()}")


def lookup(df: DataFrame, dim: DataFrame, key, cols=None, dim_key=None, validate: bool = True,
           max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """JN1 (``Series.map``): left join a dimension by a unique key; no match → NULL.

    The dimension is broadcast only when its row count is proven below
    ``max_broadcast_rows``; a larger one goes through a shuffle join (AQE may still
    turn it into a broadcast at run time).
    """
    dim_key = dim_key or key
    cols = list(cols) if cols is not None else [c for c in dim.columns if c != dim_key]
    d = dim.select(F.col(dim_key).alias("_cf_lookup_key"), *cols)
    if validate:
        assert_unique(d, "_cf_lookup_key")
    d = bounded_broadcast(d, max_broadcast_rows)
    out = df.join(d, df[key] == d["_cf_lookup_key"], "left").drop("_cf_lookup_key")
    return out


def keyed_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
               suffixes=("_x", "_y")) -> DataFrame:
    """JN2 / JN5: join on key columns; other columns present on both sides get pandas
    merge suffixes."""
    on = [on] if isinstance(on, str) else list(on)
    both = (set(left.columns) & set(right.columns)) - set(on)
    lft = left.withColumnsRenamed({c: c + suffixes[0] for c in both})
    rgt = right.withColumnsRenamed({c: c + suffixes[1] for c in both})
    return lft.join(rgt, on=on, how=how)


def join_all(frames, on, how: str = "inner") -> DataFrame:
    """JN5: column concatenation of several keyed frames (fold of keyed joins)."""
    return reduce(lambda a, b: keyed_join(a, b, on, how), frames)


def first_per_key(df: DataFrame, key, order, cols) -> DataFrame:
    """JN4: per key, the values of ``cols`` from the first row in ``order`` (a total
    order).  An aggregation with map-side partial results, so a hot key does not
    gather its rows in one task."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    cols = list(cols)
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*key).agg(picked.alias("_cf_first")).select(*key, *[F.col("_cf_first")[c].alias(c) for c in cols])


def union_all(frames, allow_missing: bool = True) -> DataFrame:
    """ST1: row concatenation by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_values(df: DataFrame, col) -> DataFrame:
    """ST2: distinct values of one column (missing dropped, as ``unique`` after dropna)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def columns_equal(df: DataFrame, a: str, b: str) -> DataFrame:
    """ST3: ``Series.equals``: are two columns identical, missing equal to missing."""
    eq = F.col(a).eqNullSafe(F.col(b))
    return df.agg(F.coalesce(F.bool_and(eq), F.lit(True)).cast("int").alias("equal"),
                  F.sum((~eq).cast("int")).cast("bigint").alias("mismatches"),
                  F.count(F.lit(1)).alias("rows"))
