"""Cleaning operators: projections, coercions, fills and filters (PJ1, PJ2, PJ11, FL1–FL8).

Each filter is a single ``filter`` of bare comparisons: ``filter`` drops a row whose
predicate is NULL, as pandas does, so nothing is wrapped round them and Catalyst pushes
those on raw columns down to the Parquet scan.  The cleaning report (FL7)
counts every step's losses in one aggregation pass instead of one ``count()`` per step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import any_null, col_, nan_to_null, not_in_keep_missing, to_double


def drop_columns(df: DataFrame, cols, ignore_missing: bool = True) -> DataFrame:
    """PJ1: drop columns; the strict form raises on a name that is not there."""
    cols = list(cols)
    if not ignore_missing:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def to_numeric(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    """PJ2: coerce text columns to numbers; bad text and NaN → NULL."""
    return df.withColumns({c: to_double(c).cast(dtype) for c in cols})


def fill_groups(df: DataFrame, fills: dict) -> DataFrame:
    """PJ11: fill missing values by column group, ``{value: [columns]}``.

    Numeric values go to numeric columns and text values to text columns through one
    ``na.fill`` call (which also replaces NaN in float columns, M8); a value whose type
    differs from its column's is cast and coalesced explicitly.
    """
    types = dict(df.dtypes)
    direct, cast = {}, {}
    for value, cols in fills.items():
        for c in cols:
            if c not in types:
                continue
            numeric_col = types[c] not in ("string", "date", "timestamp", "timestamp_ntz", "boolean")
            numeric_val = isinstance(value, (int, float)) and not isinstance(value, bool)
            if (numeric_col and numeric_val) or (types[c] == "string" and isinstance(value, str)):
                direct[c] = value
            else:
                cast[c] = value
    out = df.na.fill(direct) if direct else df
    if cast:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in cast.items()})
    return out


def fill_all(df: DataFrame, number=0, text: str = "0") -> DataFrame:
    """``fillna(0)`` over a whole frame: numbers get ``number``, text gets ``text``
    (two ``na.fill`` calls; NaN counts as missing)."""
    return df.na.fill(number).na.fill(text)


def exclude_values(df: DataFrame, col, values) -> DataFrame:
    """FL1: drop rows whose value is in ``values``; missing values are kept."""
    return df.filter(not_in_keep_missing(col, list(values)))


def as_number(df: DataFrame, c: str) -> Column:
    """The column itself if it is numeric, else its text coerced, so that comparisons with
    a numeric column can be pushed to the scan."""
    return F.col(c) if isinstance(df.schema[c].dataType, T.NumericType) else to_double(c)


def above(df: DataFrame, c: str, value) -> list[Column]:
    """Predicates of ``c > value`` that a NaN does not pass (Spark sorts it above all)."""
    x = as_number(df, c)
    return [x > value] + ([~F.isnan(x)] if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else [])


def filter_all(df: DataFrame, predicates) -> DataFrame:
    """FL2 / FL5: one filter over a list of predicates."""
    preds = list(predicates)
    if not preds:
        return df
    return df.filter(reduce(lambda a, b: a & b, preds))


def all_between(df: DataFrame, cols, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """FL3: every listed column inside the closed range [lo, hi]."""
    return filter_all(df, [as_number(df, c).between(lo, hi) for c in cols])


def require_present(df: DataFrame, cols, absent: str = "IDnull") -> DataFrame:
    """FL4: every required slot holds a player (value differs from the absent marker)."""
    return filter_all(df, [col_(c) != F.lit(absent) for c in cols])


def first_failed_step(predicates) -> Column:
    """Number (1-based) of the first predicate a row fails, 0 when it passes all."""
    expr = None
    for i, p in enumerate(predicates, start=1):
        cond = ~F.coalesce(p, F.lit(False))  # a NULL comparison fails the step
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(0))


def _step_counts(steps) -> list[Column]:
    fs = first_failed_step([p for _, p in steps])
    return [F.count(F.lit(1)).alias("n0"), *[F.sum(F.when(fs == i, 1).otherwise(0)).cast("bigint").alias(f"r{i}") for i in range(1, len(steps) + 1)]]


def cleaning_report(df: DataFrame, steps) -> DataFrame:
    """FL7: rows removed by each step of an ordered filter chain, in one pass.

    ``steps`` is a list of ``(name, predicate)``.  Output columns: ``step_no``,
    ``step``, ``rows_before``, ``rows_removed``, ``rows_after``; a final row
    ``step_no = 0, step = 'total'`` holds the overall loss.
    """
    steps = list(steps)
    return report_rows(df.agg(*_step_counts(steps)), [name for name, _ in steps])


def report_rows(one: DataFrame, names) -> DataFrame:
    """The report from a row of counts ``n0``, ``r1`` ..."""
    rows = []
    n0 = before = F.coalesce("n0", F.lit(0))
    for i, name in enumerate(names, start=1):
        removed = F.coalesce(F.col(f"r{i}"), F.lit(0))
        rows.append(F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                             before.alias("rows_before"), removed.alias("rows_removed"),
                             (before - removed).alias("rows_after")))
        before = before - removed
    rows.append(F.struct(F.lit(0).alias("step_no"), F.lit("total").alias("step"), n0.alias("rows_before"),
                         (n0 - before).alias("rows_removed"), before.alias("rows_after")))
    return one.select(F.inline(F.array(*rows)))


class ObservedSteps:
    """FL7 without a pass of its own: the counts are metrics that Spark gathers while the
    cleaned rows are made.  ``watch`` puts them into a plan, before its filters; when an
    action has run that plan, ``report`` has the counts of all its rows.

    The rows that the first steps remove must reach the counting, so a plan that is watched
    does not push those filters into its scan."""

    def __init__(self):
        self.observation, self.names = Observation(), []

    def watch(self, df: DataFrame, steps) -> DataFrame:
        steps = list(steps)
        self.names = [name for name, _ in steps]
        return df.observe(self.observation, *_step_counts(steps))

    def report(self, spark: SparkSession) -> DataFrame:
        counts = self.observation.get
        fields = ["n0", *[f"r{i}" for i in range(1, len(self.names) + 1)]]
        one = spark.createDataFrame([tuple(counts.get(f) for f in fields)], ", ".join(f"{f} bigint" for f in fields))
        return report_rows(one, self.names)


def count_rows_with_missing(df: DataFrame, cols=None) -> DataFrame:
    """FL8: number of rows with at least one missing value (NaN counts as missing)."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    checks = [nan_to_null(F.col(c)) if types[c] in ("double", "float") else F.col(c) for c in cols]
    return df.agg(F.sum(any_null(checks).cast("int")).cast("bigint").alias("rows_with_missing"),
                  F.count(F.lit(1)).alias("rows"))
