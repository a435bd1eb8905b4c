"""The missing-value contract: operators only ever see NULL.

pandas has one missing marker (NaN); Spark has NULL and NaN, which compare, count and
cast differently.  Every loader and every numeric coercion in the library goes through
these helpers so that NaN never reaches a comparison, a ``count(distinct)`` or a cast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a CSV reader treats as missing (pandas defaults).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN → NULL for a floating column (M1, M7)."""
    c = col_(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def text_token_to_null(c) -> Column:
    """Map the CSV missing tokens to NULL, keep other text as is."""
    c = col_(c)
    return F.when(c.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(c)


def to_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')``: bad text → NULL, NaN → NULL, never raises (M3)."""
    c = col_(c)
    return nan_to_null(c.try_cast("double"))


def fill_int(c, value: int = 0, dtype: str = "int") -> Column:
    """``fillna(v).astype(int)``: coalesce first, then truncate toward zero (M5)."""
    c = col_(c)
    return F.coalesce(nan_to_null(c.cast("double")), F.lit(float(value))).cast(dtype)


def ne_keep_missing(c, value) -> Column:
    """``df[c != v]`` keeps missing rows (M2); both parts can be pushed to a scan."""
    return col_(c).isNull() | (col_(c) != F.lit(value))


def not_in_keep_missing(c, values) -> Column:
    """``~df[c].isin(values)`` keeps missing rows; both parts can be pushed to a scan."""
    return col_(c).isNull() | ~col_(c).isin(*values)


def any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [col_(c).isNull() for c in cols])
