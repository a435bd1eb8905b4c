"""Rating bands (BD1, BD2) as single CASE expressions generated from edge tables.

Inputs are expected NULL-clean (see ``missing``); a NULL input falls through to the
``otherwise`` branch exactly as a pandas NaN fails every comparison.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import to_double

# Half-point band centres and unit band centres.
HALF_BAND_CENTRES = (3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 9.5)
UNIT_BAND_CENTRES = (3, 4, 5, 6, 7, 8, 9)


def band_half(c) -> Column:
    """BD1: 3 for 3 <= x < 3.25; centre c for c-0.25 < x < c+0.25 (c = 3.5 … 9.5);
    10 for x > 9.75; otherwise 0.  The edges 3.25, 3.75, …, 9.75 are open on both
    sides, so they band to 0.  Result DOUBLE."""
    x = to_double(c)
    expr = F.when((x >= 3.0) & (x < 3.25), F.lit(3.0))
    for centre in HALF_BAND_CENTRES:
        expr = expr.when((x > centre - 0.25) & (x < centre + 0.25), F.lit(float(centre)))
    return expr.when(x > 9.75, F.lit(10.0)).otherwise(F.lit(0.0))


def band_unit(c) -> Column:
    """BD2: k for k-0.5 < x <= k+0.5 (k = 3 … 9), 10 for x > 9.5, otherwise 0.  INT."""
    x = to_double(c)
    expr = None
    for k in UNIT_BAND_CENTRES:
        cond = (x > k - 0.5) & (x <= k + 0.5)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.when(x > 9.5, F.lit(10)).otherwise(F.lit(0))


def band_columns(df, cols, band=band_unit, suffix: str | None = None):
    """BD3: band a list of columns in one projection (in place when ``suffix`` is None)."""
    cols = list(cols)
    if suffix is None:
        return df.withColumns({c: band(c) for c in cols})
    return df.withColumns({f"{c}{suffix}": band(c) for c in cols})
