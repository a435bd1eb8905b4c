"""Column arithmetic, coercions and value replacement (PJ2–PJ17) as expressions.

All are narrow, codegen-friendly expressions: they compose into one projection and
never leave the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import col_, to_double

IDNULL = "IDnull"

# The provider's five match-winner codes and their flag-column suffixes.
WINNER_CODES = (("1", "1"), ("2", "2"), ("N", "N"), ("1 N", "1N"), ("N 2", "N2"))


def to_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """PJ3: parse text to DATE; a bad value gives NULL."""
    return F.try_to_date(col_(c).cast("string"), fmt)


def sum_pair(a, b) -> Column:
    """PJ5 ``totgoal``: a + b."""
    return to_double(a) + to_double(b)


def diff_pair(a, b) -> Column:
    """PJ5 / PJ6: a − b."""
    return to_double(a) - to_double(b)


def per_unit(c, unit) -> Column:
    """PJ7: c / unit without ANSI division errors (unit 0 → NULL)."""
    return F.try_divide(to_double(c), to_double(unit))


def indicator_flags(c, codes=WINNER_CODES, prefix: str | None = None) -> dict[str, Column]:
    """PJ8: one 0/1 column per code; missing → 0."""
    name = prefix if prefix is not None else (c if isinstance(c, str) else "flag")
    x = col_(c)
    return {f"{name}_{suffix}": F.coalesce((x == F.lit(code)).cast("int"), F.lit(0))
            for code, suffix in codes}


def shift_negative(c, offset: float = 4.0) -> Column:
    """PJ9: x < 0 → x + offset, otherwise (and missing) 0."""
    x = to_double(c)
    return F.when(x < 0, x + F.lit(offset)).otherwise(F.lit(0.0))


def replace_idnull(c) -> Column:
    """PJ12: '0', 0 and missing ids → 'IDnull'."""
    x = col_(c).cast("string")
    return F.when(x.isNull() | x.isin("0", "0.0"), F.lit(IDNULL)).otherwise(x)


def zero_to_null(c) -> Column:
    """PJ12: 0.0 → missing."""
    x = to_double(c)
    return F.when(x == 0, F.lit(None).cast("double")).otherwise(x)


def null_to_zero(c) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def strip_id(c, prefix: str = "ID", dtype: str = "bigint") -> Column:
    """PJ13: remove the id prefix and cast; bad text → NULL."""
    return F.replace(col_(c).cast("string"), F.lit(prefix), F.lit("")).try_cast(dtype)


def row_mean_nonzero(cols) -> Column:
    """PJ14: mean over a slot group ignoring zeros and missing; all missing → NULL.

    Plain arithmetic (no arrays) keeps it inside whole-stage codegen.
    """
    vals = [to_double(c) for c in cols]
    present = [F.when(v != 0, v) for v in vals]
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in present])
    count = reduce(lambda a, b: a + b, [p.isNotNull().cast("int") for p in present])
    return F.try_divide(total, F.when(count > 0, count.cast("double")))


def local_time_text(ts, tz: str = "Europe/Paris", fmt: str = "yyyy-MM-dd HH:mm:ss",
                    source_tz: str = "UTC") -> Column:
    """PJ15: a wall-clock timestamp of ``source_tz`` rendered as text in ``tz``.

    ``convert_timezone`` works on TIMESTAMP_NTZ, so the result does not depend on the
    session time zone."""
    local = F.convert_timezone(F.lit(source_tz), F.lit(tz), col_(ts).cast("timestamp_ntz"))
    return F.date_format(local, fmt)


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a wall-clock UTC timestamp (seconds
    floored), independent of the session time zone."""
    t = col_(ts).cast("timestamp_ntz")
    return (F.unix_date(F.to_date(t)).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
            + F.floor(F.second(t))).cast("bigint")


def minutes_between(later, earlier) -> Column:
    """PJ16: whole seconds between two wall-clock instants of one zone, divided by 60."""
    return (epoch_seconds(later) - epoch_seconds(earlier)).cast("double") / F.lit(60.0)


def round_half_even(c, scale: int = 0) -> Column:
    """PJ17: ``np.around``: half to even."""
    return F.bround(to_double(c), scale)


def coalesce_sibling(c, sibling) -> Column:
    """PJ10: fill a column from a sibling column."""
    return F.coalesce(to_double(c), to_double(sibling))


def all_between(cols, lo: float = 0.0, hi: float = 1.0) -> Column:
    """FL3: every column inside the closed range (missing fails, as in pandas)."""
    return reduce(lambda a, b: a & b, [F.coalesce(to_double(c).between(lo, hi), F.lit(False)) for c in cols])
