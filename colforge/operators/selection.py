"""Order statistics without sorting (SP4, EN8).

The row at a given rank is found by counting.  A small sample of the keys that are still
open gives two pivots on either side of the rank; one aggregation counts the rows below,
at and between them, which says exactly between which pivots the rank lies; only the keys
between these are looked at further.  With a sample of m keys a pass leaves about
``4 / sqrt(m)`` of the rows open, so a few passes are enough for any table, and a pass
shuffles one row of counts per task.  When few rows are left, their distinct keys are
counted and read.  The sample only chooses the pivots; every number is an exact count.

Keys may be of any type that Spark orders, also structs of several columns: nulls first,
NaN last.  Many targets (the quartiles of many columns) share their passes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys sampled for the pivots of one target in one pass.
SAMPLE_KEYS = 2_000

#: A target with at most so many open rows is finished by reading their distinct keys.
READ_KEYS = 5_000


@dataclass
class Target:
    """The row of rank ``rank`` (from 1) by ``key`` among the rows whose key is not null."""

    key: Column
    rank: int
    rows: int  # open rows
    low: tuple | None = None  # open keys are above this one ...
    high: tuple | None = None  # ... and below this one
    below: int = 0  # rows below the open ones
    value: object = None
    equal: int = 0  # rows with the value found
    done: bool = field(default=False)


def literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])
    return F.lit(value).cast(kind)


def _open(t: Target, kind: T.DataType) -> Column:
    cond = t.key.isNotNull()
    if t.low is not None:
        cond &= t.key > literal(t.low[0], kind)
    if t.high is not None:
        cond &= t.key < literal(t.high[0], kind)
    return cond


def _keys_of(df: DataFrame, targets: list[tuple[int, Target]], kind: T.DataType, keep) -> DataFrame:
    """``(t, k)``: the open keys of each target; ``keep(i, target)`` is a further condition."""
    cells = F.array(*[F.when(_open(t, kind) & keep(i, t), F.struct(F.lit(i).alias("t"), t.key.alias("k"))) for i, t in targets])
    return df.select(F.inline(F.filter(cells, lambda c: c.isNotNull())))


def rows_at_ranks(df: DataFrame, targets: list[Target], seed: int = 1) -> list[Target]:
    """Find ``value`` for every target, with ``below`` and ``equal``: the numbers of rows
    with smaller keys and with this key.  All keys have one type."""
    if not targets:
        return targets
    kind = df.select(targets[0].key.alias("k")).schema["k"].dataType
    passes = 0
    while True:
        few = [(i, t) for i, t in enumerate(targets) if not t.done and t.rows <= READ_KEYS]
        if few:
            found: dict = {}
            for r in _keys_of(df, few, kind, lambda i, t: F.lit(True)).groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).orderBy("t", "k").collect():
                found.setdefault(r["t"], []).append((r["k"], r["n"]))
            for i, t in few:
                for k, n in found.get(i, []):
                    if t.rank <= t.below + n:
                        t.value, t.equal = k, n
                        break
                    t.below += n
                t.done = True
        left = [(i, t) for i, t in enumerate(targets) if not t.done]
        if not left:
            return targets
        passes += 1
        rate = {i: min(1.0, SAMPLE_KEYS / t.rows) for i, t in left}
        drawn = _keys_of(df, left, kind, lambda i, t: F.rand(seed + 1000 * passes + i) < rate[i])
        sample: dict = {}
        # Four times what is expected is out of reach; were it cut, the pivots would be worse, not the result.
        for r in drawn.limit(4 * SAMPLE_KEYS * len(left)).orderBy("t", "k").collect():
            sample.setdefault(r["t"], []).append(r["k"])
        aggs, used = [], []
        for i, t in left:
            s = sample.get(i)
            if not s:  # nothing drawn; another seed next time
                continue
            middle, wide = (t.rank - t.below) / t.rows * len(s), 2 * len(s) ** 0.5
            lo, hi = s[max(0, int(middle - wide))], s[min(len(s) - 1, int(middle + wide))]
            a, b, inside = literal(lo, kind), literal(hi, kind), _open(t, kind)
            used.append((i, t, lo, hi))
            aggs += [F.count_if(inside & c).alias(f"{n}{i}") for n, c in
                     (("a", t.key < a), ("b", t.key.eqNullSafe(a)), ("c", (t.key > a) & (t.key < b)), ("d", (t.key > a) & t.key.eqNullSafe(b)))]
        counts = df.agg(*aggs).first() if aggs else None
        for i, t, lo, hi in used:
            a, b, c, d = (counts[f"{n}{i}"] for n in "abcd")
            at = t.rank - t.below
            if at <= a:
                t.high, t.rows = (lo,), a
            elif at <= a + b:
                t.below, t.value, t.equal, t.done = t.below + a, lo, b, True
            elif at <= a + b + c:
                t.below, t.low, t.high, t.rows = t.below + a + b, (lo,), (hi,), c
            elif at <= a + b + c + d:
                t.below, t.value, t.equal, t.done = t.below + a + b + c, hi, d, True
            else:
                t.below, t.low, t.rows = t.below + a + b + c + d, (hi,), t.rows - a - b - c - d


def order_key(df: DataFrame, cols) -> Column:
    """One key for an order by several columns.  Times are taken as microseconds, so that no
    time zone comes between reading a key and comparing with it."""
    out = []
    for i, c in enumerate(cols):
        kind = df.schema[c].dataType
        x = F.col(c)
        out.append((F.unix_micros(x) if isinstance(kind, T.TimestampType) else x).alias(f"k{i}"))
    return F.struct(*out)


def exact_quantiles(df: DataFrame, cols, probabilities) -> dict[str, list[float | None]]:
    """Quantiles of the non-missing numbers of each column, between two rows by linear
    interpolation (as numpy and SQL's ``percentile_cont``); NULL for a column without any."""
    cols, probabilities = list(cols), list(probabilities)
    x = {}
    for c in cols:
        v = F.col(c).cast("double")
        x[c] = F.when(~F.isnan(v), F.when(v == 0, F.lit(0.0)).otherwise(v))
    counts = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    targets: dict = {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        for p in probabilities if n else ():
            for rank in {int((n - 1) * p) + 1, min(n, int((n - 1) * p) + 2)}:
                targets.setdefault((c, rank), Target(x[c], rank, n))
    rows_at_ranks(df, list(targets.values()))
    out = {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        out[c] = []
        for p in probabilities:
            if not n:
                out[c].append(None)
                continue
            at = (n - 1) * p
            lo, hi = targets[c, int(at) + 1].value, targets[c, min(n, int(at) + 2)].value
            out[c].append(lo if lo == hi else lo + (hi - lo) * (at - int(at)))
    return out
