"""Profiling aggregates (AG1–AG6, WN1, HG1, HG2).

Column profiles are computed in one aggregation pass over the data (or one pass over
its unpivoted form), never one job per column.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import nan_to_null
from ..session import bounded_broadcast, materialize


#: Classes up to which their weights are read.
FEW_CLASSES = 10_000


def _clean(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    x = F.col(c)
    return nan_to_null(x) if t in ("double", "float") else x


def group_mean(df: DataFrame, key: str, col: str, name: str | None = None,
               max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """AG1: per-row mean of ``col`` over the row's ``key`` group.

    Aggregate-then-join rather than a window: the aggregation combines map-side, so a
    key holding a third of the rows does not land in one task.  The means (one row per
    key) are broadcast when their count is proven small; otherwise the join shuffles and
    AQE splits a skewed partition.  Rows with a NULL key get NULL (pandas drops NaN
    groups).
    """
    name = name or f"{col}_mean"
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(_clean(df, col)).alias(name))
    return df.join(bounded_broadcast(means, max_broadcast_rows), on=key, how="left")


def _counts_and_totals(df: DataFrame, label: str, rows: str | None = None):
    """Per-value counts plus the two scalars (rows, distinct values) read with one
    aggregation over the counts, so no single-partition window spans all values.  Where a
    row stands for several, ``rows`` names the column with their number."""
    n = F.sum(rows) if rows else F.count(F.lit(1))
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(n.alias("count"))
    tot = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return counts, (tot["n"] or 0), (tot["k"] or 0)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """AG2: class counts and shares (``value_counts``), missing labels excluded."""
    counts, n, _ = _counts_and_totals(df, label)
    return counts.withColumn("ratio", F.col("count") / F.lit(n))


def class_weights(df: DataFrame, label: str, rows: str | None = None) -> DataFrame:
    """AG3: balanced weights n / (k · n_c) per class."""
    counts, n, k = _counts_and_totals(df, label, rows)
    return counts.withColumn("weight", F.lit(n) / (F.lit(k) * F.col("count")))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight", rows: str | None = None) -> DataFrame:
    """AG3 applied: attach the balanced weight of each row's class (for ``weightCol``).

    The weights are one row per class.  A few are read and broadcast whatever Catalyst, which
    takes them for a part of the table they were counted from, says of their size: joined by
    a shuffle, all rows would lie in as many tasks as there are classes.  More are joined."""
    w = class_weights(df, label, rows).select(F.col(label).alias("_cf_class"), F.col("weight").alias(weight_col))
    few = w.limit(FEW_CLASSES + 1).collect()
    w = F.broadcast(df.sparkSession.createDataFrame(few, w.schema)) if len(few) <= FEW_CLASSES else bounded_broadcast(w)
    return df.join(w, F.col(label) == F.col("_cf_class"), "left").drop("_cf_class")


def missing_fraction(df: DataFrame, cols=None) -> DataFrame:
    """AG4: fraction of missing values per column (NaN counts as missing); one pass."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(_clean(df, c).isNull().cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"_m{i}").alias("missing_fraction"))
             for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*pairs)))


def _as_text(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    x = F.col(c)
    if t in ("double", "float"):
        x = nan_to_null(x)
        x = F.when(x == 0, F.lit(0.0)).otherwise(x)  # -0.0 and 0.0 are one value
    return x.cast("string")


def distinct_counts(df: DataFrame, cols=None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """AG5: number of distinct non-missing values per column (``nunique``).

    Exact mode unpivots to ``(feature, value)`` and aggregates twice; the first
    aggregation removes duplicates map-side, so the shuffle carries at most the distinct
    pairs, and no column needs its own job or an Expand per distinct aggregate.
    ``approx=True`` uses one HyperLogLog pass instead.
    """
    cols = list(cols or df.columns)
    if approx:
        one = df.agg(*[F.approx_count_distinct(_as_text(df, c), rsd).alias(f"_d{i}") for i, c in enumerate(cols)])
        pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"_d{i}").cast("bigint").alias("nunique"))
                 for i, c in enumerate(cols)]
        return one.select(F.inline(F.array(*pairs)))
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), _as_text(df, c).alias("value"))
                                         for c in cols])))
    found = (long.where(F.col("value").isNotNull()).select("feature", "value").distinct()
             .groupBy("feature").agg(F.count(F.lit(1)).alias("nunique")))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(found, "feature", "left").select("feature", F.coalesce("nunique", F.lit(0)).cast("bigint").alias("nunique"))


#: Columns of one side of a scan's pairs; a task holds six sums for each pair.
COLUMNS_AT_ONCE = 1_000

#: Rows from which the values are shifted before they are summed.
SHIFT_ROWS = 1_000

#: A column is summed again about its mean if that is so many deviations from the shift.
FAR_SHIFT = 1_000.0

_PAIR = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pair_sums(x: DataFrame, left: list[int], right: list[int], shift: list[float]) -> DataFrame:
    """Sums for every pair i < j of a column of ``left`` and one of ``right``, over the rows
    where both are present: one block product per Arrow batch, one row per pair and task."""
    used = sorted({*left, *right})
    a, b = [used.index(i) for i in left], [used.index(j) for j in right]
    about = np.array([shift[i] for i in used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - about
            m = (~np.isnan(v)).astype(np.float64)
            v[m == 0] = 0.0
            w = v * v
            ml, mr, vl, vr = m[:, a], m[:, b], v[:, a], v[:, b]
            with np.errstate(invalid="ignore"):  # infinities times nothing
                sums = np.stack([ml.T @ mr, vl.T @ mr, ml.T @ vr, w[:, a].T @ mr, ml.T @ w[:, b], vl.T @ vr])
            total = sums if total is None else total + sums
        if total is None:
            return
        i, j = np.meshgrid(np.array(left), np.array(right), indexing="ij")
        up = i < j
        yield pa.RecordBatch.from_arrays([pa.array(i[up], pa.int32()), pa.array(j[up], pa.int32()), *[pa.array(t[up]) for t in total]],
                                         ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return x.select(*[f"x{i}" for i in used]).mapInArrow(run, _PAIR)


def pairwise_corr(df: DataFrame, cols) -> DataFrame:
    """AG6: Pearson correlation of every column pair (i < j in the given order), over the
    rows where both values are present.

    A masked Gram matrix: each task multiplies its Arrow batches, values and presence, into
    block sums of all pairs, and the sums are added by pair.  One scan serves up to
    ``COLUMNS_AT_ONCE`` columns, 1,000 by default; more take a scan per pair of such column
    groups.  Values are summed about the mean of some first rows; if a column turns out to
    lie far from that (``FAR_SHIFT`` deviations), all are summed once more about their means.
    A pair with a constant side or fewer than two rows gives NULL, which never passes a
    threshold, and so does a column with infinities.  Output: ``feature_1, feature_2, corr``.
    """
    cols = list(cols)
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], "feature_1 string, feature_2 string, corr double")
    x = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    first = x.limit(SHIFT_ROWS).agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(cols))]).first()
    shift = [v if v is not None and math.isfinite(v) else 0.0 for v in first]
    groups = [list(range(at, min(at + COLUMNS_AT_ONCE, len(cols)))) for at in range(0, len(cols), COLUMNS_AT_ONCE)]

    def sums(shift: list[float]) -> DataFrame:
        d = F.lit(len(cols))
        none = (spark.range(len(cols) ** 2).select((F.col("id") / d).cast("int").alias("i"), (F.col("id") % d).cast("int").alias("j"))
                .where("i < j").select("i", "j", *[F.lit(0.0).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
        parts = [none, *[_pair_sums(x, g, h, shift) for k, g in enumerate(groups) for h in groups[k:]]]
        rows = reduce(lambda p, q: p.unionByName(q), parts)
        return materialize(rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]), "pair-sums")

    found = sums(shift)
    side = lambda c, s, ss: found.select(F.col(c).alias("c"), "n", F.col(s).alias("s"), F.col(ss).alias("ss"))
    mean = F.try_divide(F.col("s"), F.col("n"))
    most = (side("i", "sx", "sxx").unionByName(side("j", "sy", "syy")).groupBy("c")
            .agg(F.max_by(F.struct(mean.alias("m"), F.try_divide(F.col("ss"), F.col("n")).alias("q")), "n").alias("x")).select("c", "x.*"))
    means = {r["c"]: (r["m"], r["q"]) for r in most.collect() if r["m"] is not None and math.isfinite(r["m"]) and math.isfinite(r["q"])}  # one row per column
    if any(q - m * m < (m / FAR_SHIFT) ** 2 and abs(m) > 1e-9 * abs(shift[i]) for i, (m, q) in means.items()):
        found = sums([s + means[i][0] if i in means else s for i, s in enumerate(shift)])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") ** 2, n * F.col("syy") - F.col("sy") ** 2
    # Less than this is what rounding leaves of a constant: shifted values have at least 1e-6.
    varies = (n > 1) & (vx > n * F.col("sxx") * 1e-9) & (vy > n * F.col("syy") * 1e-9)
    r = F.when(varies, F.try_divide(n * F.col("sxy") - F.col("sx") * F.col("sy"), F.sqrt(vx) * F.sqrt(vy)))
    r = F.when(r.isNotNull() & ~F.isnan(r), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))  # least/greatest skip NULL
    names = F.from_json(F.lit(json.dumps(cols)), "array<string>")
    return found.select(F.get(names, F.col("i")).alias("feature_1"), F.get(names, F.col("j")).alias("feature_2"), r.alias("corr"))


def cumulative_share(imp: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    """WN1: normalised share and running cumulative share, largest first (ties by name).

    The input is feature-count sized (one row per feature), so one ordered window is fine.
    """
    w_all = Window.partitionBy()
    w_run = Window.orderBy(F.col(value).desc(), F.col(feature).asc()).rowsBetween(Window.unboundedPreceding, 0)
    out = imp.withColumn("normalized_importance", F.try_divide(F.col(value), F.sum(value).over(w_all)))
    return (out.withColumn("cumulative_importance", F.sum("normalized_importance").over(w_run))
               .withColumn("rank", F.row_number().over(Window.orderBy(F.col(value).desc(), F.col(feature).asc()))))


def unit_histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """HG1: histogram of values in [0, 1] with ``bins`` equal bins, last bin closed."""
    x = nan_to_null(F.col(col).cast("double"))
    b = F.least(F.floor(x * bins) + 1, F.lit(bins)).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
              .withColumn("bin_lo", (F.col("bin") - 1) / F.lit(float(bins)))
              .withColumn("bin_hi", F.col("bin") / F.lit(float(bins))))


def range_histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """HG2: ``bins`` equal bins over [min, max] (pandas ``hist`` default), last bin closed."""
    x = nan_to_null(F.col(col).cast("double"))
    lo_hi = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    bounds = lo_hi.first()
    lo, hi = bounds["_lo"], bounds["_hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, count bigint, bin_lo double, bin_hi double")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
              .withColumn("bin_lo", F.lit(lo) + (F.col("bin") - 1) * F.lit(width))
              .withColumn("bin_hi", F.lit(lo) + F.col("bin") * F.lit(width)))
