"""SMOTE and SMOTE-NC oversampling (RB2, RB3) with exact k nearest neighbours, found by
the metric index of ``neighbours``.

Synthetic rows are deterministic: each minority row seeds ``n_new / n_c`` samples
(the remainder goes to the first rows of a seeded permutation), and the neighbour
and the interpolation gap of every sample come from hashes of ``(seed, key, sample)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .neighbours import nearest_neighbours
from .ranking import exact_row_number
from .split import class_counts


def _uniform(seed: int, *cols) -> Column:
    """A hash-based uniform number in [0, 1)."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)).cast("double") / float(1 << 30)


def smote(df: DataFrame, label: str, key: str, features, k: int = 5, seed: int = 2,
          categorical=(), max_classes: int = 10_000) -> DataFrame:
    """RB2 (and RB3 when ``categorical`` is given): oversample every class to the
    majority count.  Output: the original rows plus synthetic ones, with
    ``synthetic`` (0/1) and ``parent`` (the base row's key)."""
    features, categorical = list(features), list(categorical)
    counts = class_counts(df, label, max_classes)
    counts.pop(None, None)  # rows without a label belong to no class and are only passed on
    n_max = max(counts.values(), default=0)
    need = {c: n_max - n for c, n in counts.items() if n < n_max}
    small = {c: counts[c] for c in need if counts[c] <= k}
    if small:
        raise ValueError(f"classes of at most k = {k} rows have no k neighbours: {small}; use a smaller k")
    base = df.select(key, label, *features, *categorical)
    orig = base.select(key, label, *features, *categorical, F.lit(0).alias("synthetic"),
                       F.col(key).cast("string").alias("parent"))
    if not need:
        return orig
    x = base.where(F.col(label).isin(*need)).select(
        key, label, F.array(*[F.col(c).cast("double") for c in features]).alias("_v"),
        *([F.array(*[F.col(c).cast("string") for c in categorical]).alias("_cat")] if categorical else []))
    weight = 0.0
    if categorical:
        stds = x.select(*[F.stddev_pop(F.col("_v")[i]).alias(f"s{i}") for i in range(len(features))]).first()
        weight = sorted(float(stds[f"s{i}"] or 0.0) for i in range(len(features)))[len(features) // 2] ** 2
    nbs = nearest_neighbours(x, label, key, k, seed, weight)
    kk = nbs.groupBy(key).agg(F.max("nb_rank").alias("_k"))
    ranked = exact_row_number(x.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key))), [label], ["_h", key], name="_rk")
    per = None
    for c, n_new in need.items():
        q, rem = divmod(n_new, counts[c])
        cond = F.col(label) == F.lit(c)
        m = F.lit(q) + F.when(F.col("_rk") <= rem, 1).otherwise(0)
        per = F.when(cond, m) if per is None else per.when(cond, m)
    samples = ranked.withColumn("_m", per).where(F.col("_m") > 0).join(kk, key)
    samples = samples.withColumn("_s", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    samples = samples.withColumn("nb_rank", (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key), F.col("_s")), F.col("_k"))
                                             + 1).cast("int"))
    j = samples.join(nbs.drop(label), [key, "nb_rank"])
    gap = _uniform(seed + 2, F.col(key), F.col("_s"))
    new_v = F.zip_with(F.col("_v"), F.col("nb_v"), lambda a, b: a + (b - a) * gap)
    out = j.select(key, label, new_v.alias("_nv"), "_s", *(["_cat"] if categorical else []))
    cols = [F.col("_nv")[i].alias(c) for i, c in enumerate(features)]
    if categorical:
        modes = _neighbour_modes(nbs, key, categorical)
        out = out.join(modes, key, "left")
        cols += [F.col(f"_mode_{c}").alias(c) for c in categorical]
    synth = out.select(F.lit(None).cast(df.schema[key].dataType).alias(key), label, *cols,
                       F.lit(1).alias("synthetic"), F.col(key).cast("string").alias("parent"))
    return orig.unionByName(synth)


def _neighbour_modes(nbs: DataFrame, key: str, categorical) -> DataFrame:
    """SMOTE-NC: each categorical value of a new row is the most frequent value among
    the base row's k neighbours (ties: smallest value)."""
    out = None
    for i, c in enumerate(categorical):
        counts = nbs.groupBy(key, F.col("nb_cat")[i].alias("_val")).agg(F.count(F.lit(1)).alias("_n"))
        mode = counts.groupBy(key).agg(F.min_by("_val", F.struct(-F.col("_n"), F.col("_val"))).alias(f"_mode_{c}"))
        out = mode if out is None else out.join(mode, key)
    return out
