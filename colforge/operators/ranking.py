"""Exact row numbers without a single-task window.

``row_number() OVER (PARTITION BY label ORDER BY h)`` sends every row of a class to one
task; with three classes a third of the table would be sorted by one core.  Here the
rows are range-partitioned on ``(by…, order…)`` so that one class spreads over many
tasks, each task numbers its rows locally, and a small table of per-task counts (at most
#tasks + #groups rows, a proven bound) supplies each task's offset.

The order must be total (add tie-break columns) so that a recomputed partition numbers
its rows the same way; the numbered frame is also written to the shared checkpoint
folder, which fixes the numbering once and cuts the lineage of the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast, materialize

_PID, _MID, _CNT, _FIRST, _BEFORE = "_cf_pid", "_cf_mid", "_cf_cnt", "_cf_first", "_cf_before"


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files and local relations that a plan reads.  Unlike the estimate for the
    whole plan, this does not multiply at joins; a leaf of unknown size counts as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)


def target_partitions(df: DataFrame) -> int:
    """Number of range partitions: at least ``spark.sql.shuffle.partitions``, and one for
    every 128 MB that the plan reads."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, -(-scanned_bytes(df) // TARGET_PARTITION_BYTES))


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def exact_row_number(df: DataFrame, by: list[str], order: list, name: str = "rn",
                     num_partitions: int | None = None, max_groups: int = 100_000) -> DataFrame:
    """Add ``name`` = row_number() over (partition by ``by`` order by ``order``), 1-based.

    ``by`` must have few distinct groups (labels, classes; checked against
    ``max_groups``); for many small groups a plain window is the right tool.
    ``order`` items are column names or sort expressions (``F.col(x).desc()``).
    """
    n = num_partitions or target_partitions(df)
    keys = _cols(by) + _cols(order)
    ranked = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    ranked = materialize(ranked, "rownum")
    stats = ranked.groupBy(_PID, *by).agg(F.count(F.lit(1)).alias(_CNT), F.min(_MID).alias(_FIRST))
    if stats.limit(n + max_groups + 1).count() > n + max_groups:
        raise ValueError(f"exact_row_number: more than {max_groups} groups in {by}")
    w = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn(_BEFORE, F.coalesce(F.sum(_CNT).over(w), F.lit(0)))
    out = ranked.join(bounded_broadcast(stats.select(_PID, *by, _BEFORE, _FIRST)
                                        .withColumnsRenamed({c: f"_cf_k_{c}" for c in [_PID, *by]})),
                      on=[ranked[_PID] == F.col(f"_cf_k_{_PID}")]
                         + [ranked[c].eqNullSafe(F.col(f"_cf_k_{c}")) for c in by])
    out = out.withColumn(name, (F.col(_BEFORE) + (F.col(_MID) - F.col(_FIRST)) + 1).cast("bigint"))
    return out.drop(_PID, _MID, _BEFORE, _FIRST, *[f"_cf_k_{c}" for c in [_PID, *by]])


#: Rows of one bucket of ``hash_row_number``, about.
BUCKET_ROWS = 50_000


def hash_row_number(df: DataFrame, by: list[str], h: Column, ties: list, name: str = "rn") -> DataFrame:
    """Add ``name`` = row_number() over (partition by ``by`` order by ``h``, ``ties``) for a
    hash ``h`` in hex digits, which spreads the rows evenly by its first digits.

    Rows are counted by group and prefix; running sums over the prefixes (of three digits,
    then within each; at most 4096 rows a window) say how many rows come before a prefix.
    One shuffle deals the rows out by group and prefix, where each is numbered among about
    ``BUCKET_ROWS``.  Nothing is sampled or written.  Rows that tie in everything named are
    ordered by a hash of the whole row, so that a lost task numbers them as before."""
    n = df.count()
    digits = 0
    while 16**digits * BUCKET_ROWS < n and digits < 6:
        digits += 1
    rows = df.withColumn("_cf_h", h).withColumn("_cf_p", F.substring("_cf_h", 1, digits))
    groups = [f"_cf_g{i}" for i in range(len(by))]
    keys = [F.col(c).alias(g) for c, g in zip(by, groups)]
    counts = rows.groupBy(*keys, F.col("_cf_p").alias("_cf_q")).agg(F.count(F.lit(1)).alias(_CNT)).withColumn("_cf_top", F.substring("_cf_q", 1, 3))
    before = lambda part, order: (Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    tops = counts.groupBy(*groups, "_cf_top").agg(F.sum(_CNT).alias("_cf_sum"))
    tops = tops.select(*[F.col(g).alias(f"{g}t") for g in groups], F.col("_cf_top").alias("_cf_topt"),
                       F.coalesce(F.sum("_cf_sum").over(before(groups, "_cf_top")), F.lit(0)).alias("_cf_far"))
    counts = counts.withColumn("_cf_near", F.coalesce(F.sum(_CNT).over(before([*groups, "_cf_top"], "_cf_q")), F.lit(0)))
    offsets = counts.join(tops, [F.col("_cf_top") == F.col("_cf_topt"), *[F.col(g).eqNullSafe(F.col(f"{g}t")) for g in groups]])
    offsets = offsets.select(*groups, "_cf_q", (F.col("_cf_far") + F.col("_cf_near")).alias(_BEFORE))
    out = rows.join(bounded_broadcast(offsets), [F.col("_cf_p") == F.col("_cf_q"), *[F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, groups)]])
    order = Window.partitionBy(*by, "_cf_p").orderBy("_cf_h", *_cols(ties), F.xxhash64(*[F.col(c) for c in df.columns]))
    return out.withColumn(name, (F.col(_BEFORE) + F.row_number().over(order)).cast("bigint")).select(*df.columns, name)


def md5_order(key_cols, seed: int | str = 42) -> Column:
    """A stable pseudo-random order: md5('<seed>:<key>'), the same hex text in Spark and
    DuckDB.  Several key columns are joined with ':'."""
    parts = [F.lit(str(seed))]
    for c in key_cols:
        parts += [F.lit(":"), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.md5(F.concat(*parts))
