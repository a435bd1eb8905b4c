"""Mixing sources to target weights by hash-threshold histograms.

A source's target is a number of whole passes over it and a remainder.  The remainder is
the part of the source whose documents hash below a threshold: words are summed by source
and hash bucket, the bucket in which the budget runs out is found from the running sums,
and only that bucket is split into finer buckets, until it holds a single hash value.  The
documents are then filtered by comparing hashes; they are never sorted.  A larger budget
has a higher threshold on the same hashes, so mixes of growing budgets are nested.

Texts are read once, to count words.  Everything after works on a narrow table.

Defined results: a null text has size 0.  The null source comes last in the order of
sources.  Rows with the same id share a hash and are taken or left together; a null id
hashes like an empty one.  An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colforge.session import bounded_broadcast, materialize

from .common import free_name, prepare, word_count

#: Hash values have so many bits (15 hex digits of MD5), refined so many bits at a time.
HASH_BITS, STEP_BITS = 60, 12


def id_hash(id_col: str) -> Column:
    """A non-negative 60-bit hash of the id; the same in any engine that has MD5."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, max_passes: int) -> DataFrame:
    """``target`` for each row of ``sources`` (``source``, ``source_size``): ``share`` of all
    words dealt by weight; what exceeds ``max_passes`` times a source is dealt again among
    the others until none is above.  One row per source goes through the window."""
    cycle = F.array(*[F.lit(w) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = (sources.withColumn("w", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
               .withColumn("cap", F.col("source_size") * max_passes).withColumn("full_at", F.col("cap") / F.col("w")))
    # Filled up in the order of cap / weight, sources are capped until the level fits the next.
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)
    levels = weighed.withColumn("level", level)
    # Of sources that fill up at the same level the first has the highest: they fit together.
    fits = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", (-F.col("level")).alias("minus")))).over(Window.partitionBy())
    return (levels.withColumn("fit", fits)
            .select("source", "source_size",
                    F.when(F.col("fit").isNull() | (F.col("full_at") < F.col("fit.full_at")), F.col("cap").cast("double"))
                    .otherwise(F.least(F.col("cap").cast("double"), -F.col("fit.minus") * F.col("w"))).alias("target")))


def remainder_thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """``limit`` per source of ``budgets`` (``source``, ``budget``): the documents of
    ``docs`` (``source``, ``size``, ``h``) with ``h < limit`` hold about ``budget`` words;
    of the two limits round the budget, the nearer, the lower one at a tie."""
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    # Open: the boundary bucket [low, low + 2^bits) of each source and the words below it.
    open_ = budgets.select("source", F.col("budget"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("below"))
    bits = HASH_BITS
    while bits > 0:
        width = 1 << max(0, bits - STEP_BITS)
        within = (docs.alias("d").join(bounded_broadcast(open_.withColumnRenamed("source", "s")).alias("o"), F.col("d.source").eqNullSafe(F.col("s")))
                  .where((F.col("h") >= F.col("low")) & (F.col("h") - F.col("low") < (1 << bits))))
        sums = (within.groupBy("d.source", F.expr(f"h - h % {width}L").alias("bucket"))
                .agg(F.sum("size").alias("words")))
        o = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        joined = (sums.alias("a").join(open_.alias("b"), same("a", "b"))
                  .select("a.source", "budget", "bucket", "words", "below")
                  .withColumn("start", F.col("below") + F.coalesce(F.sum("words").over(o), F.lit(0)))
                  # the first bucket that the budget does not cover to its end, with words in it
                  .where((F.col("start") + F.col("words") > F.col("budget")) & (F.col("words") > 0)))
        found = (joined.groupBy("source").agg(F.min(F.struct("bucket", "start", "words", "budget")).alias("f"))
                 .select("source", "f.budget", F.col("f.bucket").alias("low"), F.col("f.start").alias("below"), F.col("f.words").alias("words")))
        found = materialize(found, "mix-boundary")
        open_ = found.drop("words")
        bits -= STEP_BITS
    # The boundary is one hash value: its documents are taken if that comes nearer.
    take = (F.col("below") + F.col("words") - F.col("budget")) < (F.col("budget") - F.col("below"))
    return found.select("source", (F.col("low") + F.when(take, 1).otherwise(0)).alias("limit"))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_passes: int = 2) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``size``, ``source_size``, ``target``,
    ``copies`` (times the mix takes it) and ``taken`` (words)."""
    prepare(df.sparkSession)
    docs = materialize(df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"),
                                 id_hash(id_col).alias("h")), "mix")
    plan = mixing_plan(docs, weights, share, max_passes)
    joined = docs.alias("d").join(bounded_broadcast(plan.withColumnRenamed("source", "s")).alias("p"), F.col("d.source").eqNullSafe(F.col("s")))
    copies = F.col("passes") + F.when(F.col("h") < F.col("limit"), 1).otherwise(0)
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...], share: float, max_passes: int) -> DataFrame:
    """Per source of ``docs`` (``source``, ``size``, ``h``): ``source_size``, ``target``,
    ``passes`` and ``limit``."""
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sources, weights, share, max_passes), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    parts = targets.withColumn("passes", passes).withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    limits = remainder_thresholds(docs.select("source", "size", "h"), parts.where("budget > 0").select("source", "budget"))
    return materialize(parts.alias("a").join(limits.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
                       .select("a.source", "source_size", "target", "passes", F.coalesce("limit", F.lit(0)).alias("limit")), "mix-plan")


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it; the columns stay the same."""
    prepare(df.sparkSession)
    own = {c: free_name(df, f"_{c}") for c in ("s", "h", "passes", "limit", "copy")}
    docs = materialize(df.select(F.col(source).alias("source"), word_count(text).alias("size"), id_hash(id_col).alias("h")), "mix")
    plan = mixing_plan(docs, options.get("weights", (5, 2, 1)), options.get("share", 1.5), options.get("max_passes", 2))
    plan = plan.select(F.col("source").alias(own["s"]), F.col("passes").alias(own["passes"]), F.col("limit").alias(own["limit"]))
    copies = F.col(own["passes"]) + F.when(id_hash(id_col) < F.col(own["limit"]), 1).otherwise(0)
    return (df.join(bounded_broadcast(plan), F.col(source).eqNullSafe(F.col(own["s"])))
            .withColumn(own["copy"], F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
            .select(*[F.col(f"`{c}`") for c in df.columns]))
