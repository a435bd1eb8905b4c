"""SimHash near-duplicates, searched with the pigeonring filter.

A fingerprint's 64 bits are dealt to ``segments`` segments in a ring.  If two fingerprints
differ in at most t bits, then from some segment on, every chain of l consecutive segments
differs in at most l*t/segments bits (the ring form of the pigeonhole principle).  Chains
short enough for a budget below one bit must be equal: they are the join key.  Longer
chains prune the candidates one after the other, and the chain round the whole ring is the
Hamming check itself.

Equal fingerprints are collapsed first, so a group of copies is one fingerprint.  A key
that more than ``max_bucket`` different fingerprints share is not paired up; its members
go to an exact second way: each is sent to itself and its one-bit neighbours, and those
that meet at a centre lie within two bits of each other.  At most 65 fingerprints meet at
a centre, whatever the data, and each links to the smallest one there.

Defined results: a null or empty text has fingerprint zero, which links like any other.
Null ids take part, but a component is named by its smallest non-null id (null if it has
none).  Repeated rows share a component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colforge.session import materialize

from .common import free_name, prepare

BITS = 64
SEED = 42
#: Shingles hashed at a time, so that a very long text needs bounded memory.
BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is set if it is set in over half of the hashes."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lowers A-Z only
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        rows = range(i, min(n, i + BLOCK))
        h = np.array([digest(b" ".join(w[j:j + words]), SEED) for j in rows], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: str = "text", words: int = 3) -> Column:
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")
    return fp(F.col(text))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ring(segments: int) -> list[int]:
    """Bit masks of the segments, as signed 64-bit integers."""
    cuts = [round(BITS * i / segments) for i in range(segments + 1)]
    return [_signed(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chain(masks: list[int], start: int, length: int) -> int:
    """The bits of ``length`` consecutive segments of the ring."""
    out = 0
    for j in range(length):
        out |= masks[(start + j) % len(masks)] & ((1 << 64) - 1)
    return _signed(out)


def candidate_links(fps: DataFrame, max_distance: int = 2, segments: int = 7, max_bucket: int = 32) -> DataFrame:
    """Links (u, v) between different fingerprints of ``fps`` (column ``fp``, distinct) at
    ``max_distance`` bits or fewer; connected like all such pairs, though a crowded group
    gets stars and not every pair."""
    if max_distance not in (1, 2):
        raise ValueError("the second way for crowded keys is exact for distances of 1 and 2")
    masks, t = ring(segments), max_distance
    equal = (segments - 1) // t  # longest chain with a budget below one bit
    keys = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(chain(masks, i, equal)).cast("long")).alias("key"))
        for i in range(segments)])).alias("k")).select("fp", "k.i", "k.key")
    size = keys.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keys.join(size, ["i", "key"]), "simhash-keys")

    few = shared.where(F.col("n") <= max_bucket)
    a, b = few.select("i", "key", F.col("fp").alias("u")), few.select("i", "key", F.col("fp").alias("v"))
    diff = F.col("u").bitwiseXOR(F.col("v"))
    within = F.lit(False)
    for i in range(segments):
        ok = F.col("i") == i
        for length in range(equal + 1, segments + 1):
            ok &= F.bit_count(diff.bitwiseAND(F.lit(chain(masks, i, length)).cast("long"))) <= length * t // segments
        within |= ok
    pairs = a.join(b, ["i", "key"]).where((F.col("u") < F.col("v")) & within).select("u", "v")

    crowded = shared.where(F.col("n") > max_bucket).select("fp").distinct()
    flips = [0] + [_signed(1 << k) for k in range(BITS)]
    centres = crowded.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x).cast("long")) for x in flips])).alias("c"))
    if max_distance == 1:  # only the fingerprint that is the centre itself is one bit away from the others
        stars = centres.join(crowded.select(F.col("fp").alias("c")), "c", "left_semi").select(F.col("c").alias("u"), F.col("fp").alias("v"))
    else:
        stars = (centres.groupBy("c").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
                 .select(F.array_min("all").alias("u"), F.explode("all").alias("v")))
    return pairs.unionByName(stars.where("u <> v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); the root is the smallest node that
    can be reached.  Alternates large-star and small-star steps, which never add links and
    end after about log^2 of the nodes; each round is written to the shared folder."""
    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    now, before = state(edges), None
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        edges = materialize(small, "cc")
        now, before = state(edges), now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3, max_distance: int = 2,
                   segments: int = 7, max_bucket: int = 32, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``fp`` (signed long), ``root`` (the smallest
    fingerprint of its component), ``component_id`` (the smallest id of its component), and
    the columns of ``carry``.  Texts are read once and never shuffled."""
    prepare(df.sparkSession)
    rows = materialize(df.select(F.col(id_col).alias("id"), fingerprint_column(text, words).alias("fp"),
                                 *[c.alias(k) for k, c in (carry or {}).items()]), "simhash")
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-fp")
    roots = connected_components(candidate_links(fps.select("fp"), max_distance, segments, max_bucket))
    linked = fps.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    labels = (fps.join(named.select("fp", "root", "component_id"), "fp", "left")
              .select("fp", F.coalesce("root", "fp").alias("root"),
                      F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id")))
    # Written out, so that the join's sides are both plain exchanges: Spark can then split a
    # fingerprint that very many rows have.
    return rows.join(materialize(labels, "simhash-labels"), "fp").withColumnRenamed("id", id_col)


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Keep one row of each component, that with the smallest id (nulls last); all columns
    stay.  Rows are matched by a hash over all their columns beside the id, so rows that
    share an id but not their content are told apart, and of rows that are wholly alike
    one stays."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    winner = F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"), F.col("mark"))
    rows = simhash_groups(df, id_col, text, carry={"mark": mark}, **options)
    best = rows.groupBy("root").agg(F.min(winner).alias("w")).select("root", F.col("w.id").alias("w_id"), F.col("w.mark").alias("w_mark"))
    alike = rows.groupBy("root", F.col(id_col).alias("w_id"), F.col("mark").alias("w_mark")).agg(F.count(F.lit(1)).alias("n"))
    picks = alike.alias("a").join(best.alias("b"), (F.col("a.root") == F.col("b.root")) & (F.col("a.w_mark") == F.col("b.w_mark"))
                                  & F.col("a.w_id").eqNullSafe(F.col("b.w_id"))).select("b.root", "b.w_id", "b.w_mark", "a.n")
    picks = materialize(picks, "simhash-picks")
    own = {c: free_name(df, f"_{c}") for c in ("mark", "w_id", "w_mark", "root", "n")}
    picks = picks.select(*[F.col(c).alias(own[c]) for c in ("w_id", "w_mark", "root", "n")])
    kept = (df.withColumn(own["mark"], mark)
            .join(picks, (F.col(own["mark"]) == F.col(own["w_mark"])) & F.col(id_col).eqNullSafe(F.col(own["w_id"]))))
    once = kept.where(F.col(own["n"]) == 1)
    alike = kept.where(F.col(own["n"]) > 1).dropDuplicates([own["root"]])
    return once.unionByName(alike).select(*[F.col(f"`{c}`") for c in df.columns])
