"""Audit of how the sources of a language differ in their use of terms.

Terms are counted by language, source and term inside the tasks, and one shuffle brings
all counts of a (language, term) together; terms in too few documents of the language go.
A group is a (language, source).  Its smoothed share of a term depends on the term's count
alone, so the difference of two groups summed over all terms needs only how many terms have
count a here and count b there.  The terms of a language are numbered in blocks of 64, and
each (group, count) keeps one bitset a block: AND and popcount of two groups' bitsets give
the joint cells of the counts above zero.  Zeros follow by complement: with
``f(a, b) = |p(a) - q(b)|`` the sum over all V terms is

    V f(0,0) + sum_a |a| (f(a,0) - f(0,0)) + sum_b |b| (f(0,b) - f(0,0))
             + sum_ab |a and b| (f(a,b) - f(a,0) - f(0,b) + f(0,0)).

A block holds terms of like totals: there most counts are shared by many terms, so a
group has few bitsets, 64 at most.  Blocks spread over all tasks, and a frequent term,
language or source meets in one task only as one pre-aggregated row per task before.

Defined results: null text, language or source count as ''.  Repeated rows count each.
Every group that occurs is in the result, with value 0 to the others of its language if
the language keeps no term.  An empty table, or a language with one source and no kept
term, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colforge.session import bounded_broadcast, materialize

from .common import prepare

#: Bytes outside terms become spaces and A-Z become a-z: terms are runs of ASCII letters and
#: of everything above ASCII.
_TERM_BYTES = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

#: Bytes of text split into terms at a time; a longer text is cut into such pieces.
PIECE_BYTES = 4 << 20

#: Counts (one for each term of a group) that a task holds before it emits them.
HELD_COUNTS = 1_500_000

#: Terms of a block: the bits of a long.
BLOCK = 64

_COUNTS = "lang string, term string, sources array<string>, ns array<bigint>, docs array<bigint>"


def _plain(texts: pa.Array) -> pa.Array:
    """The texts with terms lower-cased and all else made spaces; null is empty."""
    texts = pc.fill_null(texts, "")
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or ends[-1] == ends[0]:
        return pa.array([""] * len(texts), pa.string())
    raw = texts.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().translate(_TERM_BYTES)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(raw))


@dataclass
class Counts:
    """For each (term, group) its occurrences and documents.  Every group is listed, also
    without terms."""

    names: pa.Array  # the terms
    groups: list[tuple[str, str]]  # language and source
    code: np.ndarray  # place in names ...
    group: np.ndarray  # ... and in groups
    n: np.ndarray
    docs: np.ndarray


def count_texts(texts: pa.Array, pairs: list[tuple[str, str]]) -> Counts:
    """Of texts that ``_plain`` has made; ``pairs`` are their groups."""
    groups = {g: i for i, g in enumerate(dict.fromkeys(pairs))}
    of = np.fromiter((groups[g] for g in pairs), dtype=np.int64, count=len(pairs))
    words = pc.ascii_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    code, size = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
    key = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(words.offsets.to_numpy())) * size + code
    key = key[code != pc.index(coded.dictionary, "").as_py()]
    found = pc.value_counts(pa.array(key))
    key, n = found.field("values").to_numpy(), found.field("counts").to_numpy()
    return _summed(coded.dictionary, list(groups), key % size, of[key // size], n, np.ones(len(n), dtype=np.int64))


def _summed(names: pa.Array, groups: list, code: np.ndarray, group: np.ndarray, n: np.ndarray, docs: np.ndarray) -> Counts:
    """One entry for each code and group, by code and then language and source."""
    rank = np.empty(len(groups), dtype=np.int64)
    order = sorted(range(len(groups)), key=lambda i: groups[i])
    rank[order] = np.arange(len(groups))
    key = code * max(1, len(groups)) + rank[group]
    by = np.argsort(key, kind="stable")
    key = key[by]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    if len(first):
        n, docs = np.add.reduceat(n[by], first), np.add.reduceat(docs[by], first)
    key = key[first]
    return Counts(names, [groups[i] for i in order], (key // max(1, len(groups))).astype(np.int32), (key % max(1, len(groups))).astype(np.int32), n, docs)


def merge_counts(parts: list[Counts]) -> Counts:
    coded = pa.concat_arrays([p.names for p in parts]).dictionary_encode()
    place = coded.indices.to_numpy().astype(np.int64)
    groups = {g: i for i, g in enumerate(dict.fromkeys(g for p in parts for g in p.groups))}
    code, group, at = [], [], 0
    for p in parts:
        code.append(place[at + p.code])
        group.append(np.array([groups[g] for g in p.groups], dtype=np.int64)[p.group])
        at += len(p.names)
    return _summed(coded.dictionary, list(groups), np.concatenate(code), np.concatenate(group),
                   np.concatenate([p.n for p in parts]), np.concatenate([p.docs for p in parts]))


def count_pieces(texts: pa.Array, pairs: list[tuple[str, str]], size: int = PIECE_BYTES) -> Iterator[Counts]:
    """Counts of texts in pieces of about ``size`` bytes.  A text that is longer is cut
    between terms (where it has a place to cut) and counts as one document."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) if len(texts) else np.empty(0, dtype=np.int64)
    at = 0
    while at < len(texts):
        start = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, start + size, side="right")))
        if ends[to - 1] - start <= size:
            yield count_texts(texts[at:to], pairs[at:to])
        else:  # one long text
            raw, pos, parts = texts[at].as_buffer(), 0, []
            while pos < raw.size:
                step = raw.slice(pos, min(size, raw.size - pos)).to_pybytes()
                cut = step.rfind(b" ") + 1 if pos + len(step) < raw.size else len(step)
                if cut <= 0:  # a term longer than the piece
                    step = raw.slice(pos).to_pybytes()
                    cut = step.find(b" ") + 1 or len(step)
                parts.append(count_texts(pa.array([step[:cut]], pa.binary()).cast(pa.string()), pairs[at:to]))
                pos += cut
            whole = merge_counts(parts)
            whole.docs = np.ones_like(whole.docs)
            yield whole
        at = to


def _as_batch(c: Counts) -> pa.RecordBatch:
    """As a batch of ``_COUNTS``: for each (language, term) its sources.  The term '' lists
    all sources of a language, with zeros."""
    marks = np.arange(len(c.groups), dtype=np.int32)
    code = np.concatenate([np.full(len(marks), -1, dtype=np.int32), c.code])
    group = np.concatenate([marks, c.group])
    zero = np.zeros(len(marks), dtype=np.int64)
    lang_names = list(dict.fromkeys(g[0] for g in c.groups))
    lang = np.array([lang_names.index(g[0]) for g in c.groups], dtype=np.int64)[group]
    row = np.flatnonzero((np.diff(code, prepend=-2) != 0) | (np.diff(lang, prepend=-1) != 0))
    offsets = pa.array(np.append(row, len(code)), type=pa.int32())
    names = pa.concat_arrays([pa.array([""], pa.string()), c.names])
    sources = pa.array([g[1] for g in c.groups], pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang_names, pa.string()).take(pa.array(lang[row])), names.take(pa.array(code[row] + 1)),
         pa.ListArray.from_arrays(offsets, sources.take(pa.array(group))),
         pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([zero, c.n]))),
         pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([zero, c.docs])))],
        ["lang", "term", "sources", "ns", "docs"])


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30) -> DataFrame:
    """``lang, source, term, n, total``: occurrences in the group and in the language, for
    terms in at least ``min_docs`` documents of the language; and a row with term '' for
    every group."""
    spark = prepare(df.sparkSession)
    rows = df.select(F.col(text).cast("string").alias("t"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("l"),
                     F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counts] = []
        for b in batches:
            pairs = list(zip(b.column("l").to_pylist(), b.column("s").to_pylist()))
            for part in count_pieces(_plain(b.column("t")), pairs):
                held.append(part)
                if sum(len(p.code) for p in held) >= HELD_COUNTS:
                    yield _as_batch(merge_counts(held))
                    held = []
        if held:
            yield _as_batch(merge_counts(held))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = (rows.mapInArrow(run, _COUNTS).repartition(n, "lang", "term")
               .select("lang", "term", F.inline(F.arrays_zip("sources", "ns", "docs")).alias("source", "n", "docs")))
    counts = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    counts = counts.select("lang", "source", "term", "n", F.sum("n").over(whole).alias("total"), F.sum("docs").over(whole).alias("in_docs"))
    return counts.where((F.col("in_docs") >= min_docs) | (F.col("term") == "")).drop("in_docs")


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 (n + 5) / (total + 5 terms))``, exact; null without terms."""
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 5).cast("decimal(20,0)")
    below = (total + 5 * terms).cast("decimal(20,0)")
    whole = (above - above % below) / below
    return F.when(terms > 0, whole.cast("long") + 1)


def count_bitsets(counts: DataFrame, block_terms: int = 512) -> DataFrame:
    """``lang, m, b, w, source, n, bits``: for each group and count above zero, the terms of
    a block of 64 with that count, as bits.  Terms are numbered among those of a like
    ``total`` (``m``, its binary logarithm) and the same hash bucket (``b``), of which there
    are so many that each has about ``block_terms``; ``w`` counts their blocks."""
    terms = counts.where((F.col("term") != "") & (F.col("n") > 0)).withColumn("m", F.floor(F.log2("total")).cast("int"))
    n = (terms.groupBy("lang", "m", "term").agg(F.lit(1).alias("x")).groupBy("lang", "m")
         .agg(F.ceil(F.count(F.lit(1)) / block_terms).alias("buckets")))
    terms = terms.join(bounded_broadcast(n), ["lang", "m"]).withColumn("b", F.pmod(F.xxhash64("term"), F.col("buckets")))
    number = F.dense_rank().over(Window.partitionBy("lang", "m", "b").orderBy("term")) - 1
    terms = terms.select("lang", "source", "n", "m", "b", number.alias("i"))
    bit = F.expr(f"shiftleft(1L, i % {BLOCK})")
    return terms.groupBy("lang", "m", "b", F.expr(f"i div {BLOCK}").alias("w"), "source", "n").agg(F.bit_or(bit).alias("bits"))


def source_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of a language's sources."""
    bits = materialize(count_bitsets(counts), "count-bitsets")
    known = bounded_broadcast(groups.select("lang", "source", "size", "terms"))
    leveled = bits.join(known, ["lang", "source"]).select("lang", "m", "b", "w", "source", "n", "bits", share(F.col("n"), F.col("size"), F.col("terms")).alias("p"),
                                                         share(F.lit(0), F.col("size"), F.col("terms")).alias("p0"))
    x, y = leveled.alias("x"), leveled.alias("y")
    f = lambda a, b: F.abs(F.col(a) - F.col(b))
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("lang", "m", "b", "w")]
    cells = (x.join(y, [*same, F.col("x.source") < F.col("y.source"), F.col("x.bits").bitwiseAND(F.col("y.bits")) != 0])
             .groupBy(F.col("x.lang").alias("lang"), F.col("x.source").alias("s1"), F.col("y.source").alias("s2"))
             .agg(F.sum(F.bit_count(F.col("x.bits").bitwiseAND(F.col("y.bits"))) * (f("x.p", "y.p") - f("x.p", "y.p0") - f("x.p0", "y.p") + f("x.p0", "y.p0"))).alias("both")))
    levels = leveled.groupBy("lang", "source", "p").agg(F.sum(F.bit_count("bits")).alias("k"))
    zero = groups.select("lang", "source", "terms", share(F.lit(0), F.col("size"), F.col("terms")).alias("p0"))
    g, h = zero.alias("g"), bounded_broadcast(zero).alias("h")
    pairs = (g.join(h, (F.col("g.lang") == F.col("h.lang")) & (F.col("g.source") != F.col("h.source")))
             .select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), F.col("h.source").alias("item"),
                     F.col("g.terms").alias("terms"), F.col("g.p0").alias("p0"), F.col("h.p0").alias("q0")))
    # What the counts above zero of one side add where the other has none.
    alone = (pairs.join(levels, ["lang", "source"]).groupBy("lang", "source", "item")
             .agg(F.sum(F.col("k") * (F.abs(F.col("p") - F.col("q0")) - F.abs(F.col("p0") - F.col("q0")))).alias("alone")))
    s1, s2 = F.least("source", "item"), F.greatest("source", "item")
    one_way = alone.select("lang", s1.alias("s1"), s2.alias("s2"), F.col("alone").alias("part"))
    sums = (one_way.unionByName(cells.select("lang", "s1", "s2", F.col("both").alias("part")))
            .groupBy("lang", "s1", "s2").agg(F.sum("part").alias("rest")))
    pairs = pairs.withColumn("s1", s1).withColumn("s2", s2).join(sums, ["lang", "s1", "s2"], "left")
    base = F.when(F.col("terms") > 0, F.col("terms") * F.abs(F.col("p0") - F.col("q0"))).otherwise(0)
    return pairs.select("lang", "source", "item", (base + F.coalesce("rest", F.lit(0))).cast("long").alias("value"))


def audit_sources(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30,
                  top_terms: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``.  Part ``pair``: the other sources of the
    language by how far their shares of terms are apart.  Part ``term``: the
    ``top_terms`` terms whose share in the source is most above that in the language."""
    counts = materialize(term_counts(df, text, lang, source, min_docs), "term-counts")
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    real = counts.where(F.col("term") != "").groupBy("lang", "term").agg(F.first("total").alias("total"))
    langs = real.groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("terms"))
    groups = sizes.join(bounded_broadcast(langs), "lang", "left").select("lang", "source", "size", F.coalesce("lang_size", F.lit(0)).alias("lang_size"),
                                                                         F.coalesce("terms", F.lit(0)).cast("long").alias("terms"))
    groups = materialize(groups, "source-groups")
    pairs = source_pairs(counts, groups).withColumn("part", F.lit("pair"))
    terms = (counts.where((F.col("term") != "") & (F.col("n") > 0)).join(bounded_broadcast(groups), ["lang", "source"])
             .select("lang", "source", F.col("term").alias("item"),
                     (share(F.col("n"), F.col("size"), F.col("terms")) - share(F.col("total"), F.col("lang_size"), F.col("terms"))).alias("value"))
             .where(F.col("value") > 0).withColumn("part", F.lit("term")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, terms)]
    ranked[1] = ranked[1].where(F.col("rank") <= top_terms)
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
