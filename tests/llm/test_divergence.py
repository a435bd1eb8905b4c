import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from colforge.llm import divergence
from colforge.llm import queries as Q

from .helpers import SF, edge_docs, edge_rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=30, top=50):
    """Over ``(text, lang, source)``: every term of every pair of groups, in Python integers."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = Counter(TERM.findall((text or "").translate(LOWER)))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    out = []
    for lang in docs:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        group = {s: {t: c[t] for t in kept} for (a, s), c in counts.items() if a == lang}

        def shares(c):
            size = sum(c.values())
            return {t: 1 + 10**9 * (n + 5) // (size + 5 * len(kept)) for t, n in c.items()}

        p = {s: shares(c) for s, c in group.items()}
        q = shares({t: sum(c[t] for c in group.values()) for t in kept})
        for s in group:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in group if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if group[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k) for k, (t, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def audited(df, **kw):
    return sorted(tuple(r) for r in divergence.audit_sources(df, **kw).collect())


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()]
    assert sorted(tuple(r) for r in Q.op12_source_divergence(spark, SF).collect()) == brute(rows)


def test_edge_rows(spark):
    rows = [(t, lang, s) for _, t, lang, s, _ in edge_rows()]
    df = edge_docs(spark).select("*", *[F.lit("x").alias(c) for c in ("term", "ns", "docs", "total", "item", "part", "rank", "m", "b", "w")])
    for min_docs in (1, 2, 1000):  # with the last, no language keeps a term
        assert audited(df, min_docs=min_docs, top_terms=7) == brute(rows, min_docs, 7)
    assert audited(df.limit(0)) == []


def test_blocks_of_many_sizes_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzäöü日'[i // 100]}" for i in range(1000)]
    rows = [(" ".join(words[int(k)] for k in rng.zipf(1.3, 60) % 1000), "l", f"s{i % 7 if i % 3 else 0}") for i in range(400)]
    want = brute(rows, 2)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audited(df, min_docs=2) == want
    bits = divergence.count_bitsets
    for size in (1, 70, 100_000):
        monkeypatch.setattr(divergence, "count_bitsets", lambda c, n=size: bits(c, n))
        assert audited(df, min_docs=2) == want, size


def as_dict(counts):
    return {(*c.groups[g], c.names[int(k)].as_py()): (int(n), int(d)) for c in [divergence.merge_counts(counts)] for k, g, n, d in zip(c.code, c.group, c.n, c.docs)}


def test_long_texts_are_counted_in_pieces():
    texts = pa.array(["a b " * 4000, "", "c " + "d" * 5000 + " c", "b", "é" * 300])
    pairs = [("l", "s"), ("l", "s"), ("l", "t"), ("l", "t"), ("m", "t")]
    whole = as_dict(list(divergence.count_pieces(texts, pairs)))
    for size in (1, 7, 100, 10_000):
        assert as_dict(list(divergence.count_pieces(texts, pairs, size))) == whole
    assert whole["l", "s", "b"] == (4000, 1) and whole["l", "t", "b"] == (1, 1) and whole["l", "t", "c"] == (2, 1)
    batch = divergence._as_batch(divergence.merge_counts(list(divergence.count_pieces(texts, pairs)))).to_pylist()
    rows = {(r["lang"], r["term"]): list(zip(r["sources"], r["ns"], r["docs"])) for r in batch}
    assert len(rows) == len(batch) and rows["l", "b"] == [("s", 4000, 1), ("t", 1, 1)]
    assert rows["l", ""] == [("s", 0, 0), ("t", 0, 0)] and rows["m", ""] == [("t", 0, 0)]


def test_terms_of_a_slice_with_nulls():
    texts = pa.array(["x", "Über ÄB\x00c-d'É", None, "日本 A\x7fb"]).slice(1)
    got = [t.split() for t in divergence._plain(texts).to_pylist()]
    assert got == [TERM.findall((t or "").translate(LOWER)) for t in texts.to_pylist()]
