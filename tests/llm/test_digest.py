import hashlib

from pyspark.sql import functions as F

from colforge.llm import digest
from colforge.llm import queries as Q

from .helpers import SF, edge_docs, edge_rows


def brute(rows):
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        n = len(t) // 4
        e = t[:len(t) - n] + nxt[:n]
        a, b, c = digest.digest(t), digest.digest(e), digest.digest(nxt)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, digest.likeness(a, b), digest.likeness(a, c)))
    return out


def test_matches_brute_force_over_many_ranges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    want = brute(rows)
    assert sorted(tuple(r) for r in Q.op10_fingerprints(spark, SF).collect()) == want
    for size in (1, 7, 64):
        assert sorted(tuple(r) for r in digest.neighbour_digests(docs.repartition(5), rows_per_range=size).collect()) == want


def test_edge_rows(spark):
    for size in (1, 3, 1000):
        df = edge_docs(spark)
        got = digest.neighbour_digests(df, rows_per_range=size).collect()
        h = {r["text"]: r["x"] for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("x")).collect()}
        rows = sorted(edge_rows(), key=lambda r: (r[0] is None, r[0] or 0, h[r[1]]))
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute([r[:2] for r in rows])))
    assert digest.neighbour_digests(df.limit(0)).count() == 0
    one = digest.neighbour_digests(edge_docs(spark, rows=edge_rows()[:1])).first()
    assert one["near_next"] == 1.0 and one["near_edited"] > 0.5


def test_score():
    a, b = digest.digest("the quick brown fox " * 50), digest.digest("completely other words in here " * 50)
    assert digest.digest(None) == digest.digest("") and digest.difference(a, a) == 0
    assert digest.difference(a, b) == digest.difference(b, a) > 0
    assert 0 <= digest.likeness(a, b) < digest.likeness(a, digest.digest("the quick brown fox " * 49 + "the quack brown fox ")) <= 1
    assert digest.digest("ab") != digest.digest("")


def test_edited_is_nearer_than_next(spark):
    rows = [r for r in Q.op10_fingerprints(spark, "/root/testdata/sf0.01").collect() if r["n_chars"] > 200]
    assert sum(r["near_edited"] > r["near_next"] for r in rows) / len(rows) > 0.98


def test_long_texts_are_digested_in_blocks(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(5000))
    want = digest.digest(text)
    monkeypatch.setattr(digest, "BLOCK", 37)
    assert digest.digest(text) == want
