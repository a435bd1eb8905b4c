import hashlib

import pytest

from colforge.llm import mixing

from .helpers import SF, WORD, edge_docs, edge_rows


def h(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


def brute(rows, weights=(5, 2, 1), share=1.5):
    """Targets by repeated resharing, and the nearest prefix by hash."""
    size = {}
    for _, text, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), share * sum(size.values())
    while True:
        rest, free = total - sum(2 * size[s] for s in capped), [s for s in order if s not in capped]
        target = {s: 2.0 * size[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in order}
        above = {s for s in free if target[s] > 2 * size[s] + 1e-9}
        if not above:
            return size, target
        capped |= above


def check(rows, got):
    size, target = brute(rows)
    taken = {}
    for r in got:
        assert r["source_size"] in size.values()
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    by_id = {}
    for i, t, _, s, _ in rows:
        by_id.setdefault((i, len(WORD.findall(t or ""))), s)
    for r in got:
        s = by_id[(r["doc_id"], r["size"])]
        assert r["target"] == pytest.approx(target[s]) and r["source_size"] == size[s]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in size:
        passes = int(target[s] // size[s]) if size[s] else 0
        budget, words = target[s] - passes * size[s], {}
        for i, t, _, x, _ in rows:
            if x == s:
                words[h(i)] = words.get(h(i), 0) + len(WORD.findall(t or ""))
        cuts = [0]
        for k in sorted(words):
            cuts.append(cuts[-1] + words[k])
        assert taken[s] == passes * size[s] + min(cuts, key=lambda c: (abs(c - budget), c))


def test_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    check([tuple(r) for r in docs.collect()], mixing.mix_sources(docs).collect())


def test_edge_rows(spark):
    df = edge_docs(spark)
    check(edge_rows(), mixing.mix_sources(df).collect())
    assert mixing.mix_sources(df.limit(0)).count() == 0
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    want = sum(r["copies"] for r in mixing.mix_sources(df).collect())
    assert mixed.count() == want


def test_only_empty_texts(spark):
    rows = [(i, None, "en", s, 0) for i, s in enumerate(["a", "b", None])]
    assert [r["taken"] for r in mixing.mix_sources(edge_docs(spark, rows=rows)).collect()] == [0, 0, 0]


def test_many_small_documents_come_near_and_budgets_nest(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", "abcd"[i * i % 4], 0) for i in range(4000)]
    df = edge_docs(spark, rows=rows)
    some, more = ({r["doc_id"]: (r["copies"], r["target"], r["source_size"]) for r in mixing.mix_sources(df, share=x).collect()} for x in (0.4, 0.6))
    assert all(more[i][0] >= some[i][0] for i in some)
    assert [r for r in mixing.mix_sources(df).orderBy("doc_id").collect()] == [r for r in mixing.mix_sources(df.repartition(5)).orderBy("doc_id").collect()]
