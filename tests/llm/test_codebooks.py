import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from colforge.llm import codebooks
from colforge.llm import queries as Q

from .helpers import CLASHES, SF


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain Lloyd over ``(id, vector, label)``: every part against every entry, in Python
    integers."""
    def ok(v):
        return v and all(x is not None and math.isfinite(x) and abs(x) * scale <= codebooks.MAX_INT for x in v)

    rows = [r for r in rows if ok(r[1])]
    if not rows:
        return [], None
    first = {}
    for i, v, _ in rows:
        first[i] = min(first.get(i, v), v)
    order = sorted(first, key=lambda i: (i is None, i or 0))
    d = len(first[order[0]])
    rows = [r for r in rows if len(r[1]) == d]
    first = {}
    for i, v, _ in rows:
        first[i] = min(first.get(i, v), v)
    order = sorted(first, key=lambda i: (i is None, i or 0))[:entries]
    floor = lambda v: [math.floor(scale * x) for x in v]
    cut = [slice(j * d // parts, (j + 1) * d // parts) for j in range(parts)]
    books = [[floor(first[i])[c] for i in order] for c in cut]
    ints = [floor(v) for _, v, _ in rows]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[c], e)), k) for k, e in enumerate(book)) for c, book in zip(cut, books)] for v in ints]

    for _ in range(rounds):
        got = assign()
        for j, c in enumerate(cut):
            for k in range(len(books[j])):
                mine = [v[c] for v, a in zip(ints, got) if a[j][1] == k]
                if mine:
                    books[j][k] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    by_label = {}
    for (_, _, g), a in zip(rows, got):
        by_label[g] = by_label.get(g, 0) + sum(x for x, _ in a)
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in a), sum(x for x, _ in a), by_label[g]) for (i, _, g), a in zip(rows, got)), sha


def coded(df, **kw):
    rows, books = codebooks.learn_codes(df, "embedding", "vec_id", "label", **kw)
    out = codebooks.with_group_sum(rows.select("k", "g", codebooks.code_text("c").alias("code"), codebooks.error_of("e").alias("error")), "g", "error", "label_error")
    return sorted((str(r["k"]), r["code"], r["error"], r["label_error"]) for r in out.collect()), books.digest() if books else None


def test_query_matches_plain_lloyd(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, sha = brute(rows)
    got = Q.op11_vector_codes(spark, SF).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {sha}


SCHEMA = "vec_id long, embedding array<float>, label int"


def edge_rows():
    rng = np.random.default_rng(3)
    rows = [(100 + i, [float(x) for x in rng.integers(-3, 4, 10) / 4096], i % 3 or None) for i in range(60)]  # many ties
    rows += [(100, rows[0][1], None), (100, rows[0][1], None), (100, rows[1][1], 7), (None, rows[2][1], 2), (None, rows[3][1], None)]
    bad = [None, [], [0.0] * 9 + [None], [0.0] * 9 + [float("nan")], [float("-inf")] + [0.0] * 9, [0.5] * 9, [0.5] * 11, [4e4] + [0.0] * 9]
    return rows + [(i, v, 1) for i, v in enumerate(bad, 200)] + [(99, [], 1), (98, None, 1)]


def test_edge_rows_ties_and_repeats(spark):
    rows = edge_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).select("*", *[F.lit(1).alias(c) for c in [*CLASHES, "k", "g", "v", "c", "e", "x", "part", "sums"] if c != "id"])
    for kw in ({}, {"entries": 3, "rounds": 2}, {"parts": 12}, {"entries": 200, "rounds": 1}, {"rounds": 0}):
        assert coded(df, **kw) == brute([(i, v, g) for i, v, g in rows], **kw), kw
    assert coded(df.limit(0)) == ([], None)
    assert coded(df.where("vec_id >= 200")) == brute([r for r in rows if r[0] and r[0] >= 200])
    assert coded(df.where("vec_id is null")) == brute([r for r in rows if r[0] is None])


def test_one_id_with_most_rows_still_gives_all_entries(spark):
    rows = [(5, [i / 4096, 0.0], 0) for i in range(300)] + [(i, [float(i), 1.0], 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert coded(df, parts=2) == brute(rows, parts=2)


def test_active_scan_equals_complete_scan():
    rng = np.random.default_rng(5)
    x = rng.integers(-4, 5, (500, 3))
    old = rng.integers(-4, 5, (16, 3))
    code, dist = codebooks.scan_all(x, old)
    for k in (0, 1, 5, 16):
        new = old.copy()
        moved = np.sort(rng.permutation(16)[:k])
        new[moved] = rng.integers(-4, 5, (k, 3))
        moved = np.flatnonzero((new != old).any(axis=1))
        got, want = codebooks.scan_active(x, new, moved, code, dist), codebooks.scan_all(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_fixed_parts_are_compared_with_moved_entries_only(monkeypatch):
    seen = []
    real = codebooks.squared_distances
    monkeypatch.setattr(codebooks, "squared_distances", lambda x, e: seen.append((len(x), len(e))) or real(x, e))
    x = np.arange(32).reshape(-1, 1)
    old = np.arange(16).reshape(-1, 1) * 2
    code, dist = codebooks.scan_all(x, old)
    seen.clear()
    new = old.copy()
    new[3] += 1
    codebooks.scan_active(x, new, np.array([3]), code, dist)
    assert seen == [(2, 16), (30, 1)]
