import random

import pytest
import xxhash
from pyspark.sql import functions as F

from colforge.llm import queries as Q
from colforge.llm import simhash

from .helpers import SF, WORD, components, edge_docs, edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check(rows, texts):
    """rows: (id, fingerprint, component) in any order; texts: (id, text)."""
    texts = sorted(texts, key=lambda t: (t[0] is None, t[0]))
    fps = [brute(t) for _, t in texts]
    root = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    want = sorted((str(i), f"{fp:016x}", str(texts[r][0])) for (i, _), fp, r in zip(texts, fps, root))
    assert sorted((str(a), b, str(c)) for a, b, c in rows) == want


def test_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in Q.op2_simhash(spark, SF).collect()], [tuple(r) for r in docs])


def test_spark_hash_is_the_same(spark):
    text = "Ünï b c"
    assert spark.sql(f"select xxhash64('{text}')").first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_edge_rows(spark):
    rows = simhash.simhash_groups(edge_docs(spark)).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()
    check([tuple(r) for r in rows], [r[:2] for r in edge_rows()])
    assert simhash.simhash_groups(edge_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("max_bucket", [1, 2, 32])
@pytest.mark.parametrize("segments", [3, 7, 10])
def test_links_connect_what_brute_force_connects(spark, max_bucket, segments):
    rnd = random.Random(segments)
    seeds = [rnd.getrandbits(64) for _ in range(12)]
    fps = set(seeds)
    for s in seeds:  # chains and crowds at one, two and three bits
        for _ in range(12):
            s ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 1, 2, 3])))
            fps.add(s)
    fps |= {seeds[0] ^ (1 << b) for b in range(64)}
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.candidate_links(df, segments=segments, max_bucket=max_bucket)
    got = simhash.connected_components(links).collect()
    root = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    want = {}
    for f, r in zip(fps, root):
        want.setdefault(r, set()).add(simhash._signed(f))
    found = {}
    for node, r in got:
        found.setdefault(r, set()).add(node)
    assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_ring_principle():
    rnd = random.Random(1)
    for m in (3, 5, 7, 9):
        masks = simhash.ring(m)
        assert sum(x & (1 << 64) - 1 for x in masks) == (1 << 64) - 1
        for _ in range(300):
            diff = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 2)))
            assert any(all((diff & simhash.chain(masks, i, n) & (1 << 64) - 1).bit_count() <= n * 2 // m for n in range(1, m + 1)) for i in range(m))


def test_drop_near_duplicates(spark):
    df = edge_docs(spark)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    texts = sorted((r[:2] for r in edge_rows()), key=lambda t: (t[0] is None, t[0]))
    root = components([brute(t) for _, t in texts], lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(texts[r][0]) for r in set(root))
    # a shared id with other content is not taken for the one that stays
    rows = [(1, "one two three four five six", "en", "a", 1), (1, "seven eight nine ten eleven twelve", "en", "a", 1), (2, "one two three four five six", "en", "a", 1)]
    assert sorted(r["text"] for r in simhash.drop_near_duplicates(edge_docs(spark, rows=rows)).collect()) == sorted([rows[0][1], rows[1][1]])
