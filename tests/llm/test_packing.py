import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from colforge.llm import packing
from colforge.llm import queries as Q

from .helpers import SF, edge_docs, edge_rows

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [0]


def check(docs, rows, capacity=2048):
    want = []
    for i, text in docs:
        x = ids(text)
        first = (len(x) - 1) % capacity + 1
        cuts = [0, *range(first, len(x) + 1, capacity)]
        want += [(str(i), k, a, b - a, zlib.crc32(np.array(x[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs), -(-sum(r["length"] for r in rows) // capacity)


def test_pieces_and_places(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    n, least = check(docs, Q.op6_packing(spark, SF).collect())
    assert n <= 1.01 * least + 1


def test_edge_rows(spark):
    rows = edge_rows() + [(20, "a <|endoftext|> b", "en", "a", 1), (21, "  x \x1c y  z\t q ' s it's  'll \n\n a ", "en", "a", 1), (22, "a \x85y \xa0z  b", "en", "a", 1)]
    df = edge_docs(spark, rows=rows)
    check([r[:2] for r in rows], packing.pack_documents(df, Q.read_tokenizer()).collect())
    assert packing.pack_documents(df.limit(0), Q.read_tokenizer()).count() == 0


def test_other_tokenizers_take_the_library():
    name = "word_bpe_49k.json"
    encode = packing.id_encoder(Q.read_tokenizer(name))
    t = Tokenizer.from_file(public_tokenizers.path(name))
    assert encode("Hello, World it's").tolist() == t.encode("Hello, World it's", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_and_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    count = np.zeros(257, dtype=np.int64)
    kind = [rng.integers(1, 257, 4000), rng.integers(86, 130, 3000), rng.geometric(0.02, 5000).clip(1, 256), np.full(999, 129), rng.integers(100, 101, 5), np.array([256, 1])][seed]
    np.add.at(count, kind, 1)
    plan = packing.round_plan(count, packing.solve_configurations(count, 256), 256)
    held = np.zeros_like(count)
    for conf, n in plan:
        assert sum(conf) <= 256 and n > 0
        for length in conf:
            held[length] += n
    assert (held == count).all()
    least = max(-(-int((count * np.arange(257)).sum()) // 256), int(count[129:].sum()))
    if seed == 1:  # two of these at most fill a sequence
        least = -(-int(count.sum()) // 2)
    assert sum(n for _, n in plan) <= 1.02 * least + 2


def test_knapsack_matches_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 20, 5))
        price = rng.random(len(lengths))
        best, _ = packing.price_table(lengths, price, 30)
        want = [0.0] * 31
        for room in range(1, 31):
            want[room] = max([want[room - 1]] + [want[room - k] + p for k, p in zip(lengths, price) if k <= room])
        assert best == pytest.approx(want)
