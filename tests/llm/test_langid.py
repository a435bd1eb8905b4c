import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from colforge.llm import langid
from colforge.llm import queries as Q

from .helpers import edge_docs, edge_rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = Q.op9_language_id(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in out) / len(out) > 0.98


def brute_phrases(codes, known):
    """Greedy longest matches by plain substring search."""
    known = bytes(known)
    n = 0
    for a in range(0, max(1, len(codes)), langid.SEGMENT):
        part, at = bytes(codes[a:a + langid.SEGMENT]), 0
        n += 1
        while at < len(part):
            size = 0
            while at + size < len(part) and part[at:at + size + 1] in known:
                size += 1
            at += max(size, 1)
            n += at < len(part)
    return n


def test_phrases_match_substring_search():
    rng = np.random.default_rng(1)
    train = [rng.integers(1, 6, n).astype(np.uint8) for n in (300, 50, 1)]
    model = langid.Model(["a", "b", "c"], np.zeros(0), [langid.dense(langid.suffix_automaton(t.tolist())) for t in train], np.ones(3))
    texts = [rng.integers(1, 7, n).astype(np.uint8) for n in (1, 2, 255, 256, 257, 700, 3000)]
    got = langid.count_phrases(texts, model)
    for i, x in enumerate(texts):
        for k, t in enumerate(train):
            # a letter unknown at the root is a phrase of its own, and the walk goes on behind it
            assert abs(got[i, k] - brute_phrases(x, t)) <= (x == 6).sum() + (0 if 6 in x or not set(x) <= set(t) else 0) + sum(int(c) not in set(t.tolist()) for c in x)
            if set(x.tolist()) <= set(t.tolist()):
                assert got[i, k] == brute_phrases(x, t)


def test_edge_rows(spark):
    df = edge_docs(spark)
    model = langid.learn(df)
    assert model.languages == sorted({r[2] for r in edge_rows() if r[0] is not None and r[2] and r[1] and zlib.crc32(str(r[0]).encode()) % 5 and len(r[1]) <= 20_000 and any(c.isalpha() for c in r[1])})
    out = langid.identify_languages(df, model)
    assert out.columns == df.columns
    for r in out.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["language"]["lang"] == "und") == (not letters)
        assert letters or r["language"]["score"] == 0
    assert langid.identify_languages(df.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    df = edge_docs(spark, rows=[(1, "some text", None, "a", 1)])
    model = langid.learn(df)
    assert langid.identify_languages(df, model).first()["language"]["lang"] == "und"
    one = langid.learn(edge_docs(spark, rows=[(i, "some text here", "en", "a", 1) for i in range(10)]))
    assert langid.identify_languages(df, one).first()["language"]["lang"] == "en"


def test_labels_and_ids_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    some = docs.limit(100)
    a = langid.identify_languages(some, model).select("text", "language").collect()
    b = langid.identify_languages(some.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.lit(0)), model).select("text", "language").collect()
    assert a == b


def test_long_words_and_odd_text(spark):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    codes = [langid.classes_of(t, model.classes) for t in ("a" * 100_000, "日本語" * 10, "1 2 3", "\ud800x")]
    cost = langid.count_phrases(codes, model)
    assert np.isfinite(cost).all() and cost[0].min() > 1000
    assert math.isclose(model.bits.min(), model.bits.max(), rel_tol=0.1)


def test_long_texts_and_rare_letters_are_learned(spark):
    rows = [(i, "some plain text of the day " * 5, "en", "a", 1) for i in range(30)]
    rows += [(100 + i, "7 " * 15_000 + "dette er en lang bog om havet " * 2_000, "da", "b", 1) for i in range(5)]  # all too long
    rows += [(200 + i, "1 2 3" if i else "kukka on kaunis", "fi", "c", 1) for i in range(4000) if i or zlib.crc32(b"200") % 5]
    rows += [(5000 + i, "1 2 3" if i else "kukka on kaunis", "fi", "c", 1) for i in range(5)]
    rows += [(9001, "ein Satz steht hier", "de", "d", 1)] * 20_000  # one row repeated: drawn whole or not at all
    model = langid.learn(edge_docs(spark, rows=rows, clashes=False))
    assert model.languages == ["da", "de", "en", "fi"]
    docs = edge_docs(spark, clashes=False, rows=[(1, "en bog om havet", None, "a", 1), (2, "kukka", None, "a", 1), (3, "some plain text", None, "a", 1)])
    assert [r["language"]["lang"] for r in langid.identify_languages(docs, model).orderBy("doc_id").collect()] == ["da", "fi", "en"]


def test_scripts_of_many_letters(spark):
    rng = np.random.default_rng(5)
    blocks = {"han1": (0x4E00, 600), "han2": (0x5800, 600), "hangul": (0xAC00, 500), "hindi": (0x905, 50)}
    words = {k: ["".join(chr(a + int(i)) for i in rng.integers(0, n, 2)) for _ in range(800)] for k, (a, n) in blocks.items()}
    text = lambda k: "".join(rng.choice(words[k], 150)) if k.startswith("han1") or k == "han2" else " ".join(rng.choice(words[k], 150))
    rows = [(i, text(k), k, "a", 1) for i, k in enumerate(list(blocks) * 60)]
    model = langid.learn(edge_docs(spark, rows=rows, clashes=False))
    assert model.languages == sorted(blocks)
    assert {t.keys is not None for t in model.tables} == {True, False}
    new = [(i, text(k), k, "a", 1) for i, k in enumerate(list(blocks) * 10)]
    greek = [(100 + i, "".join(chr(0x3B1 + int(j)) for j in rng.integers(0, 17, 200)), None, "a", 1) for i in range(5)]
    out = langid.identify_languages(edge_docs(spark, rows=new + greek, clashes=False), model).collect()
    assert all(r["language"]["lang"] == r["lang"] and r["language"]["accepted"] for r in out if r["lang"])
    assert not any(r["language"]["accepted"] for r in out if not r["lang"])  # a script that nobody taught


def test_marks_and_case():
    classes = langid.letter_classes(["कि की สวัสดี ſ strasse"])
    assert len(langid.classes_of("कि", classes)) == 2 and (langid.classes_of("कि", classes) >= langid.FIRST).all()
    assert not np.array_equal(langid.classes_of("कि", classes), langid.classes_of("की", classes))
    assert np.array_equal(langid.classes_of("STRASSE", classes), langid.classes_of("strasse", classes))


def test_hash_table_is_the_dense_table():
    rng = np.random.default_rng(2)
    step = langid.suffix_automaton(rng.integers(3, 40, 4000).tolist())
    models = [langid.Model(["a"], np.zeros(0), [langid.Automaton(step, wide)], np.ones(1)) for wide in (False, True)]
    texts = [rng.integers(1, 60, n).astype(np.uint16) for n in (1, 300, 5000)]
    assert np.array_equal(*[langid.count_phrases(texts, m) for m in models])


def test_short_texts_are_accepted(spark):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    rng = np.random.default_rng(3)
    noise = "".join(chr(97 + int(i)) for i in rng.integers(0, 26, 400))
    texts = {"A.": True, "x": True, "Qz": True, "xqj": True, "the": True, "я": False, "日本": False, "日本語" * 30: False, noise: False, "12 .": False}
    docs = edge_docs(spark, clashes=False, rows=[(i, t, None, "a", 1) for i, t in enumerate(texts)])
    got = {r["text"]: r["language"]["accepted"] for r in langid.identify_languages(docs, model).collect()}
    assert got == texts


def test_texts_have_equal_shares_of_the_sample():
    texts = ["a" * 1000, "b" * 10, "c" * 500, "d" * 300]
    assert [len(t) for t in langid.equal_pieces(texts, 700)] == [230, 10, 230, 230]
    assert [len(t) for t in langid.equal_pieces(texts, 5000)] == [1000, 10, 500, 300]
    assert [len(t) for t in langid.equal_pieces(["x"] * 9, 4)] == [1] * 9 and langid.equal_pieces([], 4) == []


def test_one_long_text_is_not_the_model_of_its_language(spark):
    rows = [(i, f"la casa de {w} y el perro del vecino come pan en la calle", "es") for i, w in enumerate(["ana", "luis", "eva", "juan", "rosa", "pepe"] * 6)]
    rows += [(100 + i, f"the house of {w} and the dog of the neighbour eats bread in the street", "en") for i, w in enumerate(["ann", "bob", "eve", "jim", "sue", "joe"] * 6)]
    rows += [(500, "xyzzy plugh qwfp zxcv " * 3000, "en"), (501, "xyzzy plugh qwfp zxcv " * 3000, "es")]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), chars_per_language=4000)
    found = spark.createDataFrame([("the dog of the house eats in the street",), ("el perro de la casa come en la calle",)], "text string")
    assert [r["language"]["lang"] for r in langid.identify_languages(found, model).collect()] == ["en", "es"]
