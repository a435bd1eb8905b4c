import corpus_pipeline as P
import pytest

from colforge.session import materialize

from . import test_mixing, test_packing, test_secrets, test_simhash
from .helpers import SF, components, edge_docs, edge_rows


def staged(spark, docs):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name))
    return out


@pytest.fixture(scope="module", params=["tables", "edge"])
def frames(spark, request):
    if request.param == "tables":
        return staged(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    prose = [(100 + i, f"the cat number {i} sat on a mat and looked at the moon {i * i} times before it went home again to sleep {i}", "en", "abc"[i % 3], 5) for i in range(60)]
    return staged(spark, edge_docs(spark, clashes=False, rows=edge_rows() + prose))


def rows(df):
    return [tuple(r) for r in df.select(*P.COLUMNS).collect()]


def test_columns_stay_until_the_last_stage(frames):
    assert all(f.columns == P.COLUMNS for f in frames[:-1])


def test_language_stage_drops_only_texts_without_letters(frames):
    docs, kept = rows(frames[0]), rows(frames[1])
    want = [r for r in docs if any(c.isalpha() for c in r[1] or "")]
    odd = [r for r in want if r not in kept]
    assert sorted(map(str, kept + odd)) == sorted(map(str, want))
    assert all(sum(c.isascii() and c.isalpha() for c in r[1]) < 0.5 * len(r[1]) for r in odd)  # foreign scripts


def test_dedup_stage_keeps_the_smallest_of_each_group(frames):
    docs = sorted(rows(frames[1]), key=lambda r: (r[0] is None, r[0]))
    root = components([test_simhash.brute(r[1]) for r in docs], lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(str(r[0]) for r in rows(frames[2])) == sorted(str(docs[i][0]) for i in set(root))


def test_secret_stage_masks_and_keeps_documents(frames):
    before, after = {str(r[0]): r for r in rows(frames[2])}, {str(r[0]): r for r in rows(frames[3])}
    assert set(before) == set(after)
    found = {str(b[0]): b[5] for b in test_secrets.brute([(r[0], r[1], r[3]) for r in before.values()])}
    for k, r in after.items():
        text, at = "", 0
        for a, z in sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in found[k].split(",") if x):
            if a >= at:
                text += before[k][1][at:a] + "[SECRET]"
            at = max(at, z)
        assert r[1] == text + before[k][1][at:]
        assert r[4] == (len(r[1]) if found[k] else before[k][4])


def test_mixing_stage_repeats_rows(frames):
    docs = rows(frames[3])
    size, target = test_mixing.brute(docs)
    copies = {}
    for r in rows(frames[4]):
        copies[str(r)] = copies.get(str(r), 0) + 1
    assert set(copies) <= set(map(str, docs)) and max(copies.values(), default=0) <= 2
    got = [type("R", (dict,), {})(doc_id=r[0], size=len(test_mixing.WORD.findall(r[1] or "")), source_size=size[r[3]], target=target[r[3]],
                                  taken=len(test_mixing.WORD.findall(r[1] or "")) * copies.get(str(r), 0)) for r in docs]
    test_mixing.check(docs, got)


def test_packing_stage(frames):
    test_packing.check([r[:2] for r in rows(frames[4])], frames[5].collect())


def test_run(spark):
    assert P.run(spark, SF).count() > 0
