import re

from colforge.llm import quality
from colforge.llm import queries as Q

from .helpers import SF, WORD, edge_docs, edge_rows


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    where = {}
    for i, x in enumerate(windows):
        where.setdefault(x, []).append(i)
    covered = {i + k for v in where.values() if len(v) > 1 for i in v for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r[0]: r for r in Q.op1_quality_rules(spark, SF).collect()}
    for r in docs.collect():
        n = brute(r["text"])
        assert tuple(got[r["doc_id"]][1:6]) == n
        assert got[r["doc_id"]]["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (got[r["doc_id"]]["base_failed"] and got[r["doc_id"]]["kept"])


def test_labelled_good_documents_stay_and_junk_goes(spark):
    rows = (Q.op1_quality_rules(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect())
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in good) / len(good) > 0.99
    assert sum(r["kept"] for r in junk) / len(junk) < 0.05


def test_edge_rows_and_clashing_columns(spark):
    df = edge_docs(spark)
    out = quality.apply_quality(df)
    assert out.columns == df.columns  # a column called like the result is replaced in place
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert tuple(r["quality"])[:5] == brute(r["text"])
        assert r["size"] == "own size"
    assert quality.apply_quality(df.limit(0)).count() == 0


def test_verdict_does_not_depend_on_the_order(spark):
    df = edge_docs(spark)
    names = [r.name for r in quality.DEFAULT_RULES]
    kept = [sorted((str(r["doc_id"]), r["quality"]["kept"]) for r in quality.apply_quality(df, order=o).collect()) for o in (names, names[::-1])]
    assert kept[0] == kept[1]


def test_cascade_prefers_rejection_per_cost(spark):
    slow = quality.Rule("slow", lambda d: sum(i * i for i in range(20_000)) < 0)
    often = quality.Rule("often", lambda d: True)
    plan = quality.plan_cascade(edge_docs(spark), rules=(slow, often))
    assert [p["rule"] for p in plan] == ["often", "slow"]
    assert plan[0]["reject"] > plan[1]["reject"] and plan[0]["cost_ns"] < plan[1]["cost_ns"]
    assert quality.plan_cascade(edge_docs(spark).limit(0)) != []


def test_cascade_orders_by_what_the_rules_before_leave(spark):
    """``b`` rejects what ``a`` rejects already, ``c`` fewer but others: by rejection alone b
    comes second, by what is left c does, and the whole cascade costs less."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en", "a", 1) for i in range(400)]
    spin = lambda n: sum(i * i for i in range(n)) < 0
    number = lambda d: int(d.text[1:d.text.index("x")])
    a = quality.Rule("a", lambda d: spin(500) or number(d) % 2 == 0)
    b = quality.Rule("b", lambda d: spin(500) or number(d) % 2 == 0)
    c = quality.Rule("c", lambda d: spin(600) or number(d) % 10 in (1, 3))
    plan = quality.plan_cascade(edge_docs(spark, rows=rows), rules=(a, b, c))
    assert [p["rule"] for p in plan][1] == "c" and plan[2]["rule"] in "ab"
    assert plan[0]["reject"] > plan[1]["reject"] > 0.3 and plan[2]["reject"] < 0.02

    def work(order):
        n = 0
        for r in rows:
            for rule in order:
                n += 1
                if rule.fails(quality.Doc(r[1])):
                    break
        return n

    by_name = {"a": a, "b": b, "c": c}
    assert work([by_name[p["rule"]] for p in plan]) < work([a, b, c])


def test_features_that_are_there_cost_nothing(spark):
    """Two rules read one dear feature: when the first has paid for it the second is cheap, and
    features of the base rule are free for all."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(3000)), "en", "a", 1) for i in range(40)]
    top = quality.Rule("top", lambda d: d.top_word > 1)
    again = quality.Rule("again", lambda d: d.top_word > 2)
    words = quality.Rule("words", lambda d: d.n_repeat_words > 5)
    cost = {p["rule"]: p["cost_ns"] for p in quality.plan_cascade(edge_docs(spark, rows=rows), rules=(top, again, words))}
    first, second = (cost["top"], cost["again"]) if cost["top"] > cost["again"] else (cost["again"], cost["top"])
    assert first > 20 * second and first > 20 * cost["words"]
    assert quality.plan_cascade(edge_docs(spark, rows=[(1, "short", "en", "a", 1)]), rules=(top, words))[0]["reject"] == 0.5
