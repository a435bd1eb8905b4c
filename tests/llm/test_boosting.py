import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from colforge.llm import boosting, langid
from colforge.llm import queries as Q

from .helpers import SF, edge_docs, edge_rows


def data(n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 4)).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 2] > 8)).astype(float)
    return x, y


def walk(model, row):
    """Brute force: one row down one tree after another."""
    out = model.base
    for feature, limit, value in zip(model.feature, model.limit, model.value):
        k = 0
        while k < len(feature):
            k = 2 * k + 2 if row[feature[k]] > limit[k] else 2 * k + 1
        out += value[k - len(feature)]
    return out


def test_all_trees_at_once_equal_one_by_one():
    x, y = data()
    model = boosting.fit_trees(x, y, trees=20, depth=3)
    assert np.allclose(model.margin(x), [walk(model, r) for r in x])
    assert boosting.Trees(3, 0.5).margin(x).tolist() == [0.5] * len(x) and model.margin(x[:0]).shape == (0,)


def test_cuts_are_those_of_a_complete_search():
    x, y = data(120)
    rng = np.random.default_rng(2)
    node, grad, hess = rng.integers(0, 3, 120), rng.normal(size=120), rng.uniform(0.1, 1, 120)
    cuts = boosting.bin_limits(x, 64)
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    feature, b, gain = boosting.best_cuts(binned, node, 3, grad, hess, 13, 1.0, 2.0)
    for k in range(3):
        best = -math.inf
        part = lambda rows: grad[rows].sum()**2 / (hess[rows].sum() + 1.0)
        for j in range(x.shape[1]):
            for c in cuts[j]:
                left, right = (node == k) & (x[:, j] <= c), (node == k) & (x[:, j] > c)
                if hess[left].sum() >= 2 and hess[right].sum() >= 2:
                    best = max(best, part(left) + part(right) - part(node == k))
        assert gain[k] == pytest.approx(best)
        left = (node == k) & (x[:, feature[k]] <= cuts[feature[k]][b[k]])
        assert part(left) + part((node == k) & ~left) - part(node == k) == pytest.approx(best)


def test_loss_falls_with_every_tree_and_crossed_rules_are_learned():
    x, y = data(2000)
    losses = []
    for n in (1, 5, 20, 60):
        p = boosting.fit_trees(x, y, trees=n).score(x)
        losses.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    assert losses == sorted(losses, reverse=True)
    fresh, want = data(2000, seed=9)
    assert ((boosting.fit_trees(x, y).score(fresh) >= 0.5) == want).mean() > 0.99


def test_bins_of_many_values_lie_at_quantiles():
    column = np.random.default_rng(1).exponential(size=5000)
    [cuts] = boosting.bin_limits(column[:, None], 16)
    assert len(cuts) == 15
    assert np.histogram(column, [-1, *cuts, 99])[0] == pytest.approx(5000 / 16, rel=0.05)
    assert [len(c) for c in boosting.bin_limits(np.ones((5, 2)), 16)] == [0, 0]


def test_one_class_or_no_rows_give_laplaces_share():
    x, _ = data(8)
    assert boosting.fit_trees(x, np.ones(8)).score(x) == pytest.approx([0.9] * 8)
    assert boosting.fit_trees(x[:0], np.empty(0)).score(x) == pytest.approx([0.5] * 8)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_held_out_documents(spark, sf):
    rows = Q.op13_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    clean, junk = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] for r in clean) / len(clean) > 0.99
    if sf != SF:
        assert sum(r["predicted"] for r in junk) / len(junk) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_edge_rows_and_unused_labels(spark):
    df = edge_docs(spark).withColumn("quality_score", F.lit("own"))
    labels = spark.createDataFrame([(1, 1, "l"), (2, 1, "l"), (2, 0, "l"), (8, 0, "l"), (9, 0, "l"), (11, None, "l"), (None, 1, "l"), (77, 0, "l")],
                                   "doc_id long, quality int, text string")
    model = boosting.learn(df, labels, langid.held_out, trees=5)
    out = boosting.score_texts(df, model)
    assert out.columns == df.columns
    rows = out.collect()
    assert len(rows) == len(edge_rows()) and all(0 < r["quality_score"] < 1 for r in rows)
    empty = model.score(boosting.feature_rows([""]))[0]
    assert {r["quality_score"] for r in rows if not r["text"]} == {empty}
    assert boosting.score_texts(df.limit(0), model).count() == 0
    assert boosting.learn(df, labels.limit(0), langid.held_out).base == 0.0
    used = {r["i"]: r["y"] for r in boosting.learnable(labels, langid.held_out).collect()}
    held = {r["doc_id"] for r in labels.where(langid.held_out("doc_id")).collect()}
    assert used == {i: y for i, y in {1: 1, 2: 1, 8: 0, 9: 0, 77: 0}.items() if i not in held}


def test_statistics_are_finite_and_of_the_whole_text():
    for r in edge_rows():
        v = boosting.statistics(r[1])
        assert len(v) == len(boosting.FEATURES) and np.isfinite(v).all()
    assert boosting.statistics(None) == boosting.statistics("")
    assert boosting.statistics("good words " * 5000 + "###") != boosting.statistics("good words " * 5000 + "abc")


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    seen = []
    fit = boosting.fit_trees
    boosting.fit_trees = lambda x, y, **kw: seen.append(len(x)) or fit(x, y, **kw)
    try:
        boosting.learn(docs, labels, langid.held_out, sample_rows=20, trees=1)
    finally:
        boosting.fit_trees = fit
    assert seen == [20]
