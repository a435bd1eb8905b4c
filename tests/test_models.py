"""Model invariants: probabilities, seeds, persistence, separable data, SMOTE, chains."""

import pytest
from pyspark.sql import functions as F

from colforge.ml import models as ml
from colforge.ml.stack import fit_chain, fit_stack
from colforge.operators.smote import smote
from colforge.session import scratch_path

SF = "/root/testdata/sf0.001"
SMALL = {"numTrees": 10, "maxDepth": 4}


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(i, float(i % 50), float((i * 7) % 13), "a" if i % 50 < 25 else "b") for i in range(400)]
    return spark.createDataFrame(rows, "id int, x double, noise double, y string")


def test_probabilities_sum_to_one_and_separable(toy):
    m = ml.train(toy, "y", ["x", "noise"], **SMALL)
    pred = m.transform(toy)
    s = pred.select((F.col("p_a") + F.col("p_b")).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(s[0] - 1) < 1e-9 and abs(s[1] - 1) < 1e-9
    acc = pred.select(F.avg((F.col("predicted") == F.col("y")).cast("double"))).first()[0]
    assert acc > 0.9


def test_seed_reproduces_and_save_load(spark, toy):
    a = ml.train(toy, "y", ["x", "noise"], seed=5, **SMALL).transform(toy).select("id", "p_a")
    m = ml.train(toy, "y", ["x", "noise"], seed=5, **SMALL)
    path = scratch_path(spark, "test-model")
    m.save(path)
    b = ml.TrainedModel.load(spark, path).transform(toy).select("id", F.col("p_a").alias("p_b"))
    j = a.join(b, "id")
    assert j.where(F.abs(F.col("p_a") - F.col("p_b")) > 1e-12).count() == 0


def test_depth_is_clipped():
    with pytest.warns(UserWarning):
        assert ml.clip_depth(37) == 30


def test_compat_names(toy):
    m = ml.train(toy, "y", ["x"], **SMALL)
    out = ml.compat_columns(m.transform(toy), "y", m.classes)
    r = out.select("y_ML", "p_a").first()
    assert r.y_ML == r.p_a  # the forest's compat column is P(class 0)


def test_stacking_level1_rows_disjoint(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", (F.col("o_custkey") % 10).cast("double").alias("c"))
    model, held = fit_stack(o, "o_orderstatus", ["o_orderkey"], ["o_totalprice", "c"],
                            level0={"f": ("forest", SMALL)}, level1=SMALL)
    assert held.count() > 0
    assert all(c in model.level0_cols for c in ["f_p_F", "f_p_O", "f_p_P"])


def test_chain_adds_predictions(spark, toy):
    df = toy.withColumn("y2", F.when(F.col("x") > 30, "hi").otherwise("lo"))
    chain = fit_chain(df, ["y", "y2"], ["x", "noise"], **SMALL)
    out = chain.transform(toy.select("id", "x", "noise"))
    assert set(["y_pred", "y2_pred"]) <= set(out.columns) and out.count() == 400


def test_smote_counts_and_segments(spark):
    rows = [(i, "maj" if i < 60 else "min", float(i), float(i % 7)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, y string, a double, b double")
    out = smote(df, "y", "id", ["a", "b"], k=3)
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {"maj": 60, "min": 60}
    synth = out.where("synthetic = 1")
    base = df.select(F.col("id").cast("string").alias("parent"), F.col("a").alias("pa"))
    # every synthetic point lies within the minority range of the parent's neighbourhood
    j = synth.join(base, "parent")
    assert j.where((F.col("a") < 60) | (F.col("a") > 79)).count() == 0


def test_exact_knn_matches_brute_force(spark):
    from colforge.operators.smote import nearest_neighbours
    import math
    import random
    rnd = random.Random(3)
    pts = [(i, "c", [rnd.random() * 10, rnd.random() * 10, rnd.random()]) for i in range(60)]
    x = spark.createDataFrame(pts, "id int, y string, _v array<double>")
    got = {}
    for r in nearest_neighbours(x, "y", "id", 4).collect():
        got.setdefault(r.id, set()).add(r.nb_key)
    for i, _, v in pts:
        d = sorted((math.dist(v, w), j) for j, _, w in pts if j != i)
        assert got[i] == {j for _, j in d[:4]}


def test_grid_search_scores(spark, toy):
    from colforge.ml.tuning import SCORES, grid_search
    model, metrics = grid_search(toy, "y", ["id"], ["x", "noise"], grid={"maxDepth": [2, 4]}, folds=3,
                                 metric="f1_macro", fixed={"numTrees": 5})
    rows = metrics.collect()
    assert len(rows) == 2 and all(c in metrics.columns for c in SCORES)
    assert all(abs(r.f1_macro - r.refit_score) < 1e-9 for r in rows)
    assert model.transform(toy).count() == 400


def test_transform_returns_the_callers_columns_unchanged(spark, toy):
    m = ml.train(toy.withColumn("c", F.lit("k")), "y", ["x", "noise"], ["c"], **SMALL)
    rows = [(1, None, 2.0, None, "i", 0.5, "f"), (2, float("nan"), None, "k", "j", 0.7, "g")]
    df = spark.createDataFrame(rows, "id int, x double, noise double, c string, home_idx string, p_home double, features string")
    out = m.transform(df)
    assert out.columns == [*df.columns, "prediction", "p_a", "p_b", "predicted"]
    assert [str(tuple(r)) for r in out.select(*df.columns).orderBy("id").collect()] == [str(r) for r in rows]


def test_boosted_and_perceptron_grids_and_three_classes(spark):
    from colforge.ml.tuning import grid_search
    rows = [(i, float(i % 30), "abc"[i % 30 // 10]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, y string")
    m = ml.train(df, "y", ["x"], kind="boosted", maxIter=3, maxDepth=2)
    out = m.transform(df)
    total = out.select((F.col("p_a") + F.col("p_b") + F.col("p_c")).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(total[0] - 1) < 1e-9 and abs(total[1] - 1) < 1e-9
    assert out.where("predicted = y").count() > 270
    for kind, grid in (("boosted", {"maxIter": [1, 2]}), ("perceptron", {"maxIter": [5, 10]})):
        _, metrics = grid_search(df, "y", ["id"], ["x"], kind=kind, grid=grid, folds=2)
        assert metrics.count() == 2


def test_confusion_scores_match_the_operators(spark):
    from colforge.ml.tuning import confusion_scores
    from colforge.operators.evaluate import accuracy, macro_scores
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0)], "_cf_label double, prediction double")
    got, macro = confusion_scores(df), macro_scores(df, "_cf_label", "prediction").first()
    assert abs(got["accuracy"] - accuracy(df, "_cf_label", "prediction").first()["accuracy"]) < 1e-12
    assert all(abs(got[k] - macro[k]) < 1e-12 for k in ("precision_macro", "recall_macro", "f1_macro"))


def test_stacks_and_chains_survive_storing(spark):
    from colforge.ml.stack import ChainModel, StackedModel
    rows = [(i, float(i % 20), float(i % 7), "ab"[i % 20 // 10], i % 20 // 5) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, z double, y string, w int")
    stack, _ = fit_stack(df, "y", ["id"], ["x", "z"], level0={"f": ("forest", SMALL)}, level1=SMALL)
    chain = fit_chain(df, ["y", "w"], ["x", "z"], **SMALL)
    for model, kind in ((stack, StackedModel), (chain, ChainModel)):
        path = scratch_path(spark, "test-stored")
        model.save(path)
        a = [tuple(r) for r in model.transform(df.drop("y", "w")).orderBy("id").collect()]
        b = [tuple(r) for r in kind.load(spark, path).transform(df.drop("y", "w")).orderBy("id").collect()]
        assert a == b


def test_prediction_fits_nothing(spark, monkeypatch):
    from colforge.plans import matches
    from colforge.plans.catalog import models as catalog
    root = scratch_path(spark, "test-matches")
    raw, ht = catalog.fixtures_raw(spark, SF), catalog.halftime_table(spark, SF)
    common = {"ids": catalog.IDS, "scores": catalog.SCORES, "probas": catalog.PROBAS, "stacked": False}
    matches.fit_matches(raw.where("event_date < '2000-06-01'"), ht, ["TeamNWin"], catalog._FIX_FEATS, root, params=SMALL, **common)
    monkeypatch.setattr(matches, "train", None)
    monkeypatch.setattr(matches, "fit_dictionary", None)
    out = matches.predict_matches(raw.where("event_date >= '2000-06-01'"), ht, ["TeamNWin"], catalog._FIX_FEATS, root, raw_columns=["event_date"], **common)
    assert {"TeamNWin_call", "TeamNWin_p_0", "event_date", "fixture_id"} <= set(out.columns)
    assert out.count() == out.select("fixture_id").distinct().count() > 0


def test_networks_are_balanced_by_exact_replication(spark):
    import random
    rnd = random.Random(4)
    rows = [(i, "rare" if i % 10 == 0 else "often", rnd.gauss(1.2 if i % 10 == 0 else 0.0, 1.0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, y string, x double")
    weighted = df.withColumn("l", (F.col("y") == "rare").cast("double")).withColumn("w", F.when(F.col("y") == "rare", 5.0).otherwise(1000 / 1800))
    again = ml.replicate_by_weight(weighted, "l", "w", ["x"])
    assert {r["l"]: r["count"] for r in again.groupBy("l").count().collect()} == {1.0: 500, 0.0: 500}
    assert {r["count"] for r in again.where("l = 1").groupBy("id").count().collect()} == {5}
    same = spark.createDataFrame([("a", 1.0)] * 7 + [("b", 1.0)], "l string, x double").withColumn("w", F.when(F.col("l") == "a", 8 / 14).otherwise(4.0))
    assert {r["l"]: r["count"] for r in ml.replicate_by_weight(same, "l", "w", ["x"]).groupBy("l").count().collect()} == {"a": 4, "b": 4}
    recall = {}
    for balanced in (True, False):
        pred = ml.train(df, "y", ["x"], kind="perceptron", balanced=balanced, layout=[4], maxIter=60).transform(df)
        recall[balanced] = pred.where("y = 'rare'").select(F.avg((F.col("predicted") == "rare").cast("double"))).first()[0]
    assert recall[True] > 0.6 > 0.4 > recall[False]


def test_all_named_networks_have_widths():
    from colforge.presets import MLP_LAYOUTS
    named = [k for k in MLP_LAYOUTS if k.startswith("model_")]
    assert len(named) == 22 and all(MLP_LAYOUTS[k] for k in named)


def _observe(spark):
    """Once a session has observed a frame, it cannot be sent to tasks."""
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}


def test_models_of_two_classes_score_without_the_session(spark, toy):
    _observe(spark)
    df = toy.withColumn("y2", F.when(F.col("x") > 30, "hi").otherwise("lo"))
    chain = fit_chain(df, ["y", "y2"], ["x", "noise"], **SMALL)
    out = chain.transform(toy.select("id", "x", "noise"))
    assert out.where("y2_pred is not null").count() == 400
    assert not any(m.pipeline.stages[-1].hasSummary for m in chain.models)


def test_stack_and_grid_of_two_classes_after_observing(spark, toy):
    from colforge.ml.tuning import grid_search
    _observe(spark)
    level0 = {"forest": ("forest", SMALL), "mlp": ("perceptron", {"layout": "small", "maxIter": 2})}
    model, held = fit_stack(toy, "y", ["id"], ["x", "noise"], level0=level0, level1=SMALL)
    assert held.where("predicted in ('a', 'b')").count() == held.count() > 0
    assert model.transform(toy).where("predicted in ('a', 'b')").count() == 400
    _, metrics = grid_search(toy, "y", ["id"], ["x", "noise"], grid={"maxDepth": [2]}, folds=2, fixed={"numTrees": 3})
    assert metrics.count() == 1


def test_class_weights_do_not_shuffle_the_rows(spark):
    from colforge.operators.profile import with_class_weights
    # an estimate of 400 MB: the weights of the classes are not taken for a large table
    big = spark.range(50_000_000).select("id", F.when(F.col("id") % 4 == 0, 0.0).when(F.col("id") % 4 < 3, 1.0).alias("y"))
    out = with_class_weights(big, "y")
    parts = out.where("id < 1000").groupBy(F.col("y"), F.col("weight")).count().collect()
    assert {(r.y, r.weight and round(r.weight, 12), r["count"]) for r in parts} == {(0.0, 1.5, 250), (1.0, 0.75, 500), (None, None, 250)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_training_rows_are_dealt_into_bounded_partitions(spark, monkeypatch):
    df = spark.range(1000).select("id", (F.col("id") % 50).cast("double").alias("x"),
                                  F.when(F.col("id") % 50 < 25, "a").otherwise("b").alias("y")).coalesce(2)
    assert ml.partitions_wanted(df) is None and ml.partitions_wanted(df.where("id < 0")) is None
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 150)
    assert ml.partitions_wanted(df) == 7
    seen = []
    fit = ml.fit_detached
    monkeypatch.setattr(ml, "fit_detached", lambda e, data: seen.append(
        [r["n"] for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]) or fit(e, data))
    for kind, params in (("forest", SMALL), ("perceptron", {"maxIter": 2})):
        m = ml.train(df, "y", ["x"], kind=kind, **params)
        assert m.transform(df).where("predicted is not null").count() == 1000
    assert all(sum(n) == 1000 and max(n) <= 150 for n in seen) and len(seen) == 2


def test_rows_of_a_network_are_shared_by_tasks_that_a_forest_takes_in_one(spark, monkeypatch):
    df = spark.range(45_000).select("id", (F.col("id") % 50).cast("double").alias("x"),
                                    F.when(F.col("id") % 50 < 25, "a").otherwise("b").alias("y")).coalesce(1)
    seen = []
    fit = ml.fit_detached
    monkeypatch.setattr(ml, "fit_detached", lambda e, data: seen.append(
        [r["n"] for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]) or fit(e, data))
    for kind, params in (("forest", {"numTrees": 1, "maxDepth": 2}), ("perceptron", {"maxIter": 1})):
        assert ml.train(df, "y", ["x"], kind=kind, balanced=False, **params).transform(df).count() == 45_000
    assert seen[0] == [45_000]
    assert sum(seen[1]) == 45_000 and max(seen[1]) <= 20_000
