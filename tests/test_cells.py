"""Chains of forests that are fitted and applied over cells of binned features."""

import pytest
from pyspark.sql import functions as F

from colforge.ml import cells, models
from colforge.ml.stack import ChainModel, fit_chain
from colforge.session import scratch_path

SMALL = {"numTrees": 10, "maxDepth": 4}


@pytest.fixture
def many(spark, monkeypatch):
    """6,000 rows of 100 values of x, 13 of z (some missing), two labels, some missing."""
    monkeypatch.setattr(cells, "CELL_ROWS", 5_000)
    x, z = F.col("id") % 100, F.col("id") % 13
    return spark.range(6_000).select(
        "id", x.cast("double").alias("x"), F.when(z > 0, z.cast("double")).alias("z"),
        F.when(F.col("id") % 50 > 0, F.when(x < 50, "lo").otherwise("hi")).alias("y"),
        F.when(F.col("id") % 70 > 0, F.floor(x / 25).cast("int")).alias("w"))


def _seen(monkeypatch):
    sizes, fit = [], models.fit_detached

    def counted(learner, data):
        sizes.append(data.count())
        return fit(learner, data)

    for m in (cells, models):
        monkeypatch.setattr(m, "fit_detached", counted)
    return sizes


def test_chain_of_many_rows_is_fitted_on_cells(many, monkeypatch):
    sizes = _seen(monkeypatch)
    chain = fit_chain(many, ["y", "w"], ["x", "z"], **SMALL)
    assert max(sizes) <= 1_500 < 6_000  # rows before
    assert [m.numeric for m in chain.models] == [["x", "z"], ["x", "z", "y_pred"]]
    assert [m.classes for m in chain.models] == [["hi", "lo"], ["0", "1", "2", "3"]]
    assert [m.pipeline.stages[-1].getNumTrees for m in chain.models] == [10, 10]
    assert all(m.pipeline.stages[-1].totalNumNodes > 10 for m in chain.models)
    assert not any("Categorical" in m.pipeline.stages[-1].toDebugString or " in {" in m.pipeline.stages[-1].toDebugString for m in chain.models)
    out = chain.transform(many.withColumns({"a": F.col("y"), "b": F.col("w")}))
    assert out.columns == ["id", "x", "z", "a", "b", "y_pred", "w_pred"] and out.count() == 6_000
    right = out.agg(F.avg((F.col("y_pred") == (F.col("a") == "lo").cast("int")).cast("int")), F.avg((F.col("w_pred") == F.col("b")).cast("int"))).first()
    assert right[0] > 0.97 and right[1] > 0.95


def test_few_rows_are_fitted_as_they_are(many, monkeypatch):
    monkeypatch.setattr(cells, "CELL_ROWS", 6_001)
    sizes = _seen(monkeypatch)
    chain = fit_chain(many, ["y", "w"], ["x", "z"], **SMALL)
    assert sizes == [5_880, 5_914] and not any(type(s).__name__ == "Bucketizer" for m in chain.models for s in m.pipeline.stages)


def test_almost_as_many_cells_as_rows_are_fitted_as_rows(spark, monkeypatch):
    monkeypatch.setattr(cells, "CELL_ROWS", 1_000)
    df = spark.range(1_500).select(*[(F.xxhash64("id", F.lit(i)) % 1_000).cast("double").alias(f"x{i}") for i in range(3)], (F.col("id") % 2).alias("y"))
    sizes = _seen(monkeypatch)
    fit_chain(df, ["y"], ["x0", "x1", "x2"], **SMALL)
    assert sizes == [1_500]


def test_draws_of_a_cell_add_up_to_those_of_its_rows(many):
    counts = many.groupBy("y", "w").count().collect()
    bins = cells.fit_bins(many, ["x", "z"], ["y", "w"], counts, 32, 2)
    assert cells.grid_size(bins) == 100 * 13
    found = cells.with_draws(cells.count_cells(many, bins, ["x", "z"], ["y", "w"]), bins, ["y", "w"], 50, 2)
    total = found.agg(F.sum("_cf_n"), F.sum(F.aggregate("_cf_draws", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()
    assert total[0] == 6_000 and abs(total[1] / 50 / 6_000 - 1) < 0.02
    spread = found.select("_cf_n", F.explode("_cf_draws").alias("d")).agg(F.avg((F.col("d") - F.col("_cf_n")) ** 2 / F.col("_cf_n"))).first()[0]
    assert abs(spread - 1) < 0.1  # variance of a Poisson number is its mean
    again = cells.with_draws(cells.count_cells(many.repartition(3), bins, ["x", "z"], ["y", "w"]).repartition(3), bins, ["y", "w"], 50, 2)
    assert found.exceptAll(again).count() == again.exceptAll(found).count() == 0


def test_stored_chain_of_cells_predicts_the_same(spark, many):
    chain, path = fit_chain(many, ["y", "w"], ["x", "z"], **SMALL), scratch_path(spark, "test-cells")
    chain.save(path)
    a, b = (sorted(map(tuple, c.transform(many.drop("y", "w")).select("id", "y_pred", "w_pred").collect())) for c in (chain, ChainModel.load(spark, path)))
    assert a == b


def test_split_points_follow_the_tree_learner():
    assert cells.split_points([1.0, 1.0, 2.0, 4.0], [1.0] * 4, 32) == [1.5, 3.0]
    assert cells.split_points([7.0, 7.0], [1.0] * 2, 32) == []
    at = cells.split_points(list(range(1_000)), [1.0] * 1_000, 4)
    assert len(at) == 3 and all(abs(a - b) <= 2 for a, b in zip(at, (250, 500, 750)))
    heavy = cells.split_points(list(range(1_000)), [1_000.0 if i == 10 else 1.0 for i in range(1_000)], 4)
    assert {9.5, 10.5} & set(heavy)
    assert cells.split_points([float("-inf"), 0.0, float("inf")], [1.0] * 3, 32) == []


def test_rows_weigh_by_their_labels():
    found = cells.label_weights([("a", 1, 30), ("b", 1, 10), ("b", None, 20)], ["y", "w"])
    assert found == {("a", 1): 1.0, ("b", 1): 1.0, ("b", None): 0.5}


def test_chain_scores_cells_as_it_scores_rows(many, monkeypatch):
    chain = fit_chain(many, ["y", "w"], ["x", "z"], **SMALL)
    odd = many.select("id", (F.col("x") * 1.37 - 20).alias("x"), F.when(F.col("id") % 3 > 0, F.col("z") * 2).otherwise(F.lit(float("nan"))).alias("z"))
    odd = odd.union(odd.limit(5)).union(odd.selectExpr("id", "CAST(NULL AS DOUBLE)", "CAST('Infinity' AS DOUBLE)").limit(5))
    fast = chain.transform(odd)
    assert "_cf_cell" in fast._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr("colforge.ml.stack.shared_bins", lambda models: None)
    slow = chain.transform(odd)
    assert fast.columns == slow.columns and fast.schema == slow.schema
    assert fast.exceptAll(slow).count() == slow.exceptAll(fast).count() == 0 and fast.count() == 6_010
