import numpy as np
import pytest
from pyspark.sql import functions as F

from colforge.operators import neighbours as nn


def brute(rows, k, weight=0.0):
    """``(key, label, vector, categories)``: every pair of a class."""
    out = []
    for a, la, va, ca in rows:
        d = sorted((float(np.square(np.subtract(va, vb)).sum()) + weight * sum(x != y for x, y in zip(ca, cb)), b) for b, lb, vb, cb in rows if lb == la and b != a)
        out += [(a, i + 1, b) for i, (_, b) in enumerate(d[:k])]
    return sorted(out)


def make(n=300, d=4, seed=0, classes=("a", "b", None)):
    """Clusters, repeated points and points on a grid, so that distances tie."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 20
    rows = []
    for i in range(n):
        v = np.round(centres[i % 6] + rng.normal(size=d), 1) if i % 4 else np.round(rng.normal(size=d))
        rows.append((i, classes[0] if i % 3 else classes[1 + i % 2], v.tolist(), [str(i % 2), str(i % 5)]))
    return rows


@pytest.mark.parametrize("weight", [0.0, 4.0])
@pytest.mark.parametrize("block_rows", [20, 512])
def test_equal_to_brute_force(spark, weight, block_rows):
    rows = make()
    df = spark.createDataFrame(rows, "id int, y string, _v array<double>, _cat array<string>")
    if not weight:
        df = df.drop("_cat")
    got = nn.nearest_neighbours(df, "y", "id", 4, weight=weight, block_rows=block_rows, pivots=8)
    assert sorted(tuple(r) for r in got.select("id", "nb_rank", "nb_key").collect()) == brute(rows, 4, weight)
    vectors = {r[0]: r[2] for r in rows}
    assert all(r["nb_v"] == vectors[r["nb_key"]] for r in got.collect())


def test_classes_of_few_rows_and_equal_points(spark):
    rows = [(i, "a", [1.0, 1.0], ["x"]) for i in range(60)] + [(100, "b", [0.0, 0.0], ["x"]), (101, "b", [3.0, 4.0], ["x"]), (102, "c", [0.0, 0.0], ["x"])]
    df = spark.createDataFrame(rows, "id int, y string, _v array<double>, _cat array<string>").drop("_cat")
    got = nn.nearest_neighbours(df, "y", "id", 3, block_rows=16)
    assert sorted(tuple(r) for r in got.select("id", "nb_rank", "nb_key").collect()) == brute(rows, 3)
    assert nn.nearest_neighbours(df.limit(0), "y", "id", 3).count() == 0


def test_fewer_than_half_of_the_pairs_of_diffuse_rows_are_compared(spark, block_rows=nn.BLOCK_ROWS):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("_v"))
    _, lists = nn._neighbour_lists(e, "label", "vec_id", 5, 2, 0.0, nn.PIVOTS, block_rows)
    compared = lists.agg(F.sum("compared")).first()[0]
    pairs = e.groupBy("label").count().agg(F.sum(F.col("count") * (F.col("count") - 1))).first()[0]
    print("compared", compared / pairs)
    assert compared < pairs / 2
    blocks = 1 + max(r["count"] for r in e.groupBy("label").count().collect()) // block_rows * 2
    assert lists.agg(F.max(F.size("nb"))).first()[0] <= 5 and lists.count() <= e.count() * blocks * 2


def test_clusters_leave_most_blocks_alone(spark):
    rng = np.random.default_rng(1)
    v = np.repeat(rng.normal(size=(16, 8)) * 50, 100, axis=0) + rng.normal(size=(1600, 8))
    df = spark.createDataFrame([(i, "a", x.tolist()) for i, x in enumerate(v)], "id int, y string, _v array<double>")
    _, lists = nn._neighbour_lists(df, "y", "id", 5, 2, 0.0, nn.PIVOTS, 50)
    assert lists.agg(F.sum("compared")).first()[0] < 0.1 * 1600 * 1599


def test_rows_visit_a_bounded_number_of_cells(spark):
    """Diffuse rows look into all cells of their class; these grow with the rows, not in number."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(1200, 20))
    df = spark.createDataFrame([(i, "a", x.tolist()) for i, x in enumerate(v)], "id int, y string, _v array<double>")
    _, lists = nn._neighbour_lists(df, "y", "id", 5, 2, 0.0, nn.PIVOTS, 10)
    assert lists.count() <= 1200 * 48


def test_categories_are_part_of_the_bound(spark):
    rows = [(i, "a", [float(i % 97)], [str(i % 3)]) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, y string, _v array<double>, _cat array<string>")
    found, lists = nn._neighbour_lists(df, "y", "id", 4, 2, 1e4, nn.PIVOTS, 64)
    assert sorted(tuple(r) for r in found.select("id", "nb_rank", "nb_key").collect()) == brute(rows, 4, 1e4)
    assert lists.agg(F.sum("compared")).first()[0] < 0.1 * 900 * 899


def test_vectors_with_missing_components_are_left_out(spark):
    rows = make(90)
    df = spark.createDataFrame(rows, "id int, y string, _v array<double>, _cat array<string>").drop("_cat")
    odd = spark.createDataFrame([(1000, "a", [1.0, None, 0.0, 0.0]), (1001, "a", [1.0, float("nan"), 0.0, 0.0]), (1002, "a", None)], df.schema)
    got = nn.nearest_neighbours(df.unionByName(odd), "y", "id", 4, block_rows=20, pivots=8)
    assert sorted(tuple(r) for r in got.select("id", "nb_rank", "nb_key").collect()) == brute(rows, 4)
