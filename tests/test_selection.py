import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colforge.operators import encode, selection, split
from colforge.operators.ranking import hash_row_number, md5_order, scanned_bytes, target_partitions

SF = "/root/testdata/sf0.001"


@pytest.fixture
def few_keys(monkeypatch):
    """Small tables go through the passes that large ones take."""
    monkeypatch.setattr(selection, "SAMPLE_KEYS", 60)
    monkeypatch.setattr(selection, "READ_KEYS", 40)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("spread", [3, 50, 100_000])
def test_ranks_equal_the_sorted_answer_with_ties_and_nulls(spark, few_keys, spread):
    rng = random.Random(spread)
    values = [None if rng.random() < 0.1 else rng.choice([float("nan"), -0.0, 1e300, float(rng.randrange(spread)), -rng.random()]) for _ in range(3000)]
    df = spark.createDataFrame([(v, f"s{rng.randrange(spread)}", i) for i, v in enumerate(values)], "x double, s string, i int").repartition(4)
    key = selection.order_key(df, ["x", "s"])
    order = [tuple(r) for r in df.orderBy("x", "s").select("x", "s").collect()]
    ranks = [1, 2, 299, 300, 301, 1500, 2999, 3000]
    for t in selection.rows_at_ranks(df, [selection.Target(key, r, 3000) for r in ranks]):
        want = order[t.rank - 1]
        text = lambda r: str(tuple(r)).replace("-0.0", "0.0")  # noqa: E731  the two zeros are one key
        same = [text(r) == text(want) for r in order]
        assert text(t.value) == text(want)
        assert (t.below, t.equal) == (same.index(True), sum(same))


def test_quantiles_equal_numpy(spark, few_keys):
    rng = np.random.default_rng(0)
    x, y = rng.exponential(size=2000), rng.integers(0, 5, 2000).astype(float)
    rows = [(float(a), None if i % 7 == 0 else float(b), None, 4) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (float("nan"), float("nan"), None, 4)], "x double, y double, none double, c int")
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = selection.exact_quantiles(df, ["x", "y", "none", "c"], ps)
    assert got["x"] == pytest.approx(np.quantile(x, ps).tolist(), rel=1e-12)
    assert got["y"] == np.quantile([r[1] for r in rows if r[1] is not None], ps).tolist()
    assert got["none"] == [None] * 7 and got["c"] == [4.0] * 7
    scaled = encode.robust_scale(df, ["x", "none", "c"]).collect()
    assert scaled[0]["x"] == pytest.approx((x[0] - np.median(x)) / np.subtract(*np.quantile(x, [0.75, 0.25])))
    assert scaled[0]["none"] is None and scaled[0]["c"] == 0.0


def test_head_tail_reads_counts_only(spark, few_keys):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    out = split.head_tail_split(orders, ["o_orderdate", "o_orderkey"], 0.8)
    assert "Exchange" not in plan_of(out) and "Sort" not in plan_of(out)
    rows = sorted((r["o_orderdate"], r["o_orderkey"], r["split"]) for r in out.collect())
    cut = int(len(rows) * 0.8)
    assert [r[2] for r in rows] == ["head"] * cut + ["tail"] * (len(rows) - cut)


@pytest.mark.parametrize("ratio", [0.0, 0.001, 0.37, 0.5, 1.0])
def test_head_tail_cuts_through_ties_and_repeated_rows(spark, few_keys, ratio):
    rows = [(i // 400, "a" if i % 2 else None) for i in range(1000)] + [(None, "n")] * 30
    out = split.head_tail_split(spark.createDataFrame(rows, "o int, v string"), ["o"], ratio).collect()
    head = sorted((-1 if r["o"] is None else r["o"]) for r in out if r["split"] == "head")
    every = sorted((-1 if r[0] is None else r[0]) for r in rows)
    assert len(out) == len(rows) and head == every[:int(len(rows) * ratio)]
    assert split.head_tail_split(spark.createDataFrame([], "o int, v string"), ["o"], ratio).count() == 0


def test_times_are_compared_as_instants(spark, few_keys):
    df = spark.range(500).select((F.lit(1_700_000_000) + F.col("id") * 1800).cast("timestamp").alias("ts"), "id")
    out = split.head_tail_split(df, ["ts"], 0.5)
    assert {r["id"] for r in out.where("split = 'head'").collect()} == set(range(250))


def test_hash_row_number_equals_a_window(spark, monkeypatch):
    from colforge.operators import ranking
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 1)  # many prefixes: both levels of running sums
    df = spark.range(3000).select((F.col("id") % 900).alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("c"))
    h = md5_order(["k"], 3)
    for by in ([], ["c"]):
        got = hash_row_number(df, by, h, ["k"])
        assert "rangepartitioning" not in plan_of(got)
        from pyspark.sql import Window
        want = df.withColumn("h", h).withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy("h", "k"))).drop("h")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_split_over_ten_thousand_classes_reads_a_row_a_class(spark, monkeypatch):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 9_999 > 0, F.col("id") % 9_999).alias("c"))
    read = []
    frame = type(df)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (lambda rows: read.append(len(rows)) or rows)(collect(self)))
    out = split.stratified_split(df, "c", ["id"], test_ratio=0.5)
    monkeypatch.undo()
    assert max(read) <= 10_000
    assert out.where("split = 'test'").count() == 30_000
    per = out.groupBy("c").agg(F.count_if(F.col("split") == "test").alias("t"), F.count("*").alias("n")).collect()
    assert all(abs(r["t"] - r["n"] / 2) < 1 for r in per)


def test_partitions_follow_what_is_read_not_the_estimate_of_joins(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey")
    out = li
    for i in range(6):
        out = out.join(li.select(F.col("l_partkey").alias(f"p{i}")), out.l_orderkey == F.col(f"p{i}"))
    import os
    size = os.path.getsize(f"{SF}/lineitem.parquet")
    assert scanned_bytes(out) <= 7 * size and target_partitions(out) == 8


def test_format_fixtures_is_one_pass_of_few_partitions(spark):
    from colforge.plans.catalog import registry
    out = registry()["cl3_format_fixtures"][0](spark, SF)
    plan = plan_of(out)
    assert "Join" not in plan and "Exchange" not in plan
    assert out.rdd.getNumPartitions() <= 64


def test_codes_are_looked_up_without_a_join(spark):
    df = spark.createDataFrame([(1.5, "a", 3, 0.1), (float("nan"), None, 4, 0.25), (-0.0, 'é"x', None, None), (3.5000000000000004, "", 7, 1e300), (0.0, "zz", 3, 5e-324)],
                               "x double, s string, i int, f double")
    df = df.withColumns({"g": F.col("f").cast("float"), "d": F.col("i").cast("decimal(10,2)"), "b": F.col("i") > 3, "t": F.lit("2020-01-01").cast("date")})
    cols = df.columns
    d = encode.fit_dictionary(df, cols)
    a, b = (encode.encode_columns(df, d, cols, suffix="_c", max_lookup_rows=n) for n in (20_000, 0))
    assert "Join" not in plan_of(a) and plan_of(b).count("Join") >= len(cols)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    codes = [f"{c}_c" for c in cols]
    back = d.withColumn("feature", F.concat("feature", F.lit("_c")))
    x, y = (encode.decode_columns(a, back, codes, max_lookup_rows=n) for n in (20_000, 0))
    assert "Join" not in plan_of(x)
    assert sorted(map(str, x.collect())) == sorted(map(str, y.select(x.columns).collect()))
    assert {r["s"] for r in x.select(F.col("s_c").alias("s")).collect()} == {"a", None, 'é"x', "", "zz"}
    part = encode.encode_columns(df, d, cols, suffix="_c", max_lookup_rows=6)  # some looked up, some joined
    assert 0 < plan_of(part).count("Join") < plan_of(b).count("Join")
    assert sorted(map(str, part.select(a.columns).collect())) == sorted(map(str, a.collect()))


def test_unknown_and_sparse_codes(spark):
    d = spark.createDataFrame([("v", "a", 0), ("v", "b", 10), ("v", "not a number", 3)], encode.DICT_SCHEMA)
    df = spark.createDataFrame([("a",), ("b",), ("q",), (None,)], "v string")
    assert [r["v"] for r in encode.encode_columns(df, d, ["v"]).collect()] == [0, 10, -1, None]
    coded = spark.createDataFrame([(0,), (10,), (4,), (None,), (-1,)], "v int")
    assert sorted(str(r["v"]) for r in encode.decode_columns(coded, d, ["v"]).collect()) == sorted(["a", "b", "None", "None", "None"])
    numbers = spark.createDataFrame([(7,)], "v int")
    assert [r["v"] for r in encode.encode_columns(numbers, d, ["v"]).collect()] == [-1]  # no entry is a number
    half = spark.createDataFrame([(0.5,), (1.0,)], "v double")
    dense = spark.createDataFrame([("v", "a", 0), ("v", "b", 1)], encode.DICT_SCHEMA)
    assert [r["v"] for r in encode.decode_columns(half, dense, ["v"]).collect()] == [None, "b"]
