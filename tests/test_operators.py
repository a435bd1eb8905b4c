"""Property tests: exact ranking, splits, undersampling, encoders, joins."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from colforge.operators import balance, encode, joins, split
from colforge.operators.ranking import exact_row_number, md5_order

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_exact_row_number_matches_window(orders):
    df = orders.withColumn("h", md5_order(["o_orderkey"]))
    got = exact_row_number(df, ["o_orderstatus"], ["h", "o_orderkey"], num_partitions=5)
    w = Window.partitionBy("o_orderstatus").orderBy("h", "o_orderkey")
    ref = df.withColumn("rn2", F.row_number().over(w)).select("o_orderkey", "rn2")
    bad = got.join(ref, "o_orderkey").where(F.col("rn") != F.col("rn2")).count()
    assert bad == 0 and got.count() == orders.count()


def test_stratified_split_exact_sizes(orders):
    s = split.stratified_split(orders, "o_orderstatus", ["o_orderkey"], 0.15)
    n = orders.count()
    assert s.where(F.col("split") == "test").count() == int(n * 0.15)
    assert s.select("o_orderkey").distinct().count() == n
    counts = {r.o_orderstatus: r["count"] for r in orders.groupBy("o_orderstatus").count().collect()}
    alloc = split.allocate(counts, int(n * 0.15))
    got = {r.o_orderstatus: r["count"] for r in s.where(F.col("split") == "test").groupBy("o_orderstatus").count().collect()}
    assert got == {k: v for k, v in alloc.items() if v}


def test_split_is_seeded(orders):
    a = split.stratified_split(orders, "o_orderstatus", ["o_orderkey"], 0.2, seed=1).where("split = 'test'")
    b = split.stratified_split(orders, "o_orderstatus", ["o_orderkey"], 0.2, seed=1).where("split = 'test'")
    c = split.stratified_split(orders, "o_orderstatus", ["o_orderkey"], 0.2, seed=9).where("split = 'test'")
    ka = {r.o_orderkey for r in a.select("o_orderkey").collect()}
    assert ka == {r.o_orderkey for r in b.select("o_orderkey").collect()}
    assert ka != {r.o_orderkey for r in c.select("o_orderkey").collect()}


def test_stacking_split_partitions_rows(orders):
    s = split.stacking_split(orders, "o_orderstatus", ["o_orderkey"])
    folds = {r.fold: r["count"] for r in s.groupBy("fold").count().collect()}
    n = orders.count()
    assert sum(folds.values()) == n
    assert folds["level0_train"] + folds["level0_test"] == int(n * 0.33) or \
        abs(folds["level0_train"] + folds["level0_test"] - int(n * 0.33)) <= 0


def test_folds_balanced(orders):
    f = split.stratified_folds(orders, "o_orderstatus", ["o_orderkey"], k=5)
    per = f.groupBy("o_orderstatus", "fold").count().groupBy("o_orderstatus").agg(
        (F.max("count") - F.min("count")).alias("spread"))
    assert all(r.spread <= 1 for r in per.collect())


def test_undersample_never_adds_keys(orders):
    u = balance.undersample(orders, "o_orderstatus", ["o_orderkey"])
    keys = u.select("o_orderkey")
    assert keys.distinct().count() == keys.count()
    assert keys.join(orders.select("o_orderkey"), "o_orderkey", "left_anti").count() == 0
    counts = {r["count"] for r in u.groupBy("o_orderstatus").count().collect()}
    assert len(counts) == 1


def test_encode_decode_roundtrip(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_mktsegment", "c_nationkey")
    d = encode.fit_dictionary(c, ["c_mktsegment", "c_nationkey"])
    back = encode.decode_columns(encode.encode_columns(c, d, ["c_mktsegment", "c_nationkey"]), d,
                                 ["c_mktsegment", "c_nationkey"])
    j = back.alias("b").join(c.alias("c"), "c_custkey")
    assert j.where((F.col("b.c_mktsegment") != F.col("c.c_mktsegment")) |
                   (F.col("b.c_nationkey") != F.col("c.c_nationkey").cast("string"))).count() == 0


def test_dictionary_large_path_equals_local(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").select("p_size", "p_type")
    small = {(r.feature, r.value, r.code) for r in encode.fit_dictionary(p, ["p_size", "p_type"]).collect()}
    large = {(r.feature, r.value, r.code) for r in encode.fit_dictionary(p, ["p_size", "p_type"], max_local=1).collect()}
    assert small == large


def test_encode_broadcast_and_shuffle_joins_agree(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_type")
    d = encode.fit_dictionary(p, ["p_type"])
    a = {(r.p_partkey, r.p_type) for r in encode.encode_columns(p, d, ["p_type"]).collect()}
    b = {(r.p_partkey, r.p_type) for r in encode.encode_columns(p, d, ["p_type"], max_broadcast_rows=0).collect()}
    assert a == b
    back = encode.decode_columns(encode.encode_columns(p, d, ["p_type"], suffix="_code"), d.withColumn("feature", F.lit("p_type_code")), ["p_type_code"])
    assert back.where(F.col("p_type") != F.col("p_type_code")).count() == 0


def test_encode_of_many_values_is_a_join(spark):
    import time
    d = spark.range(20_000).select(F.lit("v").alias("feature"), F.col("id").cast("string").alias("value"), F.col("id").alias("code"))
    df = spark.range(150_000).select((F.col("id") % 25_000).cast("string").alias("v"))
    encode.encode_columns(df, d, ["v"]).count()
    began = time.time()
    assert encode.encode_columns(df, d, ["v"]).where("v = -1").count() == 30_000
    assert time.time() - began < 10

def test_lookup_requires_unique_key(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    fact = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        joins.lookup(fact, dim, "k", ["v"])


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (2, 5, "z")], "k int, o int, v string")
    got = {r.k: r.v for r in joins.first_per_key(df, "k", ["o"], ["v"]).collect()}
    assert got == {1: "y", 2: "z"}


@pytest.mark.parametrize("threshold", ["-1", "100m"])
def test_lineup_enrich_keeps_rows_apart_however_joined(spark, threshold):
    """Fixtures that share a key stay apart, a missing league matches a missing league, and
    absent markers find nothing, with broadcast joins and without."""
    from colforge.operators.lineup import enrich_lineup
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.createDataFrame([(1, None, "a", "b"), (2, "L", "a", "IDnull"), (2, "L", "b", None), (2, "L", "b", None), (None, "L", "c", "0")],
                                   "k int, league string, s1 string, s2 string")
        st = spark.createDataFrame([("a", None, 1.0, 1), ("a", "L", 2.0, 1), ("b", "L", 3.0, 2), ("b", "L", 9.0, 3), ("IDnull", "L", 7.0, 1),
                                    ("b", None, 4.0, 1), ("0", "L", 8.0, 1)], "pid string, league string, v double, o int")
        out = enrich_lineup(df, "k", ["s1", "s2"], st, "pid", ["v"], ["o"], extra_keys=["league"])
        got = sorted((tuple(r) for r in out.select("k", "league", "s1", "s1_v", "s2_v").collect()), key=str)
        assert got == sorted([(1, None, "a", 1.0, 4.0), (2, "L", "a", 2.0, None), (2, "L", "b", 3.0, None), (2, "L", "b", 3.0, None), (None, "L", "c", None, None)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_statistics_are_not_shuffled(spark):
    """The same result as from a frame, and the table's side of the join has no exchange."""
    from colforge.operators.lineup import enrich_lineup, store_statistics
    from colforge.session import scratch_path
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, None, "a", "b"), (2, "L", "a", "IDnull"), (2, "L", "b", None), (None, "L", "c", "0")], "k int, league string, s1 string, s2 string")
        st = spark.createDataFrame([("a", None, 1.0, 1), ("a", "L", 2.0, 1), ("b", "L", 3.0, 2), ("b", "L", 9.0, 3), ("b", None, 4.0, 1), (None, "L", 5.0, 1)],
                                   "pid string, league string, v double, o int")
        name = store_statistics(st, "colforge_test_statistics", scratch_path(spark, "test-statistics"), "pid", ["v"], ["o"], extra_keys=["league"])
        rows = [sorted((tuple(r) for r in enrich_lineup(df, "k", ["s1", "s2"], stats, "pid", ["v"], ["o"], extra_keys=["league"]).collect()), key=str) for stats in (st, name)]
        assert rows[0] == rows[1]
        out = enrich_lineup(df, "k", ["s1", "s2"], name, "pid", ["v"], ["o"], extra_keys=["league"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "hashpartitioning(player_id" in plan and "hashpartitioning(_cf_pid" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS colforge_test_statistics")


def test_undersample_keeps_rows_without_a_label(spark):
    from colforge.operators.balance import undersample
    df = spark.createDataFrame([(i, None if i < 6 else ("a" if i < 20 else "b")) for i in range(23)], "k int, y string")
    n = {r[0]: r[1] for r in undersample(df, "y", ["k"]).groupBy("y").count().collect()}
    assert n == {None: 6, "a": 3, "b": 3}


def test_smote_raises_for_classes_without_neighbours(spark):
    from colforge.operators.smote import smote
    df = spark.createDataFrame([(i, "a" if i < 20 else "b", float(i)) for i in range(23)], "k int, y string, x double")
    with pytest.raises(ValueError):
        smote(df, "y", "k", ["x"], k=5)


def pushed(df):
    import re
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.maxMetadataStringLength", before)
    return [x for x in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan) if x]


@pytest.mark.parametrize("name", ["fl5_player_filters", "fl6_noise_filter", "cl1_prepare_fixtures", "cl2_prepare_players"])
def test_registered_filters_reach_the_scan(spark, name):
    from colforge.plans.catalog import registry
    assert pushed(registry()[name][0](spark, SF))


def test_filters_on_raw_columns_are_pushed_whole(spark):
    from colforge.operators import clean
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_returnflag", "l_linenumber", "l_discount")
    assert "Not(In(l_returnflag, [A,R]))" in pushed(clean.exclude_values(li, "l_returnflag", ["A", "R"]))[0]
    chain = pushed(clean.filter_all(li, [F.col("l_linenumber") >= 2, F.col("l_discount") > 0]))[0]
    assert "GreaterThanOrEqual(l_linenumber,2)" in chain and "GreaterThan(l_discount,0" in chain
    assert "LessThanOrEqual(l_discount,1" in pushed(clean.all_between(li, ["l_discount"]))[0]


def test_filters_keep_or_drop_missing_rows(spark):
    from colforge.functions.missing import ne_keep_missing, not_in_keep_missing
    from colforge.operators import clean
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (3, float("nan"), "b"), (4, 5.0, "IDnull")], "k int, x double, s string")
    ids = lambda d: sorted(r.k for r in d.collect())
    assert ids(clean.filter_all(df, clean.above(df, "x", 0))) == [1, 4]
    assert ids(clean.all_between(df, ["x"], 0, 1)) == [1]
    assert ids(clean.require_present(df, ["s"])) == [1, 3]
    assert ids(df.filter(ne_keep_missing("s", "a"))) == [2, 3, 4]
    assert ids(df.filter(not_in_keep_missing("s", ["a", "b"]))) == [2, 4]


def test_estimate_failure_is_not_a_small_size():
    from colforge.session import estimated_bytes
    with pytest.raises(AttributeError):
        estimated_bytes(object())


def test_clear_scratch(spark):
    import os
    from colforge import session
    out = session.materialize(spark.range(3), "t")
    path = session._WRITTEN[-1].removeprefix("file:")
    assert out.count() == 3 and os.path.isdir(path)
    assert session.clear_scratch(spark) >= 1 and not os.path.isdir(path)


def test_pairwise_corr_of_many_columns_multiplies_no_rows(spark):
    import numpy as np
    from colforge.operators import profile as pf
    rng = np.random.default_rng(0)
    x = rng.random((200, 20))
    x[:, 3] = x[:, 2] * 2
    x[rng.random((200, 20)) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(20)))
    corr = pf.pairwise_corr(df, df.columns)
    assert "Generate" not in corr._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1]
    got = {(r[0], r[1]): r[2] for r in corr.collect()}
    want = df.toPandas().corr()
    assert len(got) == 190 and all(abs(v - want.loc[a, b]) < 1e-9 for (a, b), v in got.items())


@pytest.mark.parametrize("at_once", [1000, 7])
def test_five_hundred_columns_take_one_scan(spark, tmp_path, monkeypatch, at_once):
    """Pairwise complete over nulls, far from zero, drifting, constant and infinite columns."""
    import numpy as np
    from colforge.operators import profile as pf
    d = 500 if at_once > 500 else 20
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, d)) + rng.normal(size=(1500, 1))
    x[:, 1] += 1e9
    x[1000:, 2] += 1e7  # the first rows say nothing of the rest
    x[:, 3] = 0.1
    x[:, 4] = np.where(np.arange(1500) < 1200, np.nan, 5.0)
    x[:, 5] = np.nan
    x[7, 6] = np.inf
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(d)]
    import pandas as pd
    pd.DataFrame(x, columns=names).to_parquet(tmp_path / "x.parquet", index=False)
    df = spark.read.parquet(str(tmp_path / "x.parquet"))
    monkeypatch.setattr(pf, "COLUMNS_AT_ONCE", at_once)
    scans = []
    real = pf._pair_sums
    monkeypatch.setattr(pf, "_pair_sums", lambda *a: scans.append(1) or real(*a))
    got = {(r[0], r[1]): r[2] for r in pf.pairwise_corr(df, names).collect()}
    blocks = -(-d // at_once)
    assert len(scans) <= 2 * blocks * (blocks + 1) // 2 and len(got) == d * (d - 1) // 2
    want = pd.DataFrame(np.where(np.isinf(x), 0, x), columns=names).corr(min_periods=2).to_numpy()
    for i in range(d):
        for j in range(i + 1, d):
            v = got[f"c{i}", f"c{j}"]
            if {i, j} & {3, 4, 5, 6}:
                assert v is None, (i, j)
            else:
                assert abs(v - want[i, j]) < 1e-6, (i, j)
    plain = df.drop("c1", "c2", "c4")
    scans.clear()
    pf.pairwise_corr(plain, plain.columns).count()
    if at_once > 500:
        assert len(scans) == 1
    none = {(r[0], r[1]): r[2] for r in pf.pairwise_corr(df.limit(0), names[:4]).collect()}
    assert len(none) == 6 and set(none.values()) == {None}


def test_selector_needs_labels_and_keeps_text_columns(spark):
    from colforge.operators.select import FeatureSelector
    rows = [(float(i), float(i % 3), "x" if i % 2 else "y", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, t string, y int")
    params = {"missing_threshold": 0.5, "correlation_threshold": 0.9, "eval_metric": "auc", "task": "classification", "cumulative_importance": 0.9}
    with pytest.raises(ValueError):
        FeatureSelector(df.drop("y")).identify_all(params)
    s = FeatureSelector(df, label="y")
    s.identify_all({**params, "n_iterations": 1, "num_trees": 3})
    assert set(s.ops) == {"missing", "single_unique", "collinear", "zero_importance", "low_importance"}
    s.ops = {k: [] for k in s.ops}
    assert {"t", "t_x", "t_y"} <= set(s.remove().columns)

def test_scalers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    mm = [r.x for r in encode.min_max_scale(df, ["x"]).collect()]
    assert mm == [0.0, 0.5, 1.0, None]
    st = [r.x for r in encode.standard_scale(df, ["x"]).collect()]
    assert abs(st[0] + 1.224744871391589) < 1e-12 and st[1] == 0.0 and st[3] is None
    rb = [r.x for r in encode.robust_scale(df, ["x"]).collect()]
    assert rb[1] == 0.0 and rb[3] is None


def test_macro_scores_by_hand(spark):
    from colforge.operators.evaluate import MacroEvaluator, macro_scores
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = macro_scores(df, "label", "prediction").first()
    # class 0: p=1/2 r=1/2; class 1: p=2/3 r=1; class 2: p=0 r=0
    assert abs(m.precision_macro - (0.5 + 2 / 3) / 3) < 1e-12
    assert abs(m.recall_macro - 0.5) < 1e-12
    f1 = (0.5 + 2 * (2 / 3) / (2 / 3 + 1)) / 3
    assert abs(m.f1_macro - f1) < 1e-12
    assert abs(MacroEvaluator("recall_macro").evaluate(df) - 0.5) < 1e-12


def test_exact_row_number_many_partitions_without_aqe(spark, orders):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = orders.withColumn("h", md5_order(["o_orderkey"], seed=3))
        got = exact_row_number(df, ["o_orderstatus"], ["h", "o_orderkey"], num_partitions=64)
        w = Window.partitionBy("o_orderstatus").orderBy("h", "o_orderkey")
        ref = df.withColumn("rn2", F.row_number().over(w)).select("o_orderkey", "rn2")
        assert got.join(ref, "o_orderkey").where(F.col("rn") != F.col("rn2")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bounded_broadcast_respects_bounds(spark):
    from colforge.session import bounded_broadcast
    small = spark.range(10)
    assert "ResolvedHint" in small.join(bounded_broadcast(small, 100), "id")._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in small.join(bounded_broadcast(small, 100), "id")._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(1000)
    plan = big.join(bounded_broadcast(big, 100), "id")._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plan
