"""Registered queries for model work (ML, FS4, FS6, EN6, EN7, EV5, IO7, IO8, CL4–CL7).

Model fits have no SQL twin: these entries get the driver's rows-only check and
invariant tests in ``tests/test_models.py``.  Every one trains and scores on the whole
table it names.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ...ml import models as ml
from ...ml.stack import fit_chain, fit_stack
from ...ml.tuning import grid_search, score_folds
from ...operators import select as fsel
from ...operators.split import stacking_split
from ...plans import matches
from ...session import scratch_path
from ...sources import files
from .common import table
from .composed import IDS, PROBAS, SCORES, fixtures_raw, halftime_table, players_raw
from .composed import _PLAYER_PRESET as PLAYERS

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


_LI_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_SMALL_FOREST = {"numTrees": 20, "maxDepth": 6}


def _orders(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                    (F.col("o_custkey") % 100).cast("double").alias("cust_bucket"),
                    F.year("o_orderdate").cast("double").alias("year"),
                    F.month("o_orderdate").cast("double").alias("month"))


_O_FEATS = ["o_totalprice", "cust_bucket", "year", "month"]


@register("ml1_random_forest")
def ml1(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", *_LI_FEATS[:-1])
    m = ml.train(li, "l_returnflag", _LI_FEATS, kind="forest", **_SMALL_FOREST)
    return m.transform(li)


@register("ml2_boosted_trees")
def ml2(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), "lang")
    df = lab.join(docs, "doc_id")
    m = ml.train(df, "quality", ["n_chars"], ["lang"], kind="boosted", maxIter=20, maxDepth=3)
    return ml.compat_columns(m.transform(df), "quality", m.classes)


@register("ml3_perceptron")
def ml3(spark, sf):
    e = table(spark, sf, "embeddings")
    df = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    m = ml.train(df, "label", [f"e{i}" for i in range(64)], kind="perceptron", layout="small", maxIter=50,
                 balanced=False)
    return m.transform(df).select("vec_id", "label", "prediction", "predicted")


@register("ml4_preset_training")
def ml4(spark, sf):
    """Per-label forest presets applied to two labels of the prepared fixtures; both
    predictions are added to the same frame by successive transforms."""
    from ...presets import forest_params
    from ...session import materialize
    fx = materialize(_prepared_fixtures(spark, sf).select("fixture_id", *_FIX_FEATS, "Team1Win", "LDEM"), "ml4")
    out = fx
    for label in ("Team1Win", "LDEM"):
        m = ml.train(fx, label, _FIX_FEATS, kind="forest", **forest_params(label, len(_FIX_FEATS), num_trees=20))
        out = m.transform(out).withColumnRenamed("predicted", f"{label}_call").drop(
            "prediction", *[ml.prob_name(c) for c in m.classes])
    return out.select("fixture_id", "Team1Win", "LDEM", "Team1Win_call", "LDEM_call")


@register("ml5_grid_search")
def ml5(spark, sf):
    o = _orders(spark, sf)
    _, metrics = grid_search(o, "o_orderstatus", ["o_orderkey"], _O_FEATS, kind="forest",
                             grid={"maxDepth": [3, 6]}, folds=3, metric="recall_macro", fixed={"numTrees": 10})
    return metrics


@register("ml6_fit_save_load")
def ml6(spark, sf):
    o = _orders(spark, sf)
    path = scratch_path(spark, "ml6-model")
    ml.fit_save(o, path, "o_orderstatus", _O_FEATS, kind="forest", **_SMALL_FOREST)
    return ml.load_transform(spark, path, o).select("o_orderkey", "o_orderstatus", "predicted")


@register("ml6_reload_agreement", "SELECT count(*) AS rows, 0::BIGINT AS mismatches FROM orders")
def ml6_reload(spark, sf):
    """ML6 / IO8: a stored and reloaded model scores every row as the one in memory."""
    o = _orders(spark, sf)
    path = scratch_path(spark, "ml6-reload")
    m = ml.fit_save(o, path, "o_orderstatus", _O_FEATS, kind="forest", **_SMALL_FOREST)
    a = m.transform(o).select("o_orderkey", "predicted", *m.probability_columns)
    b = ml.load_transform(spark, path, o).select(F.col("o_orderkey").alias("k"), F.col("predicted").alias("p"),
                                                 *[F.col(c).alias(f"b_{c}") for c in m.probability_columns])
    same = F.col("predicted") == F.col("p")
    for c in m.probability_columns:
        same &= F.abs(F.col(c) - F.col(f"b_{c}")) < 1e-12
    return a.join(b, F.col("o_orderkey") == F.col("k")).agg(F.count(F.lit(1)).alias("rows"), F.sum((~same).cast("bigint")).alias("mismatches"))


@register("ml7_probability_sums", "SELECT o_orderkey, 1.0::DOUBLE AS total FROM orders")
def ml7_sums(spark, sf):
    """ML7: the class probabilities of every row add up to 1."""
    o = _orders(spark, sf)
    m = ml.train(o, "o_orderstatus", _O_FEATS, kind="forest", **_SMALL_FOREST)
    total = F.aggregate(F.array(*m.probability_columns), F.lit(0.0), lambda a, b: a + b)
    return m.transform(o).select("o_orderkey", F.round(total, 9).alias("total"))


@register("ml8_decoded_codes", """
WITH v AS (SELECT o_orderpriority AS value, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
           FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
SELECT o_orderkey, true AS belongs FROM orders""")
def ml8_codes(spark, sf):
    """ML8: each decoded value is the class of its code, codes in the order of the classes."""
    classes = table(spark, sf, "orders").select("o_orderpriority").distinct().where("o_orderpriority is not null")
    codes = classes.select(F.col("o_orderpriority").alias("value"), (F.row_number().over(Window.orderBy("o_orderpriority")) - 1).alias("code"))
    return ml8(spark, sf).join(codes, F.col("code") == F.col("prediction"), "left").select(
        "o_orderkey", F.coalesce(F.col("value") == F.col("predicted"), F.lit(False)).alias("belongs"))


@register("ml8_class_codes", """
SELECT o_orderpriority AS value, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL)""")
def ml8_class_codes(spark, sf):
    """ML8: the stored dictionary by which a model decodes, read back with it."""
    o, path = _orders(spark, sf), scratch_path(spark, "ml8-model")
    ml.fit_save(o, path, "o_orderpriority", _O_FEATS, kind="forest", **_SMALL_FOREST)
    return ml.TrainedModel.load(spark, path).labels.select("value", "code")


@register("ml7_probability_names")
def ml7(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", *_LI_FEATS[:-1],
        F.expr("CASE WHEN l_linenumber - CAST(nullif(l_partkey % 8, 7) AS DOUBLE) > 0 THEN 1 "
               "WHEN l_linenumber - CAST(nullif(l_partkey % 8, 7) AS DOUBLE) < 0 THEN 2 "
               "WHEN l_linenumber - CAST(nullif(l_partkey % 8, 7) AS DOUBLE) = 0 THEN 0 ELSE -1 END").alias("FTR"))
    li = li.where(F.col("FTR") >= 0)
    m = ml.train(li, "FTR", _LI_FEATS[:-1], kind="forest", **_SMALL_FOREST)
    return ml.compat_columns(m.transform(li), "FTR", m.classes).select("l_orderkey", "l_linenumber", "D", "W", "L")


@register("ml8_decode_prediction")
def ml8(spark, sf):
    o = _orders(spark, sf)
    m = ml.train(o, "o_orderpriority", _O_FEATS, kind="forest", **_SMALL_FOREST)
    return m.transform(o).select("o_orderkey", "prediction", "predicted")


@register("ml9_stacking")
def ml9(spark, sf):
    o = _orders(spark, sf)
    _, held = fit_stack(o, "o_orderstatus", ["o_orderkey"], _O_FEATS,
                        level0={"forest": ("forest", _SMALL_FOREST), "mlp": ("perceptron", {"layout": "small", "maxIter": 30})},
                        level1={"numTrees": 20, "maxDepth": 6})
    return held.select("o_orderkey", "o_orderstatus", "predicted")


def _prepared_fixtures(spark, sf):
    from ...plans.fixtures import prepare_fixtures
    return prepare_fixtures(fixtures_raw(spark, sf), None, "stack", halftime_table(spark, sf),
                            id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)


_FIX_FEATS = ["HTGS", "HTGC", "HTP", "ATGS", "ATGC", "ATP", "BW1", "BWN", "BW2", "W1", "WN", "W2", "DiffWin12"]


@register("ml10_stack_many_targets")
def ml10(spark, sf):
    fx = _prepared_fixtures(spark, sf)
    level0 = {"ftr": ("forest", _SMALL_FOREST), "ldem": ("forest", _SMALL_FOREST), "ov25": ("forest", _SMALL_FOREST)}
    _, held = fit_stack(fx, "totgoal2", ["fixture_id"], _FIX_FEATS, level0=level0,
                        level0_labels={"ftr": "FTR", "ldem": "LDEM", "ov25": "Ov25"}, level1=_SMALL_FOREST)
    return held.select("fixture_id", "totgoal2", "predicted")


_CHAIN_TARGETS = ["NextRatingRange", "NextTrend", "NextOvAvg"]


def _players_with_targets(spark, sf):
    from ...functions.targets import player_targets
    from ...functions.missing import to_double
    raw = players_raw(spark, sf).withColumn("NextRating", to_double("NextRating"))
    return player_targets(raw)


_P_FEATS = ["rating", "avg", "std2", "teamPoints"]


@register("ml11_classifier_chain")
def ml11(spark, sf):
    p = _players_with_targets(spark, sf).select("Nextfixture_id", "player_id", *_P_FEATS, *_CHAIN_TARGETS)
    chain = fit_chain(p, _CHAIN_TARGETS, _P_FEATS, **_SMALL_FOREST)
    return chain.transform(p.drop(*_CHAIN_TARGETS)).select("Nextfixture_id", "player_id",
                                                           *[f"{t}_pred" for t in _CHAIN_TARGETS])


@register("ml12_chain_training")
def ml12(spark, sf):
    """ML12: per link of the chain, the features it was trained on and its classes."""
    p = _players_with_targets(spark, sf).select("Nextfixture_id", "player_id", *_P_FEATS, *_CHAIN_TARGETS)
    chain = fit_chain(p, _CHAIN_TARGETS, _P_FEATS, **_SMALL_FOREST)
    rows = [(i, t, ",".join(m.numeric), len(m.classes), m.pipeline.stages[-1].getNumTrees)
            for i, (t, m) in enumerate(zip(chain.targets, chain.models), start=1)]
    return spark.createDataFrame(rows, "link int, target string, features string, n_classes int, n_trees int")


def _fit_and_predict_matches(spark, sf, labels, **options):
    """Models of the fixtures before the cut-off, stored; calls for those from it on."""
    raw, ht, root = fixtures_raw(spark, sf), halftime_table(spark, sf), scratch_path(spark, "match-models")
    common = {"ids": IDS, "scores": SCORES, "probas": PROBAS, "stacked": options.pop("stacked", True)}
    known = F.col("event_date") < "2000-06-01"
    matches.fit_matches(raw.where(known), ht, labels, _FIX_FEATS, root, params=_SMALL_FOREST,
                        network={"layout": "small", "maxIter": 30}, **common)
    return matches.predict_matches(raw.where(~known), ht, labels, _FIX_FEATS, root, **common, **options)


@register("ml13_match_prediction")
def ml13(spark, sf):
    return _fit_and_predict_matches(spark, sf, ["Team1Win"], stacked=False)


@register("ev5_score_folds")
def ev5(spark, sf):
    o = _orders(spark, sf)
    s = stacking_split(o, "o_orderstatus", ["o_orderkey"], seed=2)
    m = ml.train(s.where(F.col("fold") == "level0_train"), "o_orderstatus", _O_FEATS, kind="forest", **_SMALL_FOREST)
    return score_folds(m, {"train": s.where(F.col("fold") == "level0_train"),
                           "test": s.where(F.col("fold") == "level0_test"),
                           "validation": s.where(F.col("fold") == "level1")})


@register("fs4_identify_zero_importance")
def fs4(spark, sf):
    li = table(spark, sf, "lineitem").select(*_LI_FEATS, F.lit(1.0).alias("constant"), "l_linestatus", "l_returnflag")
    s = fsel.FeatureSelector(li, label="l_returnflag")
    s.identify_zero_importance(n_iterations=2, num_trees=10)
    return s.feature_importances


@register("fs6_identify_all")
def fs6(spark, sf):
    from .selection import _FEATS
    li = table(spark, sf, "lineitem")
    s = fsel.FeatureSelector(li.select(*[F.expr(e).alias(k) for k, e in _FEATS.items()], "l_returnflag"), label="l_returnflag")
    names = s.identify_all({"missing_threshold": 0.5, "correlation_threshold": 0.9, "eval_metric": "auc",
                            "task": "classification", "cumulative_importance": 0.95, "n_iterations": 2, "num_trees": 10})
    return spark.createDataFrame([(n,) for n in names], "feature string")


@register("en6_feature_assembly", "SELECT o_orderkey, (SELECT 4 + count(DISTINCT o_orderpriority) FROM orders)::INT AS n_features FROM orders")
def en6(spark, sf):
    from pyspark.ml import Pipeline
    o = ml.prepare_features(_orders(spark, sf), _O_FEATS, ["o_orderpriority"])
    pipe = Pipeline(stages=ml.feature_stages(_O_FEATS, ["o_orderpriority"])).fit(o)
    return pipe.transform(o).select("o_orderkey", F.size(vector_to_array(ml.FEATURES)).alias("n_features"))


@register("en7_fit_apply_vocabulary")
def en7(spark, sf):
    from pyspark.ml import Pipeline
    o = ml.prepare_features(_orders(spark, sf), _O_FEATS, ["o_orderpriority"])
    train = o.where(F.col("o_orderpriority") != "5-LOW")
    pipe = Pipeline(stages=ml.feature_stages(_O_FEATS, ["o_orderpriority"])).fit(train)
    return pipe.transform(o).select("o_orderkey", "o_orderpriority",
                                      vector_to_array(f"{ml.own('o_orderpriority')}_ohe").alias("onehot"))


@register("en7_onehot_positions", """
WITH v AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY o_orderpriority) AS i
           FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'))
SELECT o_orderkey, coalesce(i, 0)::INT AS position, CASE WHEN i IS NULL THEN 0 ELSE 1 END AS ones
FROM orders LEFT JOIN v ON p = o_orderpriority""")
def en7_positions(spark, sf):
    """EN7 as positions: the vocabulary's place of the row's value; a value that the
    vocabulary was not fitted on has an all-zero vector."""
    out = en7(spark, sf)
    return out.select("o_orderkey", F.array_position("onehot", F.lit(1.0)).cast("int").alias("position"),
                      F.aggregate("onehot", F.lit(0.0), lambda a, b: a + b).cast("int").alias("ones"))


@register("io7_keyed_sink")
def io7(spark, sf):
    o = _orders(spark, sf)
    path = scratch_path(spark, "io7-sink")
    pred = ml.train(o, "o_orderstatus", _O_FEATS, kind="forest", **_SMALL_FOREST).transform(o)
    out = pred.select(F.col("o_orderkey").alias("fixture_id"), F.col("predicted").alias("status_pred"), "year")
    files.write_keyed(out, path, ["year"])
    files.write_keyed(out, path, ["year"])  # a rerun replaces, never duplicates
    return spark.read.parquet(path)


@register("io7_sink_keys", "SELECT o_orderkey AS fixture_id, year(o_orderdate)::DOUBLE AS year FROM orders")
def io7_keys(spark, sf):
    """IO7: after two writes the sink holds every key once, in its year."""
    return io7(spark, sf).select("fixture_id", F.col("year").cast("double").alias("year"))


@register("io7_upsert_values", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 3 = 0 THEN 'second' END AS note
FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 3 = 0""")
def io7_upsert(spark, sf):
    """IO7: a table of two statuses; an upsert with changed prices, new keys and a new
    column, run twice; one that is written but never published; the last version."""
    from ...sources.keyed import read_keyed, upsert_keyed, write_upsert
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    path = scratch_path(spark, "io7-upsert")
    upsert_keyed(o.where("o_orderstatus <> 'P'"), path, ["o_orderkey"], buckets=4)
    second = o.where("o_orderkey % 3 = 0").select("o_orderkey", "o_orderstatus", (F.col("price") * 2).alias("price"), F.lit("second").alias("note"))
    upsert_keyed(second, path, ["o_orderkey"])
    upsert_keyed(second, path, ["o_orderkey"])
    write_upsert(o.withColumn("price", F.lit(0.0).cast(o.schema["price"].dataType)), path, ["o_orderkey"])
    return read_keyed(spark, path)


@register("io8_registry_lookup", """
SELECT * FROM (VALUES ('forest', 'o_orderstatus', false, 'v2', 'forest/o_orderstatus/v2', 'F,O,P', 'o_totalprice double,o_shippriority int'),
                      ('forest', 'o_orderstatus', true, 'v1', 'forest/o_orderstatus/v1/ht', 'F,O,P', 'o_totalprice double')) t(kind, label, halftime, version, path, classes, features)""")
def io8_lookup(spark, sf):
    """IO8: of two versions and a half-time model, what ``latest`` resolves to."""
    from ...sources import registry
    o = table(spark, sf, "orders").withColumns({"o_totalprice": F.col("o_totalprice").cast("double"), "o_shippriority": F.lit(0)})
    classes = sorted(r[0] for r in o.select("o_orderstatus").distinct().collect())
    root = scratch_path(spark, "io8-lookup")
    for version, features, halftime in (("v1", ["o_totalprice"], False), ("v1", ["o_totalprice"], True), ("v2", ["o_totalprice", "o_shippriority"], False)):
        registry.register(spark, root, "forest", "o_orderstatus", version, registry.features_of(o, features), classes, halftime=halftime)
    rows = [registry.resolve(spark, root, "forest", "o_orderstatus", halftime=h) for h in (False, True)]
    return spark.createDataFrame([(r["kind"], r["label"], r["halftime"], r["version"], r["path"].removeprefix(f"{root}/"), ",".join(r["classes"]),
                                   ",".join(f"{f['name']} {f['type']}" for f in r["features"])) for r in rows],
                                 "kind string, label string, halftime boolean, version string, path string, classes string, features string")


@register("io8_model_registry")
def io8(spark, sf):
    from ...sources.registry import load_model, save_model
    o = _orders(spark, sf)
    root = scratch_path(spark, "io8-registry")
    model = ml.train(o, "o_orderstatus", _O_FEATS, kind="forest", **_SMALL_FOREST)
    save_model(model, o, root, "forest", "v5")
    return load_model(spark, root, "forest", "o_orderstatus", df=o).transform(o).select("o_orderkey", "predicted")


@register("cl4_predict_players")
def cl4(spark, sf):
    from ...plans.players_predict import fit_players, predict_players
    p, root = _players_with_targets(spark, sf), scratch_path(spark, "cl4-models")
    since = F.col("event_date") < "1998-01-01"
    fit_players(p.where(since), _CHAIN_TARGETS, _P_FEATS, root, preset=PLAYERS, params=_SMALL_FOREST)
    return predict_players(p.where(~since), _P_FEATS, root, preset=PLAYERS)


@register("cl5_predict_matches")
def cl5(spark, sf):
    return _fit_and_predict_matches(spark, sf, ["Team1Win", "Team2Win", "TeamNWin"], raw_columns=["event_date"])


@register("cl6_validate_matches")
def cl6(spark, sf):
    return matches.validate_matches(fixtures_raw(spark, sf), halftime_table(spark, sf), "Team1Win",
                                    ids=IDS, scores=SCORES, probas=PROBAS, features=_FIX_FEATS, params=_SMALL_FOREST,
                                    network={"layout": "small", "maxIter": 30})


@register("cl7_train_label")
def cl7(spark, sf):
    return matches.train_label(fixtures_raw(spark, sf), halftime_table(spark, sf), "LDEM", ids=IDS, scores=SCORES,
                               probas=PROBAS, features=_FIX_FEATS, layout="small")



@register("rb2_smote")
def rb2(spark, sf):
    from ...operators.smote import smote
    e = table(spark, sf, "embeddings")
    df = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    return smote(df, "label", "vec_id", [f"e{i}" for i in range(64)], k=5, seed=2)


@register("rb2_neighbours", """
WITH p AS (SELECT a.vec_id, a.label, b.vec_id AS nb_key, list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2)) AS d
           FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT vec_id, label, nb_key, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY d, nb_key) AS INTEGER) AS nb_rank FROM p
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, nb_key) <= 5""")
def rb2_neighbours(spark, sf):
    """The neighbours between which RB2 interpolates."""
    from ...operators.neighbours import nearest_neighbours
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("_v"))
    return nearest_neighbours(e, "label", "vec_id", 5).select("vec_id", "label", "nb_rank", "nb_key")


@register("rb2_class_counts", """
SELECT label, (SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)) AS rows, count(*) AS originals
FROM embeddings GROUP BY label""")
def rb2_counts(spark, sf):
    """RB2: every class has the majority's rows, its own among them."""
    return rb2(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("synthetic") == 0).cast("bigint")).alias("originals"))


@register("rb3_smote_nc")
def rb3(spark, sf):
    from ...operators.smote import smote
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal",
                                            F.col("c_nationkey").cast("double").alias("nation"),
                                            (F.col("c_custkey") % 3).cast("string").alias("tier"))
    return smote(c, "c_mktsegment", "c_custkey", ["c_acctbal", "nation"], k=5, seed=2, categorical=["tier"])


@register("rb3_neighbours", """
WITH p AS (SELECT a.c_custkey, b.c_custkey AS nb_key, (a.c_acctbal - b.c_acctbal) ** 2 + (a.c_nationkey - b.c_nationkey) ** 2
                  + CASE WHEN a.c_custkey % 3 = b.c_custkey % 3 THEN 0 ELSE 10000 END AS d
           FROM customer a JOIN customer b ON a.c_mktsegment = b.c_mktsegment AND a.c_custkey <> b.c_custkey)
SELECT c_custkey, nb_key, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY d, nb_key) AS INTEGER) AS nb_rank FROM p
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, nb_key) <= 5""")
def rb3_neighbours(spark, sf):
    """The neighbours of RB3: a tier that differs adds 10000 to the squared distance."""
    from ...operators.neighbours import nearest_neighbours
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.array(F.col("c_acctbal").cast("double"), F.col("c_nationkey").cast("double")).alias("_v"),
                                            F.array((F.col("c_custkey") % 3).cast("string")).alias("_cat"))
    return nearest_neighbours(c, "c_mktsegment", "c_custkey", 5, weight=10000.0).select("c_custkey", "nb_rank", "nb_key")


@register("rb3_class_counts", """
SELECT c_mktsegment, (SELECT max(n) FROM (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment)) AS rows, count(*) AS originals
FROM customer GROUP BY c_mktsegment""")
def rb3_counts(spark, sf):
    """RB3: as RB2, with a categorical column."""
    return rb3(spark, sf).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("synthetic") == 0).cast("bigint")).alias("originals"))
