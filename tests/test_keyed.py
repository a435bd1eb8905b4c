import pytest
from pyspark.sql import functions as F

from colforge.session import scratch_path
from colforge.sources import keyed, registry


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test-keyed")


def frame(spark, data, schema="k int, s string, v double"):
    return spark.createDataFrame(data, schema)


def test_updates_new_keys_and_reruns(spark, path):
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed(spark, path)
    first = [(i, f"s{i}", float(i)) for i in range(20)] + [(None, "null", 0.0)]
    assert keyed.upsert_keyed(frame(spark, first), path, ["k"], buckets=5) == 1
    change = [(3, "new", -1.0), (None, "changed", 1.0), (99, None, None)]
    for version in (2, 3):  # a rerun changes nothing
        assert keyed.upsert_keyed(frame(spark, change), path, ["k"]) == version
        want = [r for r in first if r[0] not in (3, None)] + change
        assert rows(keyed.read_keyed(spark, path)) == sorted(want, key=str)
    assert rows(keyed.read_keyed(spark, path, 1)) == sorted(first, key=str)
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed(spark, path, 7)


def test_untouched_buckets_are_not_written_again(spark, path):
    keyed.upsert_keyed(frame(spark, [(i, "a", 0.0) for i in range(100)]), path, ["k"], buckets=10)
    keyed.upsert_keyed(frame(spark, [(7, "b", 0.0)]), path, ["k"])
    files = keyed._Files(spark, path)
    a, b = (keyed._manifest(files, v)["buckets"] for v in (1, 2))
    assert sum(a[k] != b[k] for k in a) == 1 and len(a) == 10


def test_a_crash_between_write_and_publish_changes_nothing(spark, path):
    one = frame(spark, [(1, "a", 1.0)])
    keyed.upsert_keyed(one, path, ["k"])
    keyed.write_upsert(frame(spark, [(1, "lost", 2.0), (2, "lost", 2.0)]), path, ["k"])  # and the driver is gone
    assert rows(keyed.read_keyed(spark, path)) == [(1, "a", 1.0)]
    keyed.upsert_keyed(frame(spark, [(2, "b", 3.0)]), path, ["k"])
    assert rows(keyed.read_keyed(spark, path)) == [(1, "a", 1.0), (2, "b", 3.0)]
    assert keyed.clean_keyed(spark, path, keep=1) >= 1
    assert keyed.versions(spark, path) == [2] and rows(keyed.read_keyed(spark, path)) == [(1, "a", 1.0), (2, "b", 3.0)]
    assert keyed.clean_keyed(spark, path, keep=1) == 0


def test_the_second_of_two_writers_fails(spark, path):
    keyed.upsert_keyed(frame(spark, [(1, "a", 1.0)]), path, ["k"])
    mine, theirs = (keyed.write_upsert(frame(spark, [(i, "b", 1.0)]), path, ["k"]) for i in (2, 3))
    keyed.publish_upsert(spark, *theirs)
    with pytest.raises(keyed.ConcurrentWrite):
        keyed.publish_upsert(spark, *mine)
    assert [r[0] for r in rows(keyed.read_keyed(spark, path))] == [1, 3]


def test_keys_must_be_unique_and_types_the_same(spark, path):
    with pytest.raises(ValueError, match="2 times"):
        keyed.upsert_keyed(frame(spark, [(1, "a", 1.0), (1, "b", 1.0)]), path, ["k"])
    keyed.upsert_keyed(frame(spark, [(1, "a", 1.0)]), path, ["k", "s"])
    with pytest.raises(ValueError, match="keys"):
        keyed.upsert_keyed(frame(spark, [(1, "a", 1.0)]), path, ["k"])
    with pytest.raises(ValueError, match="types"):
        keyed.upsert_keyed(frame(spark, [(1, "a", "x")], "k int, s string, v string"), path, ["k", "s"])
    keyed.upsert_keyed(frame(spark, [(1, "b", True)], "k int, s string, extra boolean"), path, ["k", "s"])
    assert rows(keyed.read_keyed(spark, path)) == [(1, "a", 1.0, None), (1, "b", None, True)]
    keyed.upsert_keyed(frame(spark, []), path, ["k", "s"])
    assert keyed.read_keyed(spark, path).count() == 2


def test_registry_resolves_and_refuses(spark):
    root = scratch_path(spark, "test-registry")
    assert registry.entries(spark, root).count() == 0
    df = frame(spark, [(1, "a", 1.0)])
    with pytest.raises(LookupError):
        registry.resolve(spark, root, "forest", "y")
    for version, names in (("v2", ["k"]), ("v10", ["k", "v"]), ("v9", ["v"])):
        path = registry.register(spark, root, "forest", "y", version, registry.features_of(df, names), ["a", "b"], {"accuracy": 0.5})
        assert path == f"{root}/forest/y/{version}"
    registry.register(spark, root, "forest", "y", "v1", [("v", "double")], halftime=True)
    latest = registry.resolve(spark, root, "forest", "y")
    assert latest["version"] == "v9" and latest["metrics"] == {"accuracy": 0.5}
    assert registry.resolve(spark, root, "forest", "y", "v10")["schema_hash"] == registry.schema_hash([("k", "int"), ("v", "double")])
    assert registry.resolve(spark, root, "forest", "y", halftime=True)["path"].endswith("/v1/ht")
    registry.register(spark, root, "forest", "y", "v2", [("k", "int")], metrics={"accuracy": 0.9})  # again: now the last
    assert registry.resolve(spark, root, "forest", "y")["version"] == "v2" and registry.entries(spark, root).count() == 4
    registry.check_frame(latest, df)
    for other in (df.drop("v"), df.withColumn("v", F.col("v").cast("string"))):
        with pytest.raises(ValueError, match="v \\("):
            registry.check_frame(latest, other)


def test_stored_model_scores_only_its_own_frames(spark):
    from colforge.ml import models as ml
    root = scratch_path(spark, "test-registry-model")
    df = spark.createDataFrame([(i, float(i % 10), "a" if i % 10 < 5 else "b") for i in range(60)], "id int, x double, y string")
    model = ml.train(df, "y", ["x"], kind="forest", numTrees=3, maxDepth=2)
    registry.save_model(model, df, root, "forest", "v1", {"f1": 1.0})
    back = registry.load_model(spark, root, "forest", "y", df=df)
    assert back.transform(df).where("predicted <> y").count() == 0
    with pytest.raises(ValueError):
        registry.load_model(spark, root, "forest", "y", df=df.withColumn("x", F.col("x").cast("int")))
