"""A keyed table with upserts and versions (IO7).

Rows are dealt to buckets by a hash of their key, and a version is a small manifest that
names the folder of each bucket.  An upsert reads the buckets that its rows fall into,
takes the new rows over the old ones of the same key, writes those buckets to a folder of
its own and publishes a new manifest; all other buckets stay where they are.  Publishing
is one rename that fails if the version exists, so

- readers see a whole version or the one before, never a part;
- a run that dies before publishing leaves only a folder that nothing names;
- of two writers that started from one version, the second fails and can be run again;
- running an upsert twice gives the same rows.

Old versions can be read until ``clean_keyed`` removes them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "_cf_bucket"
_DIGITS = 12


class ConcurrentWrite(RuntimeError):
    """Another writer has published the version that this one was about to publish."""


class _Files:
    """The few file operations of a table's folder, on whatever file system it lies on."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self.at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write aside, then rename; False if the name is taken."""
        aside = self.at(f"_aside/{uuid.uuid4().hex}")
        self.fs.mkdirs(aside.getParent())
        self.fs.mkdirs(self.at(name).getParent())
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        done = not self.fs.exists(self.at(name)) and self.fs.rename(aside, self.at(name))
        if not done:
            self.fs.delete(aside, False)
        return bool(done)

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions, oldest first."""
    return [int(n.removesuffix(".json")) for n in _Files(spark, path).names("versions") if n.endswith(".json")]


def _manifest(files: _Files, version: int) -> dict:
    return json.loads(files.read(f"versions/{version:0{_DIGITS}d}.json"))


def _read_buckets(spark: SparkSession, files: _Files, manifest: dict, buckets=None) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    chosen = {b: f for b, f in manifest["buckets"].items() if buckets is None or int(b) in buckets}
    if not chosen:
        return spark.createDataFrame([], schema)
    folders = sorted(f"{files.root}/{folder}/{_BUCKET}={b}" for b, folder in chosen.items())
    return spark.read.schema(schema).parquet(*folders)


def read_keyed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the last."""
    have = versions(spark, path)
    if not have or (version is not None and version not in have):
        raise FileNotFoundError(f"{path} has no version {'at all' if version is None else version}")
    files = _Files(spark, path)
    return _read_buckets(spark, files, _manifest(files, have[-1] if version is None else version))


def _bucket(keys, n: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def write_upsert(df: DataFrame, path: str, keys, buckets: int = 64) -> tuple[str, dict, int]:
    """The first half of an upsert: the new buckets, written but not published.  Returns the
    arguments of ``publish_upsert``."""
    keys, spark = list(keys), df.sparkSession
    files, have = _Files(spark, path), versions(spark, path)
    old = _manifest(files, have[-1]) if have else {"keys": keys, "n": buckets, "buckets": {}, "schema": df.schema.jsonValue()}
    if old["keys"] != keys:
        raise ValueError(f"{path} has the keys {old['keys']}, not {keys}")
    schema = T.StructType.fromJson(old["schema"])
    added = [f for f in df.schema.fields if f.name not in schema.names]
    changed = [f.name for f in df.schema.fields if f.name in schema.names and f.dataType != schema[f.name].dataType]
    if changed:
        raise ValueError(f"{path} holds {changed} with other types")
    for f in added:
        schema = schema.add(f.name, f.dataType, True)
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the key {tuple(twice[0])[:-1]} occurs {twice[0]['n']} times")
    new = df.withColumn(_BUCKET, _bucket(keys, old["n"]))
    touched = {r[_BUCKET] for r in new.select(_BUCKET).distinct().collect()}  # at most the number of buckets
    before = _read_buckets(spark, files, old, touched).withColumn(_BUCKET, _bucket(keys, old["n"]))
    n, k = before.alias("n"), new.select(_BUCKET, *keys).alias("k")
    same = [F.col(f"n.{_BUCKET}") == F.col(f"k.{_BUCKET}"), *[F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys]]
    merged = n.join(k, same, "left_anti").unionByName(new, allowMissingColumns=True).select(*schema.names, _BUCKET)
    folder = f"data/{uuid.uuid4().hex}"
    merged.repartition(max(1, len(touched)), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{files.root}/{folder}")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    manifest = {"keys": keys, "n": old["n"], "schema": nullable.jsonValue(), "buckets": {**old["buckets"], **{str(b): folder for b in sorted(touched)}}}
    return path, manifest, have[-1] + 1 if have else 1


def publish_upsert(spark: SparkSession, path: str, manifest: dict, version: int) -> int:
    """The second half: one rename makes the version the last one."""
    if not _Files(spark, path).publish(f"versions/{version:0{_DIGITS}d}.json", json.dumps(manifest)):
        raise ConcurrentWrite(f"{path} already has version {version}; run the upsert again")
    return version


def upsert_keyed(df: DataFrame, path: str, keys, buckets: int = 64) -> int:
    """Rows of ``df`` replace those of the same ``keys`` (a null is a key like any other) and
    the others are added; returns the version.  A column that the table lacks is added,
    null in older rows; one that ``df`` lacks becomes null in its rows.  ``buckets`` counts
    when the table is made: about one for each GB it will hold."""
    return publish_upsert(df.sparkSession, *write_upsert(df, path, keys, buckets))


def clean_keyed(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions, and folders that no version names (also
    those of an upsert that is still running: call it between writes).  Returns the number
    of folders removed."""
    files, have = _Files(spark, path), versions(spark, path)
    for v in have[:-keep]:
        files.remove(f"versions/{v:0{_DIGITS}d}.json")
    named = {f for v in have[-keep:] for f in _manifest(files, v)["buckets"].values()}
    unnamed = [f"data/{n}" for n in files.names("data") if f"data/{n}" not in named]
    for name in unnamed:
        files.remove(name)
    return len(unnamed)
