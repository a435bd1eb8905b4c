"""Session helpers: building a session, the shared checkpoint folder, lineage cuts
and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; wide projections of CASE
    # chains (bands, targets, 100-column fixture rows) otherwise run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_TUNING = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000")}


def tune_session(spark: SparkSession) -> None:
    """Apply the library's runtime SQL settings to a session someone else built, but only
    where the session still has Spark's default value."""
    for key, (default, value) in _TUNING.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def get_session(app: str = "colforge", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults.

    On a cluster the master and resources come from spark-submit; ``master`` is only
    for local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    tune_session(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without one (tests) gets a
    fresh private folder; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for lineage cuts")
    path = tempfile.mkdtemp(prefix="colforge-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/colforge/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str = "stage") -> str:
    """Write ``df`` as Parquet to a fresh folder below the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet to the shared checkpoint folder and
    reading it back.  Recomputing a lost partition then re-reads the file instead of
    re-running the upstream shuffle, and nondeterministic columns are fixed once."""
    return df.sparkSession.read.parquet(write_scratch(df, name))


#: Folders that ``materialize`` wrote and ``clear_scratch`` has not removed yet.
_WRITTEN: list[str] = []


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Remove one folder of ``write_scratch``, as an iteration does with the table before
    the last one it wrote."""
    if path in _WRITTEN:
        _WRITTEN.remove(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))


def clear_scratch(spark: SparkSession) -> int:
    """Remove what ``materialize`` has written in this process; frames that still read it
    can no longer be run.  Returns the number of folders.  Call it when the results are
    stored; it also runs when the Python process ends with the session still up."""
    n = 0
    while _WRITTEN:
        n += remove_scratch(spark, _WRITTEN[-1])
    return n


def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if _WRITTEN and spark is not None and spark.sparkContext._jsc is not None:
        clear_scratch(spark)


atexit.register(_clear_at_exit)


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than max_rows+1."""
    return df.limit(max_rows + 1).count() <= max_rows


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan.  A failure is the caller's to see: an unknown
    size must not pass for a small one."""
    v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(v) if isinstance(v, int) else int(v.toString())


def bounded_broadcast(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """Broadcast hint only behind a proven row bound (a ``limit(n+1)`` count) and a
    plan size estimate under ``max_bytes``; otherwise the plain frame, for which AQE
    still picks a broadcast at run time if the shuffled side turns out small."""
    if estimated_bytes(df) <= max_bytes and row_count_at_most(df, max_rows):
        return F.broadcast(df)
    return df


def local_session_for_tests(cores: int = 8) -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    return get_session("colforge-tests", master=f"local[{cores}]", shuffle_partitions=cores,
                       extra={"spark.driver.memory": "8g"})
