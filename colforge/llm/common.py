"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colforge.session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII white-space characters.
#: ``bytes.split()`` without arguments splits UTF-8 at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows in one Arrow batch: texts can be long, so fewer than Spark's 10,000.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on, each set only where it has Spark's default."""
    ensure_checkpoint_dir(spark)
    for key, default, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", str(ARROW_ROWS)),
        ("spark.sql.python.filterPushdown.enabled", "false", "true"),
    ):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for a null text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem`` with underscores added until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
