"""Shared helpers for the registered queries: table access and testdata stand-ins.

Each stand-in expression is written once for Spark; the oracle SQL spells out the same
expression by hand (see FIXTURES.md §4 for the bindings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def count_by(df: DataFrame, *cols) -> DataFrame:
    """Group by the given columns and count: a compact, order-free result shape."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


# Stand-in columns on lineitem (same text is used in the oracle SQL).
def home_goals():
    return F.col("l_linenumber").cast("double")


def away_goals():
    return F.expr("CAST(nullif(l_partkey % 8, 7) AS DOUBLE)")


AWAY_SQL = "CAST(nullif(l_partkey % 8, 7) AS DOUBLE)"
HOME_SQL = "CAST(l_linenumber AS DOUBLE)"
