"""Table sources and sinks (IO1–IO7).

CSV is read with an explicit all-text schema (no inference pass over the data), then
missing tokens become NULL and numbers are coerced with ``try_cast``; the reference's
inferred dtypes become a declared ``StructType``.  Sinks are idempotent: a partitioned
overwrite replaces exactly the partitions being written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import band_unit
from ..functions.missing import text_token_to_null
from ..operators.clean import exclude_values


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """IO1: read CSV text with a header as all-text columns, map missing tokens to NULL
    and cast to ``schema`` (bad numbers → NULL, never an error)."""
    raw = (spark.read.schema(_text_schema(schema)).option("header", header).option("sep", sep)
           .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))
    cols = []
    for f in schema.fields:
        x = text_token_to_null(F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            cols.append(x.alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            cols.append(x.try_cast(f.dataType).alias(f.name))
        else:
            num = F.trim(x).try_cast(f.dataType)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                num = F.nanvl(num, F.lit(None).cast(f.dataType))
            cols.append(num.alias(f.name))
    return raw.select(*cols)


def write_table_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "ISO-8859-1",
                    mode: str = "overwrite") -> None:
    """IO2: header, no index column; NULL written as an empty field."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
       .option("emptyValue", "").csv(path))


def band_scores(df: DataFrame, score_cols) -> DataFrame:
    """BD3 over the listed score columns, in one projection."""
    return df.withColumns({c: band_unit(c) for c in score_cols if c in df.columns})


def load_training(df: DataFrame, score_cols, exclude_col: str | None = None, exclude=()) -> DataFrame:
    """IO3: training load: drop excluded values (keeping missing), band the scores."""
    out = exclude_values(df, exclude_col, exclude) if exclude_col and exclude else df
    return band_scores(out, score_cols)


def load_validation(df: DataFrame, score_cols) -> DataFrame:
    """IO4: validation load: band only."""
    return band_scores(df, score_cols)


def load_for_prediction(df: DataFrame, score_cols, ts_col: str, since) -> DataFrame:
    """IO5: rows at or after ``since`` (a predicate the Parquet scan can push down),
    banded.  Ordering by time is left to the output edge (``orderBy`` on a sink)."""
    return band_scores(df.where(F.col(ts_col) >= F.lit(since)), score_cols)


def write_keyed(df: DataFrame, path: str, partition_cols=(), fmt: str = "parquet") -> None:
    """IO7: idempotent sink: with ``partitionOverwriteMode=dynamic`` a rerun replaces
    only the partitions present in ``df``; nothing is sent row by row."""
    w = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)

