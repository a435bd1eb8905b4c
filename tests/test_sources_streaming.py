"""Sources, sinks and the streaming path."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from colforge.session import scratch_path
from colforge.sources import files

SF = "/root/testdata/sf0.001"


def test_csv_missing_tokens_and_bad_numbers(spark):
    path = scratch_path(spark, "test-csv")
    rows = [("1", "a", "1.5"), ("2", "NA", "abc"), ("3", "", "nan"), ("4", "x", " 2 ")]
    spark.createDataFrame(rows, "k string, t string, v string").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    got = sorted((r.k, r.t, r.v) for r in files.read_table_csv(spark, path, schema).collect())
    assert got == [(1, "a", 1.5), (2, None, None), (3, None, None), (4, "x", 2.0)]


def test_keyed_sink_is_idempotent(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", F.year("o_orderdate").alias("y"))
    path = scratch_path(spark, "test-sink")
    files.write_keyed(o, path, ["y"])
    files.write_keyed(o.where(F.col("y") == 1996), path, ["y"])
    back = spark.read.parquet(path)
    assert back.count() == o.count()
    assert back.select("o_orderkey").distinct().count() == o.count()


def test_stream_scoring_scores_every_row(spark):
    out = entry.queries()["sm2_stream_scoring"](spark, SF)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert out.count() == n and out.where(F.col("predicted").isNull()).count() == 0
