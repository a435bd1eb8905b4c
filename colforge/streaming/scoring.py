"""Incremental preparation and scoring of arriving fixture files with Structured Streaming.

The reference re-downloads and re-prepares the day's fixtures in one batch.  Here new
files are picked up by a file stream source; the preparation (stateless projections,
one filter and a stream-static lookup join) and a fitted model's ``transform`` run per
micro-batch, and each batch is written by ``foreachBatch`` to its own folder with
overwrite, so a retried batch replaces its output instead of duplicating it.
The checkpoint lives under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.clean import ObservedSteps
from ..session import scratch_path


def file_stream(spark: SparkSession, path_glob: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """A streaming DataFrame over the files matching ``path_glob`` (explicit schema)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path_glob)


def run_available_now(stream: DataFrame, sink: str, checkpoint: str | None = None, transform=None,
                      fmt: str = "parquet") -> str:
    """Process everything available now, batch by batch, then stop.

    ``transform(batch_df)`` may apply batch-only steps (a model with joins against
    static tables); each batch lands in ``<sink>/batch=<id>`` with overwrite (idempotent).
    Returns the sink path.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").format(fmt).save(f"{sink}/batch={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()  # however long the backlog is
    if q.exception():
        raise q.exception()
    return sink


def prepare_with_report(stream: DataFrame, sink: str, report_sink: str, prepare, checkpoint: str | None = None) -> str:
    """Prepare arriving rows and report what was removed, batch by batch, each in one pass.

    ``prepare(batch, observed)`` gives the prepared rows of a batch and has ``observed``
    (``ObservedSteps``) watch its filters.  The report of a batch lands in
    ``<report_sink>/batch=<id>``; both writes overwrite, so a retried batch replaces its own."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-checkpoint")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        observed = ObservedSteps()
        prepare(batch, observed).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        observed.report(batch.sparkSession).write.mode("overwrite").parquet(f"{report_sink}/batch={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return sink


def read_sink(spark: SparkSession, sink: str, fmt: str = "parquet") -> DataFrame:
    """All batches written so far (the ``batch`` folder level is dropped)."""
    df = spark.read.format(fmt).load(sink)
    return df.drop("batch") if "batch" in df.columns else df


def score_stream(stream: DataFrame, model, sink: str, keys, checkpoint: str | None = None) -> str:
    """Score arriving rows with a fitted ``TrainedModel`` (keys, call, probabilities)."""
    keys = list(keys)

    def score(batch: DataFrame) -> DataFrame:
        pred = model.transform(batch)
        return pred.select(*keys, "predicted", *model.probability_columns)

    return run_available_now(stream, sink, checkpoint, transform=score)
