"""The corpus pipeline: five stages, each on all rows that the one before kept.

Language identification drops documents without a known language.  SimHash keeps one
document of each group of near copies.  The secret scan masks what it finds and keeps the
document.  Mixing repeats or leaves out documents so that sources come near their target
weights.  Packing gives every token piece its place in a sequence; its rows are the
pipeline's result.  Each stage's rows are written as Parquet to the shared folder and read
again as the next one's documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from colforge.llm import langid, mixing, packing, secrets, simhash  # noqa: E402
from colforge.llm.common import prepare, table  # noqa: E402
from colforge.llm.queries import read_tokenizer  # noqa: E402
from colforge.session import materialize  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language.  ``lang`` stays as it was given."""
    prepare(spark)
    found = langid.identify_languages(docs, langid.learn(docs), out="_language")
    return found.where("_language.accepted").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and ``n_chars`` counted again."""
    prepare(spark)
    clean = secrets.redact(secrets.scan_secrets(docs, out="_spans"), spans="_spans")
    masked = F.when(F.size("_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", masked).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    prepare(spark)
    return packing.pack_documents(docs, read_tokenizer())


STAGES = [("language_id", identify), ("simhash_near_dedup", deduplicate), ("secret_scan", mask_secrets),
          ("source_mixing", mix), ("best_fit_packing", pack)]

#: Fingerprints, automata and token ids are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
