"""Document fingerprints as quartile bucket digests.

Byte triplets of a window that slides over the text (contiguous, and with a gap of one
or two bytes) are hashed to buckets and counted.  The digest holds, for each bucket, the quartile its
count falls in (two bits), the ratios of the quartiles, and the length on a log scale.
Two digests are compared by a difference score: bucket distances, the ratios and the
length each add to it, and each part is bounded.

``neighbour_digests`` compares each document with an edited version of itself and with the
next document by id.  Documents are dealt to ranges of ids, with each range's first
document also sent to the range before it, so no task and no group holds more than a
range; the order needs no global sort.

Defined results: a null text is empty; texts under five bytes have no triplets and differ
by length alone.  Rows that share an id, and rows without one, which come last, are in the
order of a hash of their texts.  A single document is its own next document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import prepare

BUCKETS = 256
#: Bytes hashed at a time, so that a very long text needs bounded memory.
BLOCK = 1 << 20
#: Offsets of the three bytes of each triplet kind.
KINDS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4))


def digest(text: str | None) -> str:
    """Hex: two digits of length, two of quartile ratios, then two bits for each bucket."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    span = 1 + max(k[2] for k in KINDS)
    for at in range(0, max(0, len(raw) - span + 1), BLOCK):
        part = raw[at:at + BLOCK + span - 1].astype(np.uint32)
        n = len(part) - span + 1
        for salt, (a, b, c) in enumerate(KINDS):
            key = part[a:a + n] * np.uint32(0x9E3779B1) ^ part[b:b + n] * np.uint32(0x85EBCA77) ^ part[c:c + n] * np.uint32(0xC2B2AE3D) ^ np.uint32(0x27D4EB2F * (salt + 1) & 0xFFFFFFFF)
            key ^= key >> np.uint32(15)
            key *= np.uint32(0x2C1B3C6D)
            counts += np.bincount(key >> np.uint32(24), minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    level = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, round(8 * math.log2(len(raw) + 1)))
    ratio = [int(16 * q // q3) % 16 if q3 else 0 for q in (q1, q2)]
    packed = (level[0::4] << 6 | level[1::4] << 4 | level[2::4] << 2 | level[3::4]).astype(np.uint8)
    return f"{length:02x}{ratio[0]:x}{ratio[1]:x}{packed.tobytes().hex()}"


def _levels(fp: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(fp[4:]), dtype=np.uint8)
    return np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1).ravel().astype(np.int64)


def difference(a: str, b: str) -> int:
    """Bounded difference score, 0 for equal digests: buckets count their distance, with 6
    for opposite quartiles; ratios up to 15 each in a ring; length up to 64."""
    if a == b:
        return 0
    gap = np.abs(_levels(a) - _levels(b))
    body = int(np.where(gap == 3, 6, gap).sum())
    ring = sum(min((d := abs(int(a[i], 16) - int(b[i], 16))), 16 - d) for i in (2, 3))
    return body + 2 * ring + min(64, abs(int(a[:2], 16) - int(b[:2], 16)))


#: The score at which the likeness reaches 0: what unrelated random digests come to.
FAR = BUCKETS * 3 // 2


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling to 0 at a difference of ``FAR``."""
    return 1.0 - min(difference(a, b), FAR) / FAR


def digest_column(text: str = "text"):
    @F.pandas_udf("string")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(t) for t in texts], dtype="object")
    return fp(F.col(text))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the first as many characters of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def neighbour_digests(df: DataFrame, id_col: str = "doc_id", text: str = "text", rows_per_range: int = 1000,
                      max_ranges: int = 20_000) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    The limits and first keys of the ranges reach the driver, at most ``max_ranges`` of
    them; beyond that the ranges grow, and are still streamed through a task in order."""
    spark = prepare(df.sparkSession)
    if df.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError("documents are dealt to ranges of integer ids")
    ids = df.select(F.col(id_col).alias("id"))
    seen = ids.agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("known")).first()
    ranges = max(1, min(max_ranges, seen["known"] // rows_per_range))
    at = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(ids.agg(F.percentile_approx("id", at, 10 * ranges).alias("q")).first()["q"])) if at else []
    unnamed = max(1, min(max_ranges, (seen["n"] - seen["known"]) // rows_per_range))

    limits = spark.sparkContext.broadcast(np.array(cuts))

    @F.pandas_udf("int")
    def range_of(id_: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits.value, id_.to_numpy(), side="right").astype("int32"))

    # Rows without an id follow in the order of a hash of their text, dealt by that hash.
    by_hash = F.floor((F.shiftright("h", 32) + F.lit(1 << 31)) * unnamed / F.lit(1 << 32)).cast("int") + len(cuts) + 1
    named = range_of(F.coalesce(F.col("id"), F.lit(0).cast(df.schema[id_col].dataType))) if cuts else F.lit(0)
    rows = (df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text"))
            .withColumn("r", F.when(F.col("id").isNull(), by_hash).otherwise(named)))
    key = F.struct(F.col("id"), F.col("h"))
    first = sorted(((x["r"], x["k"]["id"], x["k"]["h"]) for x in rows.groupBy("r").agg(F.min(key).alias("k")).collect()))
    before = {r: first[i - 1][0] for i, (r, _, _) in enumerate(first)}
    heads = spark.createDataFrame([(r, i, h, before[r]) for r, i, h in first], f"r int, i {df.schema[id_col].dataType.simpleString()}, fh long, before int")
    dealt = (rows.join(F.broadcast(heads), "r")  # one row for each range
             .withColumn("lead", F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("fh")))
             .select("id", "h", "text", F.explode(F.when(F.col("lead"), F.array(F.struct(F.col("r"), F.lit(False).alias("after")), F.struct(F.col("before").alias("r"), F.lit(True).alias("after"))))
                                                  .otherwise(F.array(F.struct(F.col("r"), F.lit(False).alias("after"))))).alias("to"))
             .select("to.r", "to.after", "id", "h", "text"))
    ordered = dealt.repartition("r").sortWithinPartitions("r", "after", F.col("id").asc_nulls_last(), "h").select("r", "after", "id", "text")
    fields = [StructField("id", df.schema[id_col].dataType), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
              StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
              StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())]
    return ordered.mapInArrow(_compare, StructType(fields)).withColumnRenamed("id", id_col)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, then the first document of the range after it."""
    waiting = None  # (range, id, text, digest) of the row whose next document has not come
    done = None  # the range whose last row has met its next document
    for batch in batches:
        out: list[tuple] = []
        for r, after, id_, text in zip(*(batch.column(i) for i in range(4))):
            r, after, text = r.as_py(), after.as_py(), text.as_py()
            if after and done == r:
                continue
            fp = digest(text)
            if waiting is not None:
                _, own_id, own, own_fp = waiting
                new = edited(own, text)
                new_fp = digest(new)
                out.append((own_id, len(own), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own_fp, new_fp,
                            likeness(own_fp, new_fp), likeness(own_fp, fp)))
            waiting, done = (None, r) if after else ((r, id_.as_py(), text, fp), done)
        names = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        columns = list(zip(*out)) or [[]] * len(names)
        kinds = (batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
