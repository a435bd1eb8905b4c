"""Packing of token sequences by the configuration linear program.

A document is its token ids and one end id.  Documents longer than a sequence are cut into
full pieces, of which the first is what is left over.  Only the histogram of piece lengths
(at most ``capacity`` rows) reaches the driver.  There, the linear program over
configurations (which lengths share a sequence) is solved by multiplicative weights: each
length has a price, the best-paid configuration is found by a knapsack dynamic programme,
and its lengths get cheaper.  The fractional solution is rounded down; what is left is
filled up, configuration by configuration, by the same knapsack with the lengths
themselves as prices.  The work depends on the lengths and not on the number of documents.

The pieces get their places from the plan by their number within their length: numbers
inside a task are given while the tokens are counted, and the tasks' offsets are sums over
(task, length) counts.  Token ids never leave the task; a piece carries their CRC-32.

Ids are those of the ``tokenizers`` library on the given file.  Its byte-pair merges run
in ``tiktoken`` (measured five times as fast, with equal ids) on the vocabulary of that
same file, which is checked to rank merges by id; texts with a special token's string, and
files of another kind, take the ``tokenizers`` library itself.

Defined results: a null or empty text is one piece, the end id alone.  Repeated rows are
packed one by one.  An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colforge.session import materialize

from .common import prepare

#: How byte-level vocabularies of this kind cut a text into words.
_WORD_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def _byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def id_encoder(tokenizer_json: str) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids (unsigned 32-bit integers)."""
    import tokenizers

    spec = json.loads(tokenizer_json)
    whole = tokenizers.Tokenizer.from_str(tokenizer_json)

    def by_library(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    ranks = _ranks(spec)
    if ranks is None:
        return by_library
    import tiktoken

    merge = tiktoken.Encoding("file", pat_str=_WORD_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    specials = [t["content"] for t in spec.get("added_tokens", [])]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in specials):
            return by_library(text)
        return np.array(merge(text), dtype="<u4")

    return encode


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings by id if the file is a plain byte-level BPE whose merges are in the
    order of their ids, cut like ``_WORD_SPLIT``; else None."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    if (pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer")
            or model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))):
        return None
    alphabet, vocab = _byte_alphabet(), model["vocab"]
    added = {t["content"] for t in spec.get("added_tokens", [])}
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in merged or merged != sorted(merged):
        return None
    try:
        return {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in added}
    except KeyError:
        return None


def token_pieces(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text: str = "text",
                 capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of each document: ``id_col``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, and ``task`` and ``nth``, which number the pieces of a length."""
    spec = df.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = np.array([end_id], dtype="<u4")
    id_type = df.schema[id_col].dataType
    schema = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = id_encoder(spec.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows, owner = [], []
            for i, t in enumerate(batch.column(1)):
                raw = np.append(encode(t.as_py() or ""), end).astype("<u4").tobytes()
                n = len(raw) // 4
                at, size = 0, (n - 1) % capacity + 1
                for piece in range((n - 1) // capacity + 1):
                    rows.append((piece, at, size, zlib.crc32(raw[4 * at:4 * (at + size)]), task, seen[size]))
                    owner.append(i)
                    seen[size] += 1
                    at, size = at + size, capacity
            columns = zip(*rows) if rows else [[]] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *arrays], ["id", *schema.names])

    from pyspark.sql.types import IntegerType, LongType, StructField, StructType
    out = StructType([StructField("id", id_type), StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()),
                      StructField("ids_crc32", LongType()), StructField("task", IntegerType()), StructField("nth", LongType())])
    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(cut, out).withColumnRenamed("id", id_col)


def price_table(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the best total price within each room up
    to ``capacity``, and the length taken last to get it (0: leave one token empty)."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := upto[room]:
            got = best[room - lengths[:k]] + price[:k]
            j = got.argmax()
            if got[j] > best[room]:
                best[room], last[room] = got[j], lengths[j]
    return best, last


def solve_configurations(count: np.ndarray, capacity: int, rounds: int = 150, eta: float = 3.0, wide: int = 256) -> dict[tuple[int, ...], float]:
    """Multiplicative weights for the configuration program: how many sequences each
    configuration (its lengths in order) should have, a fraction.

    Prices start at the lengths, a feasible dual.  In every round the knapsack gives, for
    each length, the best-paid configuration that holds it; those paid nearly best share
    the round's sequences.  Lengths covered ahead of the round get cheaper, those behind
    dearer."""
    lengths = np.flatnonzero(count)
    need = count[lengths].astype(float)
    total = float((lengths * need).sum()) / capacity
    price, got, used = lengths / capacity, np.zeros(len(lengths)), {}
    at = np.zeros(capacity + 1, dtype=np.int64)
    at[lengths] = np.arange(len(lengths))
    for r in range(rounds):
        best, last = price_table(lengths, price, capacity)
        pay = price + best[capacity - lengths]
        paid = np.argsort(-pay, kind="stable")
        paid = paid[pay[paid] >= 0.99 * pay[paid[0]]][:wide]
        found = set()
        for j in paid:
            conf, room = [int(lengths[j])], capacity - int(lengths[j])
            while room > 0:
                step = int(last[room])
                if step:
                    conf.append(step)
                room -= step or 1
            found.add(tuple(sorted(conf, reverse=True)))
        for conf in sorted(found):
            idx = at[list(conf)]
            share = min(total / rounds / len(found), 0.25 * need[idx].min())
            used[conf] = used.get(conf, 0.0) + share
            np.add.at(got, idx, share)
        price = price * np.exp(np.clip(eta * ((r + 1) / rounds - got / need), -0.5, 0.5) / 4)
    return used


def _complete(left: np.ndarray, room: int) -> list[int]:
    """Lengths still ``left`` that fill ``room``: one or two that fill it wholly, else the
    largest that fits and then on."""
    out: list[int] = []
    while room > 0:
        if left[room] > 0:
            return [*out, room]
        low = np.flatnonzero(left[1:room] > 0) + 1
        if not len(low):
            return out
        twin = low[(left[room - low] > 0) & ((2 * low != room) | (left[low] > 1))]
        if len(twin):
            return [*out, int(room - twin[0]), int(twin[0])]
        big = int(low[-1])
        out.append(big)
        room -= big
        left = left.copy()
        left[big] -= 1
    return out


def round_plan(count: np.ndarray, used: dict[tuple[int, ...], float], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and whole numbers of sequences that hold every length exactly
    ``count`` times: the fractional plan rounded, then the rest filled up largest first."""
    left, plan = count.copy(), []

    def put(conf: tuple[int, ...], most: int) -> None:
        each = np.unique(np.array(conf), return_counts=True)
        n = min(most, int((left[each[0]] // each[1]).min()))
        if n > 0:
            left[each[0]] -= n * each[1]
            plan.append((conf, n))

    for conf, x in sorted(used.items(), key=lambda kv: (-kv[1], kv[0])):
        if sum(conf) == capacity:  # a configuration with room to spare is left to the second step
            put(conf, int(x))
    for length in range(capacity, 0, -1):
        while left[length] > 0:
            rest = left.copy()
            rest[length] -= 1
            put((length, *_complete(rest, capacity - length)), int(left[length]))
    return plan


def place_pieces(pieces: DataFrame, plan: list[tuple[tuple[int, ...], int]], capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset``.  ``plan`` has some thousand configurations at
    most, whatever the number of documents."""
    slots, first = [], 0  # (length, sequences before, number of sequences, slots in each, offset)
    for conf, n in plan:
        offset = 0
        for length in dict.fromkeys(conf):
            k = conf.count(length)
            slots.append((length, first, n, k, offset))
            offset += k * length
        first += n
    slots.sort(key=lambda s: (s[0], s[1]))
    cols = np.array(slots, dtype=np.int64).reshape(-1, 5)
    ends = np.cumsum(cols[:, 2] * cols[:, 3])  # places are numbered through all lengths
    base = np.zeros(capacity + 2, dtype=np.int64)
    np.add.at(base, cols[:, 0] + 1, cols[:, 2] * cols[:, 3])
    shared = pieces.sparkSession.sparkContext.broadcast((cols, ends, np.cumsum(base)))

    tasks = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(F.col("task").alias("t"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = (pieces.join(tasks, (F.col("task") == F.col("t")) & (F.col("length") == F.col("l")))
                .withColumn("nth", F.col("nth") + F.col("before")).drop("t", "l", "before", "task"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, nth):
        import pandas as pd

        cols, ends, base = shared.value
        size = length.to_numpy()
        number = base[size] + nth.to_numpy()
        j = np.searchsorted(ends, number, side="right")
        _, first, n, k, offset = cols[j].T
        within = number - (ends[j] - n * k)
        return pd.DataFrame({"sequence_id": first + within // k, "offset": offset + within % k * size})

    placed = numbered.withColumn("at", place("length", "nth"))
    return placed.withColumn("sequence_id", F.col("at.sequence_id")).withColumn("offset", F.col("at.offset")).drop("at", "nth")


def pack_documents(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text: str = "text",
                   capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece of every row of ``df``: ``id_col``, ``piece``, ``start``,
    ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``."""
    prepare(df.sparkSession)
    pieces = materialize(token_pieces(df, tokenizer_json, id_col, text, capacity, end_id), "pieces")
    count = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``capacity`` rows
        count[row["length"]] = row["n"]
    plan = round_plan(count, solve_configurations(count, capacity), capacity) if count.any() else []
    return place_pieces(pieces, plan, capacity)
