"""Vector codes: product-quantisation codebooks learned by active-entry Lloyd rounds.

Every vector becomes integers and is cut into parts; each part position has a codebook of
a few entries.  A round assigns every part to its nearest entry and moves the entries to
the means of their parts.  A part whose entry did not move still has the exact distance
that was stored with it, so only the entries that moved can beat it: it is compared with
those alone.  The other parts are compared with all entries.  Both ways find the smallest
(distance, index), so ties go to the lower index as in a complete scan.

The vectors with their codes and distances are one table in the shared folder, written
anew each round; the round before it is removed only when the next is complete.  A task
adds the sums of its parts by entry as a few rows of the same table, so a round reads the
vectors once, and what reaches the driver is one row per entry.

Defined results: a row is dropped if its vector is null or empty, has a null or
non-finite component or one whose integer is beyond ``MAX_INT`` (its squared distance
would not fit a long), or is not as long as the vector of the smallest id.  Rows of one id are coded each
by itself; as a starting entry an id counts once, with its smallest vector; a null id
comes last.  With fewer ids than entries the codebooks are that much shorter.  A length
that the parts do not divide gives parts whose lengths differ by one (an empty part has
code 0).  No kept row gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colforge.session import bounded_broadcast, remove_scratch, write_scratch

from .common import free_name, prepare

#: Largest magnitude of an integer component: 64 squared differences of such integers stay
#: below 2^63.
MAX_INT = 1 << 27


@dataclass
class Codebooks:
    scale: int
    bounds: list[int]  # where each part begins, and the end of the last one
    entries: list[np.ndarray]  # for each part, its entries (rows) as 64-bit integers

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimals with commas."""
        text = ",".join(str(int(x)) for part in self.entries for x in part.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Of every row of ``x`` to every entry."""
    diff = x[:, None, :] - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def scan_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry, the lowest index among equals, and its squared distance."""
    d = squared_distances(x, entries)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def scan_active(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray,
                dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the codes and distances of the round before: parts whose entry stayed
    are compared with the ``moved`` entries, the others with all."""
    code, dist = code.copy(), dist.copy()
    rescan = np.isin(code, moved)
    if rescan.any():
        code[rescan], dist[rescan] = scan_all(x[rescan], entries)
    stay = np.flatnonzero(~rescan)
    if len(stay) and len(moved):
        near, d = scan_all(x[stay], entries[moved])
        near = moved[near]
        better = (d < dist[stay]) | ((d == dist[stay]) & (near < code[stay]))
        code[stay[better]], dist[stay[better]] = near[better], d[better]
    return code, dist


def usable(vector: str, scale: int) -> Column:
    """Rows whose vector can be coded, whatever its length.  NaN passes no comparison."""
    ok = F.forall(vector, lambda x: F.coalesce(F.abs(x) * scale <= float(MAX_INT), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & ok, F.lit(False))


def first_vectors(rows: DataFrame, n: int) -> list[list[float]]:
    """The vectors (column ``x``) of the ``n`` smallest ids (column ``k``); an id's smallest
    vector, all of the length of the first.  Every reading finds one more id at least."""
    got: list[list[float]] = []
    key = F.col("k")
    left = rows.where(key.isNotNull())
    while len(got) < n:
        batch = left.select("k", "x").orderBy("k", "x").limit(n).collect()
        last = None
        for r in batch:
            if not got:
                rows = rows.where(F.size("x") == len(r["x"]))
                left = left.where(F.size("x") == len(r["x"]))
            if r["k"] != last and len(got) < n and (not got or len(r["x"]) == len(got[0])):
                got.append(list(r["x"]))
            last = r["k"]
        if len(batch) < n:
            break
        left = rows.where(key > F.lit(last))
    if len(got) < n:
        none = rows.where(key.isNull()).select("x").orderBy("x").limit(1).collect()
        got += [list(r["x"]) for r in none if not got or len(r["x"]) == len(got[0])]
    return got


def _matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width), type=pa.int32()),
                                    pa.array(values.ravel(), type=kind))


def assign_round(rows: DataFrame, now: Codebooks, before: Codebooks | None) -> DataFrame:
    """One assignment.  ``rows`` has ``k``, ``g`` and either ``x`` (vectors as given; the
    first round) or ``v``, ``c``, ``e``: integers, codes and distances after ``before``.
    The result has the latter, and rows with ``part``, ``entry``, ``n`` and ``sums``."""
    prepare(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast((now, before))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    longs = T.ArrayType(T.LongType())
    fields = {"k": kinds["k"], "g": kinds["g"], "v": T.ArrayType(T.IntegerType()), "c": T.ArrayType(T.ShortType()), "e": longs,
              "part": T.IntegerType(), "entry": T.IntegerType(), "n": T.LongType(), "sums": longs}
    schema = T.StructType([T.StructField(k, t) for k, t in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = shared.value
        d, parts = now.bounds[-1], len(now.entries)
        cut = [slice(a, b) for a, b in zip(now.bounds, now.bounds[1:])]
        moved = [np.flatnonzero((a != b).any(axis=1)) for a, b in zip(now.entries, before.entries)] if before else None
        count = [np.zeros(len(e), dtype=np.int64) for e in now.entries]
        total = [np.zeros(e.shape, dtype=np.int64) for e in now.entries]
        names = None
        for b in batches:
            if not b.num_rows:
                continue
            if before is None:
                v = np.floor(now.scale * _matrix(b.column("x"), d, np.float64)).astype(np.int64)
                code = dist = None
            else:
                v, code, dist = _matrix(b.column("v"), d), _matrix(b.column("c"), parts), _matrix(b.column("e"), parts)
            new_code, new_dist = np.empty((len(v), parts), dtype=np.int64), np.empty((len(v), parts), dtype=np.int64)
            for j, entries in enumerate(now.entries):
                x = v[:, cut[j]]
                if before is None:
                    new_code[:, j], new_dist[:, j] = scan_all(x, entries)
                else:
                    new_code[:, j], new_dist[:, j] = scan_active(x, entries, moved[j], code[:, j], dist[:, j])
                count[j] += np.bincount(new_code[:, j], minlength=len(entries))
                np.add.at(total[j], new_code[:, j], x)
            n = b.num_rows
            names = (b.column("k").type, b.column("g").type)
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("g"), _lists(v, pa.int32()), _lists(new_code, pa.int16()), _lists(new_dist, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))],
                ["k", "g", "v", "c", "e", "part", "entry", "n", "sums"])
        if names is None:
            return
        own = [(j, i, int(count[j][i]), total[j][i].tolist()) for j in range(parts) for i in np.flatnonzero(count[j])]
        part, entry, n, sums = (list(x) for x in zip(*own))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(own), names[0]), pa.nulls(len(own), names[1]), pa.nulls(len(own), pa.list_(pa.int32())),
             pa.nulls(len(own), pa.list_(pa.int16())), pa.nulls(len(own), pa.list_(pa.int64())), pa.array(part, pa.int32()),
             pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
            ["k", "g", "v", "c", "e", "part", "entry", "n", "sums"])

    return rows.mapInArrow(run, schema)


def moved_entries(written: DataFrame, now: Codebooks) -> Codebooks:
    """The floored means of the parts of each entry; an entry without parts stays."""
    wide = max(e.shape[1] for e in now.entries)
    cells = (written.where(F.col("n").isNotNull()).groupBy("part", "entry")
             .agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(wide)]))
    entries = [e.copy() for e in now.entries]
    for r in cells.collect():  # one row per part position and entry
        row = entries[r["part"]][r["entry"]]
        row[:] = [r[f"s{i}"] // r["n"] for i in range(len(row))]
    return Codebooks(now.scale, now.bounds, entries)


def learn_codes(df: DataFrame, vector: str, id_col: str, label: str | None = None, parts: int = 8, entries: int = 16,
                rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, Codebooks | None]:
    """Codebooks after ``rounds`` rounds, and every kept row's id ``k``, label ``g``,
    integers ``v``, codes ``c`` and squared distances ``e`` under them."""
    spark = prepare(df.sparkSession)
    label_col = F.col(label) if label else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).alias("k"), label_col.alias("g"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where(usable("x", scale))
    start = first_vectors(rows, entries)
    if not start:
        empty = rows.limit(0).select("k", "g", F.lit(None).cast("array<int>").alias("v"),
                                     F.lit(None).cast("array<smallint>").alias("c"), F.lit(None).cast("array<bigint>").alias("e"))
        return empty, None
    d = len(start[0])
    first = np.floor(scale * np.array(start)).astype(np.int64)
    bounds = [j * d // parts for j in range(parts + 1)]
    now, before = Codebooks(scale, bounds, [first[:, a:b].copy() for a, b in zip(bounds, bounds[1:])]), None
    state, path = rows.where(F.size("x") == d), None
    for i in range(rounds + 1):
        written = write_scratch(assign_round(state, now, before), "vector-codes")
        if path:
            remove_scratch(spark, path)
        path, state = written, spark.read.parquet(written)
        new = moved_entries(state, now)
        state = state.where(F.col("n").isNull()).select("k", "g", "v", "c", "e")
        if i == rounds or all(np.array_equal(a, b) for a, b in zip(new.entries, now.entries)):
            break  # entries that all stay leave every later round as it is
        now, before = new, now
    return state, now


def code_text(codes: str | Column) -> Column:
    """Two lower-case hex digits a part."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")


def error_of(distances: str | Column) -> Column:
    return F.aggregate(distances, F.lit(0).cast("long"), lambda a, x: a + x)


def with_group_sum(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of an equal ``group``, nulls together.  Sums
    are made before they are dealt out, and come back by a broadcast of proven size or a
    join whose hot key Spark splits."""
    key = free_name(df, "_group")
    sums = df.groupBy(F.col(group).alias(key)).agg(F.sum(value).alias(out))
    return df.join(bounded_broadcast(sums), F.col(group).eqNullSafe(F.col(key)), "left").drop(key)
