"""Exact k nearest neighbours within each class by a metric index.

Every row has coordinates that never lie further apart than the rows do: its places along
the principal axes of a bounded sample, and its distances to a few pivots of that sample.
A class is cut into cells of near rows (a k-d tree over a sample of the class), about
``CELLS`` of them however many rows it has, and each cell into leaves.  The box of a leaf's
or cell's coordinates bounds all distances to its rows from below.

A cell is searched by itself first; a row's k-th distance there is the radius within which
it looks on.  Only the rows whose own bound to another cell is within their radius visit
it, all of a cell's together; the other cell is brought to them once.  There again only the
leaves within a row's radius are searched.

Within a pair of leaves the leading coordinates in an orthogonal basis and the length of
the rest, and the categories that differ, bound each distance from below, by one matrix
product.  Whole distances are computed for the rows' best bounds, then for those
candidates alone whose bound is within the radius so found.  A visit gives at most
k neighbours a row; no list of all pairs arises, and the result is that of brute force
(ties in distance by key).

Diffuse rows of many independent dimensions lie about equally far from everything: there
every row visits all cells of its class, about ``CELLS`` of them, so what is shuffled still
grows with the rows (until cells reach ``CELL_BYTES``), but all pairs are bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bounded_broadcast, materialize

PIVOTS = 32
SAMPLE_ROWS = 2_000
BLOCK_ROWS = 512

#: Cells of a class, while they hold at most half of ``CELL_ROWS`` rows and ``CELL_BYTES``.
CELLS = 32
CELL_ROWS = 16_384
CELL_BYTES = 8 * 1024 * 1024

#: Principal axes that are coordinates; rows of a sample by which a cell is cut, and bytes of all.
AXES = 16
ROWS_PER_CELL = 64
SAMPLE_BYTES = 32 * 1024 * 1024

#: Up to so many dimensions every block has its own principal axes; beyond, the sample's are used.
OWN_AXES = 256

#: Bounds are kept open by this much, so that rounding never loses a neighbour.
_SLACK = 1e-9


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows of the sample that are far from one another, beginning with the first."""
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def leading_axes(rows: np.ndarray) -> np.ndarray:
    """An orthogonal basis of three quarters of the dimensions: those in which the rows vary
    most."""
    d = rows.shape[1]
    centred = rows - rows.mean(axis=0)
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :max(1, -(-3 * d // 4))]


def coordinates(v: np.ndarray, pivots: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The distances to the pivots, then the places along the axes."""
    out = np.empty((len(v), len(pivots) + axes.shape[1]))
    for at in range(0, len(v), 512):
        m = v[at:at + 512]
        out[at:at + 512, :len(pivots)] = np.sqrt(np.square(m[:, None, :] - pivots[None]).sum(axis=2))
    out[:, len(pivots):] = v @ axes
    return out


def gaps(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, pivots: int) -> np.ndarray:
    """For each row of coordinates and each box, a lower bound of the squared distances."""
    g = np.maximum(np.maximum(lo[None] - x[:, None], x[:, None] - hi[None]), 0)
    return np.maximum(np.square(g[..., :pivots]).max(axis=2, initial=0), np.square(g[..., pivots:]).sum(axis=2))


def _cut(a: np.ndarray, share: float) -> tuple[int, float] | None:
    """The axis along which the rows spread most and the last value below the cut."""
    spread = a.max(axis=0) - a.min(axis=0)
    axis = int(np.argmax(spread))
    if not spread[axis] > 0:
        return None
    line = np.sort(a[:, axis])
    last = line[max(0, min(len(line) - 2, round(len(line) * share) - 1))]
    return axis, float(last if last < line[-1] else line[line < last].max())


def grow(a: np.ndarray, cells: int, first: int = 0):
    """A k-d tree of at most ``cells`` leaves: ``(axis, last, below, above)`` or a leaf's number."""
    cut = _cut(a, cells // 2 / cells) if cells > 1 and len(a) > 1 else None
    if cut is None:
        return first
    below = a[:, cut[0]] <= cut[1]
    return (*cut, grow(a[below], cells // 2, first), grow(a[~below], cells - cells // 2, first + cells // 2))


def route(tree, a: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    out = np.zeros(len(a), dtype=np.int32)
    todo = [(tree, np.arange(len(a)))]
    while todo:
        node, rows = todo.pop()
        if isinstance(node, tuple):
            below = a[rows, node[0]] <= node[1]
            todo += [(node[2], rows[below]), (node[3], rows[~below])]
        else:
            out[rows] = node
    return out


def leaves(a: np.ndarray, most: int) -> list[np.ndarray]:
    """Near rows together, at most ``most`` of them, each in the given order."""
    done, todo = [], [np.arange(len(a))]
    while todo:
        rows = todo.pop()
        cut = _cut(a[rows], 0.5) if len(rows) > most else None
        if cut:
            below = a[rows, cut[0]] <= cut[1]
            todo += [rows[~below], rows[below]]
        else:  # equal rows are cut as they come
            done += [rows[at:at + most] for at in range(0, len(rows), most)]
    return done


def search(q: dict, c: dict, k: int, basis: np.ndarray, weight: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For each row of ``q`` up to ``k`` rows of ``c`` within its squared radius ``q["r2"]``,
    nearest first: (places in c, -1 for none; squared distances; radii; distances computed)."""
    v, w, r2 = q["v"], c["v"], q["r2"]
    a, b = v @ basis, w @ basis
    rest = lambda x, y: np.sqrt(np.maximum(0, np.square(x).sum(axis=1) - np.square(y).sum(axis=1)))
    bound = np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None] - 2 * a @ b.T + np.square(rest(v, a)[:, None] - rest(w, b)[None])
    bound -= _SLACK * (np.square(v).sum(axis=1)[:, None] + np.square(w).sum(axis=1)[None])
    if weight:
        for x, y in zip(q["cat"].T, c["cat"].T):
            bound += weight * (x[:, None] != y[None])
    full = np.full(bound.shape, np.inf)
    left = np.ones(bound.shape, dtype=bool)
    if same:
        np.fill_diagonal(left, False)

    def measure(where: np.ndarray) -> int:
        i, j = np.nonzero(where)
        for at in range(0, len(i), 1 << 16):
            x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            d = np.square(v[x] - w[y]).sum(axis=1)
            if weight:
                d = d + weight * (q["cat"][x] != c["cat"][y]).sum(axis=1)
            full[x, y] = d
        left[where] = False
        return len(i)

    compared = 0
    wide = min(k, bound.shape[1])
    best = np.argpartition(np.where(left, bound, np.inf), wide - 1, axis=1)[:, :wide]
    first = np.zeros(bound.shape, dtype=bool)
    np.put_along_axis(first, best, True, axis=1)
    compared += measure(first & left & (bound <= r2[:, None]))
    if wide >= k:
        r2 = np.minimum(r2, np.partition(full, k - 1, axis=1)[:, k - 1])
    compared += measure(left & (bound <= r2[:, None]))
    # nearest first, ties by key: rows of a leaf are in key order, and the sort is stable
    order = np.argsort(full, axis=1, kind="stable")[:, :k]
    d2 = np.take_along_axis(full, order, axis=1)
    return np.where(np.isfinite(d2), order, -1), d2, r2, compared


def _rows(s: dict, at) -> dict:
    return {n: s[n][at] for n in ("v", "x", "r2", "cat") if n in s}


def look(q: dict, cell: dict, k: int, basis: np.ndarray | None, weight: float, pivots: int, own: int | None = None):
    """As ``search``, over the leaves of a whole cell within the radius of the rows of ``q``,
    which are near one another.  ``own``: the leaf that ``q`` is."""
    m = len(q["v"])
    at, d2, r2, compared = np.full((m, k), -1), np.full((m, k), np.inf), q["r2"].copy(), 0
    far = gaps(q["x"], cell["lo"], cell["hi"], pivots)
    far -= _SLACK * (np.square(q["v"]).sum(axis=1)[:, None] + cell["size"][None])
    if basis is None:
        basis = leading_axes(q["v"])
    nearest = np.argsort(far.min(axis=0), kind="stable").tolist()
    for j in nearest if own is None else [own, *[j for j in nearest if j != own]]:
        rows = np.arange(m) if j == own else np.flatnonzero(far[:, j] <= r2)
        if not len(rows):
            continue
        these = np.arange(cell["starts"][j], cell["starts"][j + 1])
        some = {**_rows(q, rows), "r2": r2[rows]}
        if j != own:
            box = some["x"].min(axis=0)[None], some["x"].max(axis=0)[None]
            back = gaps(cell["x"][these], *box, pivots)[:, 0] - _SLACK * (np.square(some["v"]).sum(axis=1).max() + cell["size"][j])
            these = these[back <= some["r2"].max()]
            if not len(these):
                continue
        found, d, _, n = search(some, _rows(cell, these), k, basis, weight, j == own)
        compared += n
        places = np.concatenate([at[rows], np.where(found >= 0, these[found], -1)], axis=1)
        d = np.concatenate([d2[rows], d], axis=1)
        order = np.lexsort((np.where(places >= 0, cell["rank"][places], 0), d), axis=-1)[:, :k]
        at[rows], d2[rows] = np.take_along_axis(places, order, axis=1), np.take_along_axis(d, order, axis=1)
        r2[rows] = np.minimum(r2[rows], d2[rows, k - 1])
    return at, d2, r2, compared


def _boxes(cell: dict) -> dict:
    """Adds the boxes of the cell's leaves and the squared length of their longest row."""
    starts = cell["starts"][:-1]
    return {**cell, "lo": np.minimum.reduceat(cell["x"], starts), "hi": np.maximum.reduceat(cell["x"], starts),
            "size": np.maximum.reduceat(np.square(cell["v"]).sum(axis=1), starts)}


def _codes(*cats) -> list[np.ndarray]:
    """Categories as numbers, the same in all of the tables."""
    each = [np.array([list(c) for c in cat], dtype=object) for cat in cats]
    codes = pd.factorize(np.concatenate([e.ravel() for e in each]))[0]
    ends = np.cumsum([e.size for e in each])
    return [codes[end - e.size:end].reshape(e.shape) for e, end in zip(each, ends)]


def _found(keys, names, at: np.ndarray, d2: np.ndarray, compared: int) -> Iterator[tuple]:
    for i, (key, places, ds) in enumerate(zip(keys, at, d2)):
        ok = places >= 0
        if ok.any() or (i == 0 and compared):
            yield key, [names[p] for p in places[ok]], ds[ok].tolist(), compared if i == 0 else 0


def nearest_neighbours(x: DataFrame, label: str, key: str, k: int, seed: int = 2, weight: float = 0.0,
                       pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The exact k nearest neighbours of every row in its class.

    ``x`` has unique ``key``, ``label``, ``_v`` (array<double>) and, with ``weight``, ``_cat``
    (array<string>): each that differs adds ``weight`` to the squared distance.  Returns
    ``key, label, nb_rank`` (1 to k, ties by key), ``nb_key, nb_v`` and ``nb_cat``."""
    found, _ = _neighbour_lists(x, label, key, k, seed, weight, pivots, block_rows)
    other = x.select(F.col(key).alias("nb_key"), F.col("_v").alias("nb_v"), *([F.col("_cat").alias("nb_cat")] if "_cat" in x.columns else []))
    return found.join(x.select(key, label), key).join(other, "nb_key").select(key, label, "nb_rank", *other.columns)


def _neighbour_lists(x: DataFrame, label: str, key: str, k: int, seed: int, weight: float, pivots: int, block_rows: int):
    """``key, nb_rank, nb_key`` and the table of what every pair of blocks gave."""
    spark = x.sparkSession
    cats = bool(weight)
    kind = x.schema[key].dataType
    # a vector with a missing or infinite component lies at no distance from any other
    x = x.where(F.forall("_v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")))))
    drawn = x.select("_v", F.xxhash64(F.lit(seed), F.col(key)).alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()
    keys_type, far = T.ArrayType(kind), T.ArrayType(T.DoubleType())
    lists = T.StructType([T.StructField("k", kind), T.StructField("nb", keys_type), T.StructField("d", far), T.StructField("compared", T.LongType())])
    if not drawn:
        return spark.createDataFrame([], T.StructType([T.StructField(key, kind), T.StructField("nb_rank", T.IntegerType()), T.StructField("nb_key", kind)])), None
    sample = np.array([r["_v"] for r in drawn], dtype=np.float64)
    chosen, axes = choose_pivots(sample, pivots), leading_axes(sample)
    basis, axes = axes if sample.shape[1] > OWN_AXES else None, axes[:, :AXES]
    row_bytes, np_ = 8 * sample.shape[1], len(chosen)
    most = max(block_rows, min(CELL_ROWS, CELL_BYTES // row_bytes))

    rows = x.select(F.col(label).alias("l"), F.col(key).alias("k"), "_v", *(["_cat"] if cats else []))
    rows = rows.withColumn("cid", F.xxhash64("l"))
    n = F.count(F.lit(1))
    cells = F.ceil(n / F.greatest(F.lit(block_rows), F.least(F.lit(max(block_rows, most // 2)), F.ceil(n / CELLS)))).cast("int")
    large = rows.groupBy(F.col("l").alias("l0")).agg(n.alias("n"), cells.alias("cells")).where("cells > 1")
    wanted = (large.agg(F.sum("cells")).first()[0] or 0) * ROWS_PER_CELL
    rate = F.lit(min(1.0, SAMPLE_BYTES / row_bytes / max(1, wanted))) * F.lit(float(ROWS_PER_CELL)) * F.col("cells") / F.col("n")
    hashed = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("k")), F.lit(1 << 30)) / float(1 << 30)
    of_class: dict = {}
    for r in rows.join(bounded_broadcast(large), F.col("l").eqNullSafe(F.col("l0"))).where(hashed < rate).select("cid", "cells", "_v").collect() if wanted else []:
        of_class.setdefault((r["cid"], r["cells"]), []).append(r["_v"])  # at most SAMPLE_BYTES of vectors
    trees = {cid: grow(np.array(v, dtype=np.float64) @ axes, cells) for (cid, cells), v in of_class.items()}
    shared = spark.sparkContext.broadcast((chosen, axes, basis, trees))

    @F.pandas_udf("int")
    def to_cell(cid: pd.Series, v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), dtype=np.int32)
        for c, at in cid.groupby(cid).indices.items():
            tree = shared.value[3].get(c, 0)
            if isinstance(tree, tuple):
                out[at] = route(tree, np.array(v.iloc[at].tolist(), dtype=np.float64) @ shared.value[1])
        return pd.Series(out)

    rows = materialize(rows.withColumn("cell", to_cell("cid", "_v")).drop("cid"), "neighbour-cells")
    parts = rows.groupBy(F.col("l").alias("l0"), F.col("cell").alias("cell0")).agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    rows = rows.join(bounded_broadcast(parts), F.col("l").eqNullSafe(F.col("l0")) & (F.col("cell") == F.col("cell0"))).drop("l0", "cell0")
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("k")), F.col("parts"))).drop("parts")

    kinds = {"keys": keys_type, "v": T.BinaryType(), "r2": T.BinaryType(), "cat": T.ArrayType(T.ArrayType(T.StringType()))}
    l_type = x.schema[label].dataType
    packed = T.StructType([T.StructField("l", l_type), T.StructField("block", T.StringType()), *[T.StructField(c, t) for c, t in kinds.items()],
                           T.StructField("starts", T.BinaryType()), T.StructField("rank", T.BinaryType()), T.StructField("lo", far), T.StructField("hi", far),
                           T.StructField("reach", T.DoubleType()), T.StructField("size", T.DoubleType()), T.StructField("own", T.ArrayType(lists))])

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("k", kind="stable")
        v = np.array(block["_v"].tolist(), dtype=np.float64)
        xs = coordinates(v, *shared.value[:2])
        groups = leaves(xs[:, np_:], block_rows)
        order = np.concatenate(groups)
        starts = np.cumsum([0, *map(len, groups)])
        keys = block["k"].tolist()
        keys = [keys[i] for i in order]
        cell = {"v": v[order], "x": xs[order], "rank": order, "starts": starts, "r2": np.full(len(v), np.inf)}
        cat = [list(c) for c in block["_cat"].iloc[order]] if cats else None
        if cats:
            [cell["cat"]] = _codes(cat)
        cell, own = _boxes(cell), []
        for j, (s, e) in enumerate(zip(starts, starts[1:])):
            at, d2, cell["r2"][s:e], compared = look(_rows(cell, slice(s, e)), cell, k, shared.value[2], weight, np_, j)
            own += _found(keys[s:e], keys, at, d2, compared)
        one = block.iloc[0]
        return pd.DataFrame([{"l": one["l"], "block": f"{one['cell']}.{one['part']}", "keys": keys, "v": cell["v"].tobytes(), "r2": cell["r2"].tobytes(), "cat": cat,
                              "starts": starts.astype(np.int64).tobytes(), "rank": order.astype(np.int64).tobytes(),
                              "lo": cell["x"].min(axis=0).tolist(), "hi": cell["x"].max(axis=0).tolist(), "reach": float(cell["r2"].max()),
                              "size": float(cell["size"].max()), "own": own}])

    blocks = materialize(rows.groupBy("l", "cell", "part").applyInPandas(pack, packed), "neighbour-blocks")
    meta = blocks.select("l", "block", "lo", "hi", "reach", "size")
    a, b = meta.alias("a"), bounded_broadcast(meta).alias("b")
    gap = F.zip_with(F.zip_with(F.col("b.lo"), F.col("a.hi"), lambda s, t: s - t), F.zip_with(F.col("a.lo"), F.col("b.hi"), lambda s, t: s - t), lambda s, t: F.greatest(s, t, F.lit(0.0)))
    apart = F.greatest(F.array_max(F.slice(gap, 1, np_)) * F.array_max(F.slice(gap, 1, np_)),
                       F.aggregate(F.slice(gap, np_ + 1, axes.shape[1]), F.lit(0.0), lambda s, t: s + t * t))
    goals = (a.join(b, F.col("a.l").eqNullSafe(F.col("b.l")) & (F.col("a.block") != F.col("b.block")))
             .where(apart - _SLACK * (F.col("a.size") + F.col("b.size")) <= F.col("a.reach"))
             .groupBy(F.col("a.l").alias("ql"), F.col("a.block").alias("qb")).agg(F.collect_list(F.struct("b.block", "b.lo", "b.hi", "b.size")).alias("goals")))
    content = ["keys", "v", "r2", *(["cat"] if cats else [])]
    queries = (blocks.select("l", "block", *content).join(goals, F.col("l").eqNullSafe(F.col("ql")) & (F.col("block") == F.col("qb")))
               .select("l", "goals", *content))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                v, r2 = np.frombuffer(row.v).reshape(len(row.keys), -1), np.frombuffer(row.r2)
                xs, size = coordinates(v, *shared.value[:2]), np.square(v).sum(axis=1)
                for goal in row.goals:
                    near = gaps(xs, np.array([goal["lo"]]), np.array([goal["hi"]]), np_)[:, 0] - _SLACK * (size + goal["size"])
                    some = np.flatnonzero(near <= r2)
                    if len(some):
                        out = {"l": row.l, "goal": goal["block"], "qkeys": [row.keys[i] for i in some], "qv": v[some].tobytes(), "qr2": r2[some].tobytes()}
                        yield pd.DataFrame([out | ({"qcat": [list(row.cat[i]) for i in some]} if cats else {})])

    visits = queries.mapInPandas(visit, T.StructType([T.StructField("l", l_type), T.StructField("goal", T.StringType()), *[T.StructField(f"q{c}", kinds[c]) for c in content]]))
    there = blocks.select(F.col("l").alias("cl"), "block", "keys", "v", "starts", "rank", *(["cat"] if cats else []))
    both = visits.join(there, F.col("l").eqNullSafe(F.col("cl")) & (F.col("goal") == F.col("block"))).drop("l", "goal", "cl", "block")

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                read = lambda name, n, kind=np.float64: np.frombuffer(getattr(row, name), dtype=kind).reshape(n)
                v = read("qv", (len(row.qkeys), -1))
                q = {"v": v, "x": coordinates(v, *shared.value[:2]), "r2": read("qr2", -1)}
                w = read("v", (len(row.keys), -1))
                cell = {"v": w, "x": coordinates(w, *shared.value[:2]), "starts": read("starts", -1, np.int64), "rank": read("rank", -1, np.int64)}
                if cats:
                    q["cat"], cell["cat"] = _codes(row.qcat, row.cat)
                cell = _boxes(cell)
                for s in range(0, len(v), block_rows):  # the rows of a cell are leaf by leaf
                    at, d2, _, compared = look(_rows(q, slice(s, s + block_rows)), cell, k, shared.value[2], weight, np_)
                    out = list(_found(row.qkeys[s:s + block_rows], row.keys, at, d2, compared))
                    if out:
                        yield pd.DataFrame(out, columns=["k", "nb", "d", "compared"])

    lists_of = materialize(blocks.select(F.inline("own")).unionByName(both.mapInPandas(pair, lists)), "neighbour-lists")
    each = lists_of.select("k", F.inline(F.arrays_zip("d", "nb")))
    rank = F.row_number().over(Window.partitionBy("k").orderBy("d", "nb"))
    ranked = each.withColumn("nb_rank", rank).where(F.col("nb_rank") <= k).select(F.col("k").alias(key), "nb_rank", F.col("nb").alias("nb_key"))
    return materialize(ranked, "neighbours"), lists_of
