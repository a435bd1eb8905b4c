"""Exact splitting (SP1–SP5, SR3).

Sizes are exact (``sampleBy`` is only approximate): per class, the rows with the
smallest ``md5('<seed>:<key>')`` are taken up to an allocation computed from the class
counts.  A split does not sort the rows: counts by hash prefix give the hash up to which
each class is taken, and the rows are marked by comparing with it.  Folds and positions
need every row's number; ``hash_row_number`` deals the rows out by hash prefix and numbers
them there, after counting.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import row_count_at_most
from .ranking import exact_row_number, hash_row_number, md5_order
from .selection import Target, literal, order_key, rows_at_ranks


def class_counts(df: DataFrame, label: str, max_classes: int = 10_000) -> dict:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    if not row_count_at_most(counts, max_classes):
        raise ValueError(f"{label} has more than {max_classes} classes")
    return {r[label]: r["n"] for r in counts.collect()}


def allocate(counts: dict, total: int) -> dict:
    """Split ``total`` over classes proportionally: floors first, then the remainder
    to the largest fractional parts (ties by class order)."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    keys = sorted(counts, key=lambda k: (k is None, str(k) if not isinstance(k, (int, float)) else k))
    exact = {k: total * counts[k] / n for k in keys}
    base = {k: math.floor(exact[k]) for k in keys}
    rest = total - sum(base.values())
    order = sorted(keys, key=lambda k: (-(exact[k] - base[k]), keys.index(k)))
    for k in order[:rest]:
        base[k] += 1
    return base


def _ranked(df: DataFrame, label: str | None, key_cols, seed, name="_cf_rn") -> DataFrame:
    """Exact row numbers in the seeded order of each class."""
    return hash_row_number(df, [label] if label else [], _seeded_hash(key_cols, seed), list(key_cols), name)


#: Hex digits by which a cut is refined at a time: at most 4096 buckets per class.
_DIGITS = 3

#: Classes up to which the rows are marked by a CASE; more are marked by a join.
_CASE_CLASSES = 32


def _seeded_hash(key_cols, seed) -> Column:
    return F.coalesce(md5_order(list(key_cols), seed), F.lit(""))


def _class_table(df: DataFrame, label: str | None, rows: list[tuple], fields: str) -> DataFrame:
    """A small table with a row for each class: its label ``c`` and further values."""
    kind = df.schema[label].dataType if label else T.IntegerType()
    schema = T.StructType([T.StructField("c", kind), *T.StructType.fromDDL(fields).fields])
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # class_counts bounds the classes


def hash_cuts(df: DataFrame, label: str | None, h: Column, wanted: dict) -> dict | None:
    """For each class c of ``wanted``, a hash prefix: the ``wanted[c]`` rows with the
    smallest hashes are those whose hash starts with it or with a smaller one.

    Rows are counted by class and prefix.  The running sum over a class's prefixes (at most
    4096) finds the bucket that the wanted number cuts through, and only that is looked into
    further; it is the one row of a class that reaches the driver in a pass.  None if a
    number cuts through rows of one hash (repeated keys)."""
    rows = df.select((F.col(label) if label else F.lit(None).cast("int")).alias("l"), h.alias("h"))
    cuts, open_ = {}, {c: ("", n) for c, n in wanted.items() if n > 0}
    length = 0
    run = Window.partitionBy("c").orderBy("p")
    while open_:
        if length >= 32:
            return None
        length += _DIGITS
        state = _class_table(df, label, [(c, p, n) for c, (p, n) in open_.items()], "q string, wanted bigint")
        inside = rows.join(state, F.col("l").eqNullSafe(F.col("c")) & F.col("h").startswith(F.col("q")))
        counts = inside.groupBy("c", "wanted", F.substring("h", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.withColumn("upto", F.sum("n").over(run))
        for r in counts.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))).collect():
            if r["upto"] == r["wanted"]:
                cuts[r["c"]] = r["p"]
                del open_[r["c"]]
            else:
                open_[r["c"]] = (r["p"], r["wanted"] - r["upto"] + r["n"])
    return cuts


def _by_class(label: str | None, values: dict, otherwise: Column) -> Column:
    """A CASE over the classes; the class None is that of the rows without a label."""
    out = None
    for c, v in values.items():
        cond = F.lit(True) if label is None else (F.col(label).isNull() if c is None else F.col(label) == F.lit(c))
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(otherwise) if out is not None else otherwise


def mark_by_class(df: DataFrame, label: str | None, values: dict, kind: str, mark, out: str) -> DataFrame:
    """Add the boolean ``out``: ``mark`` of the value (of type ``kind``) of each row's class,
    false for a class without one."""
    if len(values) <= _CASE_CLASSES:
        of_class = _by_class(label, {c: F.lit(v).cast(kind) for c, v in values.items()}, F.lit(None).cast(kind))
        return df.withColumn(out, F.coalesce(mark(of_class), F.lit(False)))
    side = _class_table(df, label, list(values.items()), f"v {kind}").select(F.col("c").alias("_cf_c"), F.col("v").alias("_cf_v"))
    joined = df.join(F.broadcast(side), F.col(label).eqNullSafe(F.col("_cf_c")), "left")
    return joined.withColumn(out, F.coalesce(mark(F.col("_cf_v")), F.lit(False))).drop("_cf_c", "_cf_v")


def first_by_hash(df: DataFrame, label: str | None, key_cols, seed, wanted: dict, out: str) -> DataFrame:
    """Add the boolean ``out``: true for the ``wanted[c]`` rows of each class with the
    smallest seeded hash.  Repeated keys that the number cuts through are numbered."""
    h = _seeded_hash(key_cols, seed)
    cuts = hash_cuts(df, label, h, wanted)
    if cuts is not None:
        return mark_by_class(df, label, cuts, "string", lambda p: F.substring(h, F.lit(1), F.length(p)) <= p, out)
    ranked = _ranked(df, label, key_cols, seed, name="_cf_rn")
    return mark_by_class(ranked, label, wanted, "bigint", lambda n: F.col("_cf_rn") <= n, out).drop("_cf_rn")


def stratified_split(df: DataFrame, label: str, key_cols, test_ratio: float = 0.15, seed=42,
                     split_col: str = "split", stratify: bool = True) -> DataFrame:
    """SP1 / SP2: mark every row ``train`` or ``test``; test size = int(n · ratio),
    spread over classes proportionally.  Falls back to an unstratified split when a
    class has fewer than two rows (the reference's ``except`` path)."""
    key_cols = list(key_cols)
    counts = class_counts(df, label)
    n_test = int(sum(counts.values()) * test_ratio)
    by = label if stratify and min(counts.values(), default=0) >= 2 else None
    wanted = allocate(counts, n_test) if by else {None: n_test}
    marked = first_by_hash(df, by, key_cols, seed, wanted, "_cf_test")
    return marked.withColumn(split_col, F.when(F.col("_cf_test"), "test").otherwise("train")).drop("_cf_test")


def stacking_split(df: DataFrame, label: str, key_cols, level0_ratio: float = 0.33,
                   level0_test_ratio: float = 0.15, seed=42, fold_col: str = "fold") -> DataFrame:
    """SP3: ``level0_train`` / ``level0_test`` / ``level1`` from one seeded order.

    Level 0 is the first int(n · 0.33) rows of the per-class permutation (stratified);
    its test part is the first int(n0 · 0.15) of those, again stratified.  Level-1 rows
    are never seen by level-0 models (no stacking leakage)."""
    key_cols = list(key_cols)
    counts = class_counts(df, label)
    alloc0 = allocate(counts, int(sum(counts.values()) * level0_ratio))
    alloc0t = allocate(alloc0, int(sum(alloc0.values()) * level0_test_ratio))
    marked = first_by_hash(df, label, key_cols, seed, alloc0t, "_cf_test0")
    marked = first_by_hash(marked, label, key_cols, seed, alloc0, "_cf_all0")
    fold = F.when(F.col("_cf_test0"), "level0_test").when(F.col("_cf_all0"), "level0_train").otherwise("level1")
    return marked.withColumn(fold_col, fold).drop("_cf_test0", "_cf_all0")


def head_tail_split(df: DataFrame, order_cols, ratio: float, split_col: str = "split") -> DataFrame:
    """SP4: the first int(n · ratio) rows in the given order are ``head``.

    The key of the last head row is found by counting and the rows are marked by comparing
    with it: nothing is sorted, dealt out or written.  Rows of one key that the number cuts
    through are told apart by a hash of the whole row; only repeated rows that still tie
    are numbered."""
    key = order_key(df, order_cols)
    n = df.count()
    cut = int(n * ratio)
    if cut <= 0:
        return df.withColumn(split_col, F.lit("tail"))
    kind = df.select(key.alias("k")).schema["k"].dataType
    [t] = rows_at_ranks(df, [Target(key, cut, n)])
    last = literal(t.value, kind)
    below, tied, left = key < last, key.eqNullSafe(last), cut - t.below
    if left == t.equal:
        return df.withColumn(split_col, F.when(below | tied, "head").otherwise("tail"))
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    [u] = rows_at_ranks(df.where(tied), [Target(h, left, t.equal)])
    first = below | (tied & (h < u.value))
    if left - u.below == u.equal:
        return df.withColumn(split_col, F.when(first | (tied & (h == u.value)), "head").otherwise("tail"))
    same = exact_row_number(df.where(tied & (h == u.value)), [], list(order_cols), name="_cf_rn")
    same = same.withColumn(split_col, F.when(F.col("_cf_rn") <= left - u.below, "head").otherwise("tail")).drop("_cf_rn")
    return df.where(~(tied & (h == u.value))).withColumn(split_col, F.when(first, "head").otherwise("tail")).unionByName(same)


def stratified_folds(df: DataFrame, label: str, key_cols, k: int = 5, seed=42, fold_col: str = "fold") -> DataFrame:
    """SP5: fold id 0..k−1, dealt round-robin along each class's permutation, so every
    fold holds each class's share to within one row.  Feeds ``CrossValidator(foldCol)``."""
    ranked = _ranked(df, label, list(key_cols), seed)
    return ranked.withColumn(fold_col, F.pmod(F.col("_cf_rn") - 1, F.lit(k)).cast("int")).drop("_cf_rn")


def permutation_rank(df: DataFrame, key_cols, seed=42, name: str = "position") -> DataFrame:
    """SR3: position of each row in a seeded pseudo-random permutation."""
    return _ranked(df, None, list(key_cols), seed, name=name)
