"""Rebalancing (RB1 undersampling; RB2/RB3 SMOTE oversampling lives in ``smote``).

Undersampling is exact and seeded: a class is cut to the target size by keeping its
rows with the smallest ``md5('<seed>:<key>')``; it never adds or duplicates a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .split import class_counts, first_by_hash


def undersample(df: DataFrame, label: str, key_cols, cut=None, target: int | None = None, seed=42) -> DataFrame:
    """RB1: cut the classes in ``cut`` (default: every class) to ``target`` rows
    (default: the smallest class count).  Rows without a label belong to no class: they
    are kept, and do not count towards the smallest.

    The reference's three-class form cuts label 1 to the least frequent count
    (``cut=[1]``); its two-class form cuts the larger class to the smaller one.
    """
    key_cols = list(key_cols)
    counts = class_counts(df, label)
    counts.pop(None, None)
    if not counts:
        return df
    target = min(counts.values()) if target is None else target
    cut = list(counts) if cut is None else list(cut)
    wanted = {c: min(target, counts[c]) for c in cut if c in counts}
    marked = first_by_hash(df, label, key_cols, seed, wanted, "_cf_first")
    return marked.where(F.col(label).isNull() | ~F.col(label).isin(*cut) | F.col("_cf_first")).drop("_cf_first")
