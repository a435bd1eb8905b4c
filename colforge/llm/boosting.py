"""Text quality by histogram gradient-boosted trees over document statistics.

Statistics of a text (shares of letters, capitals, digits, symbols, repeated words and
lines, lengths of words, lines and sentences) are cut into at most 64 bins each by the
quantiles of the training rows.  Trees for the logistic loss are grown level by level:
one histogram of gradients and hessians per node and statistic, the best cut by gain.  A
fitted model is a few arrays, one row per tree: to score, all texts of a batch go down all
trees together, one gather a level.

The model is fitted on the driver on a bounded sample of labelled rows (``sample_rows``);
statistics are computed in the tasks, for the sample and for all texts to be scored.

Defined results: a null text counts as empty and gets the score of an empty text.  A
document's label is the mean of its labels, 1 from one half on; null labels and ids don't
count.  Of rows with one id, each is scored by itself, and learning takes them as separate
rows within the bound.  Without labels of both classes every score is the share of label 1
(Laplace's estimate).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

_SPACE = b" \t\n\x0b\x0c\r"
_CLASSES = {
    "capitals": bytes(range(0x41, 0x5B)), "smalls": bytes(range(0x61, 0x7B)), "digits": bytes(range(0x30, 0x3A)),
    "above_ascii": bytes(range(0x80, 0x100)), "spaces": _SPACE, "stops": b".,;:!?", "shouts": b"!?", "bars": b"|",
    "symbols": b"#*$%&<>=+~^\\_{}[]/@", "quotes": b"\"'()-",
}
FEATURES = (*(f"share_{k}" for k in _CLASSES), "word_length", "word_length_sd", "long_words", "short_words", "distinct_words",
            "top_word", "repeat_next", "words_with_other", "capital_words", "all_capital_words", "line_words",
            "distinct_lines", "short_lines", "bullet_lines", "stopped_lines", "sentence_words", "kinds_of_bytes", "entropy")

_LETTERS = _CLASSES["capitals"] + _CLASSES["smalls"] + _CLASSES["above_ascii"]
_ENDS = b".,;:!?\"')("


def statistics(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for one whole text, all finite."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    kinds = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = raw.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    rows = max(len(lines), 1)
    other = sum(k for w, k in seen.items() if w.rstrip(_ENDS).lstrip(_ENDS).translate(None, _LETTERS))
    share = kinds[kinds > 0] / size
    return [
        *(float(kinds[list(c)].sum()) / size for c in _CLASSES.values()),
        float(lengths.mean()), float(lengths.std()), float((lengths > 15).mean()), float((lengths <= 2).mean()), len(seen) / n,
        max(seen.values(), default=0) / n, sum(map(bytes.__eq__, words, words[1:])) / max(len(words) - 1, 1), other / n,
        sum(k for w, k in seen.items() if w[:1].isupper()) / n, sum(k for w, k in seen.items() if len(w) > 1 and w.isupper()) / n, len(words) / rows,
        len(set(lines)) / rows, sum(len(x) < 30 for x in lines) / rows, sum(x.lstrip()[:1] in (b"-", b"*", b"#") for x in lines) / rows,
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / rows, len(words) / (1 + int(kinds[[0x21, 0x2E, 0x3F]].sum())),
        float((kinds > 0).sum()), float(-(share * np.log2(share)).sum()) if len(share) else 0.0,
    ]


def feature_rows(texts) -> np.ndarray:
    out = np.array([statistics(t) for t in texts], dtype=np.float64)
    return out.reshape(len(texts), len(FEATURES))


@dataclass
class Trees:
    """Complete trees of one depth: node k has the children 2k+1 and 2k+2.  A row goes right
    if its statistic ``feature`` is above ``limit``; a node without a cut sends all left."""

    depth: int
    base: float  # the score before any tree, in log odds
    feature: np.ndarray = field(default_factory=lambda: np.empty((0, 0), dtype=np.int64))
    limit: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    value: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))  # of the leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of all rows of ``x``: all trees level by level, at once."""
        n_trees, inner = self.feature.shape
        if not n_trees or not len(x):
            return np.full(len(x), self.base)
        tree, row = np.arange(n_trees)[None, :], np.arange(len(x))[:, None]
        at = np.zeros((len(x), n_trees), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.limit[tree, at])
        return self.base + self.value[tree, at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def bin_limits(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cut values of each statistic: midpoints between neighbouring values at most, at the
    quantiles of the rows."""
    out = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) >= bins:
            cuts = np.unique(np.quantile(column, np.arange(1, bins) / bins))
            middle = np.unique(middle[np.minimum(np.searchsorted(middle, cuts), len(middle) - 1)])
        out.append(middle)
    return out


def best_cuts(binned: np.ndarray, node: np.ndarray, nodes: int, grad: np.ndarray, hess: np.ndarray, n_bins: int,
              l2: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node the statistic and bin with the largest gain (the first among equals) and
    that gain; rows of a bin up to it go left.  ``least`` hessian is needed on both sides."""
    gain, where = np.full(nodes, -np.inf), np.zeros((2, nodes), dtype=np.int64)
    for j in range(binned.shape[1]):
        cell = node * n_bins + binned[:, j]
        g = np.bincount(cell, weights=grad, minlength=nodes * n_bins).reshape(nodes, n_bins).cumsum(axis=1)
        h = np.bincount(cell, weights=hess, minlength=nodes * n_bins).reshape(nodes, n_bins).cumsum(axis=1)
        G, H = g[:, -1:], h[:, -1:]
        better = g**2 / (h + l2) + (G - g)**2 / (H - h + l2) - G**2 / (H + l2)
        better[(h < least) | (H - h < least)] = -np.inf
        at = better.argmax(axis=1)
        new = better[np.arange(nodes), at] > gain
        gain[new] = better[new, at[new]]
        where[0, new], where[1, new] = j, at[new]
    return where[0], where[1], gain


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.15, bins: int = 64,
              l2: float = 1.0, least: float = 1.0, min_gain: float = 1e-6) -> Trees:
    """Boosted trees for labels 0 and 1 with the logistic loss."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Trees(depth, float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    cuts = bin_limits(x, bins)
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
    n_bins = max(len(c) for c in cuts) + 1
    inner = 2**depth - 1
    margin = np.full(len(y), model.base)
    grown = []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, limit, at = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            j, b, gain = best_cuts(binned, at - first, nodes, grad, hess, n_bins, l2, least)
            for k in np.flatnonzero(gain > min_gain):
                feature[first + k], limit[first + k] = j[k], cuts[j[k]][b[k]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        g = np.bincount(at - inner, weights=grad, minlength=inner + 1)
        h = np.bincount(at - inner, weights=hess, minlength=inner + 1)
        value = -rate * g / (h + l2)
        margin += value[at - inner]
        grown.append((feature, limit, value))
    model.feature, model.limit, model.value = (np.stack([t[i] for t in grown]) for i in range(3))
    return model


def learnable(labels: DataFrame, held_out: Callable[[str], Column], id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row ``i, y`` for each id with a label that is not held out."""
    rows = labels.select(F.col(id_col).alias("i"), F.col(label).cast("double").alias("y")).where("i is not null and y is not null")
    return rows.where(~held_out("i")).groupBy("i").agg((F.avg("y") >= 0.5).cast("int").alias("y"))


def learn(docs: DataFrame, labels: DataFrame, held_out: Callable[[str], Column], id_col: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = 20_000, **kw) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents, those with the smallest hash of the
    id.  Only their statistics and labels reach the driver."""
    prepare(docs.sparkSession)
    ids = learnable(labels, held_out, id_col, label)
    drawn = F.broadcast(ids.orderBy(F.xxhash64("i"), "i").limit(sample_rows))  # at most sample_rows rows

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    rows = docs.select(F.col(id_col).alias("i"), F.col(text).cast("string").alias("t")).join(drawn, "i")
    rows = rows.select("i", "y", measure("t").alias("x")).orderBy(F.xxhash64("i"), "i", "x").limit(sample_rows).collect()
    if not rows:
        return fit_trees(np.empty((0, len(FEATURES))), np.empty(0), **kw)
    return fit_trees(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], dtype=np.float64), **kw)


def score_texts(df: DataFrame, model: Trees, text: str = "text", out: str = "quality_score") -> DataFrame:
    """Add ``out``, the chance of label 1."""
    shared = prepare(df.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(feature_rows(texts)))

    return df.withColumn(out, score(F.col(text).cast("string")))
