"""Quality rules as a short-circuit cascade.

Each rule looks at one document and says whether it fails.  Rules differ in what they
cost (a character count against a word histogram) and in how many documents they reject.
``plan_cascade`` measures both on a sample, for each rule as it meets documents after the
rules before it, and orders the rules by rejection per cost; ``apply_quality`` then stops at the first rule that fails.  The order
changes only the work: a document is kept if no rule fails, whichever comes first.

Defined results: a null or empty text has zero counts and fails the base rule.  Repeated
rows are judged one by one.  An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
#: ASCII characters that are neither white space, control characters nor letters.
_OTHER = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalpha())
_BULLETS = (b"-", b"*", "•".encode())


class Doc:
    """One text, with its features computed on first use and then kept."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.raw) - len(self.raw.translate(None, _SPACE)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _SYMBOLS))

    @cached_property
    def n_other(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _OTHER))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a 3-word window found at least twice."""
        windows = list(zip(self.words, self.words[1:], self.words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen, covered, end = Counter(windows), 0, 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered

    @cached_property
    def top_word(self) -> int:
        """How often the most frequent word occurs."""
        return max(Counter(self.words).values(), default=0)


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Doc], bool]


#: Ratios are compared as integers, so that every engine gives the same verdict.
DEFAULT_RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("mean_word", lambda d: d.word_chars < 3 * d.n_words or d.word_chars > 12 * d.n_words),
    Rule("letters", lambda d: 10 * d.n_other > 4 * d.word_chars),
    Rule("dup_lines", lambda d: 10 * d.n_dup_lines > 3 * len(d.lines)),
    Rule("bullets", lambda d: 10 * sum(x.lstrip().startswith(_BULLETS) for x in d.lines) > 9 * len(d.lines)),
    Rule("top_word", lambda d: 4 * d.top_word > d.n_words),
)


#: Features that the result and the base rule need of every document.
BASE_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_fails(d: Doc, min_words: int = 50, max_repeat_pct: int = 50) -> bool:
    return d.n_words < min_words or 100 * d.n_repeat_words > max_repeat_pct * d.n_words


def _base_done(text: str | None) -> Doc:
    """A document as the cascade meets it: with the features that the result needs anyway."""
    d = Doc(text)
    for name in BASE_FEATURES:
        getattr(d, name)
    return d


def plan_cascade(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = DEFAULT_RULES,
                 sample_rows: int = 2000, seed: int = 7) -> list[dict]:
    """The rules in the order in which to try them, from about ``sample_rows`` random documents.

    Only documents that pass the base rule count, as only they reach the cascade, and the
    features that it has computed are free.  Each rule is timed twice on every document: with
    the features that it adds, and when these are there.  The order is greedy: next comes the
    rule with the most rejections, among the documents that the rules before leave, per cost,
    where features of the rules before are free too.  A row per pattern of failed rules, rule
    and feature reaches the driver."""
    n = df.count()
    sample = df.select(F.col(text).alias("t"))
    if n > sample_rows:
        sample = sample.sample(False, sample_rows / n, seed)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clock = time.perf_counter_ns
        for b in batches:
            out = []
            for t in b["t"]:
                if base_fails(Doc(t)):
                    continue
                failed = []
                for i, r in enumerate(rules):
                    d = _base_done(t)
                    had = set(vars(d))
                    if r.fails(d):
                        failed.append(str(i))
                    added = sorted(set(vars(d)) - had)
                    began = clock()
                    r.fails(d)
                    out.append(("rule", str(i), clock() - began, 1))
                    d = _base_done(t)
                    for name in added:  # each with what it needs, if no other has computed that
                        began = clock()
                        getattr(d, name)
                        out.append(("feature", f"{i} {name}", clock() - began, 1))
                out.append(("pattern", " ".join(failed), 0, 1))
            yield pd.DataFrame(out, columns=["kind", "what", "ns", "n"])

    rows = (sample.mapInPandas(measure, "kind string, what string, ns long, n long")
            .groupBy("kind", "what").agg(F.sum("ns").alias("ns"), F.sum("n").alias("n")).collect())
    own = {int(r["what"]): r["ns"] / r["n"] for r in rows if r["kind"] == "rule"}
    needs: dict[int, dict[str, float]] = {}
    for r in rows:
        if r["kind"] == "feature":
            i, name = r["what"].split(" ")
            needs.setdefault(int(i), {})[name] = r["ns"] / r["n"]
    left = {frozenset(map(int, r["what"].split())): r["n"] for r in rows if r["kind"] == "pattern"}
    plan, cached, open_ = [], set(), list(range(len(rules)))
    while open_:
        seen = sum(left.values())

        def value(i: int) -> tuple[float, float]:
            # Laplace's estimate keeps a rule that rejected nothing in the sample comparable.
            reject = (sum(k for p, k in left.items() if i in p) + 1) / (seen + 2)
            return reject, max(own.get(i, 1.0) + sum(c for f, c in needs.get(i, {}).items() if f not in cached), 1.0)

        reject, cost, i = max(((*value(i), i) for i in open_), key=lambda v: (v[0] / v[1], -v[2]))
        plan.append({"rule": rules[i].name, "cost_ns": cost, "reject": reject})
        cached |= set(needs.get(i, {}))
        left = {p: k for p, k in left.items() if i not in p}
        open_.remove(i)
    return plan


def apply_quality(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = DEFAULT_RULES,
                  order: list[str] | None = None, out: str = "quality") -> DataFrame:
    """Add a struct column ``out``: the base counts, ``base_failed``, ``kept`` and
    ``rejected_by`` (the first failing rule in cascade order; ``base`` for the base rule).
    ``order`` names the rules in the order to try; by default ``plan_cascade`` finds it.
    An input column called ``out`` is replaced; all others stay."""
    if order is None:
        order = [p["rule"] for p in plan_cascade(df, text, rules)]
    by_name = {r.name: r for r in rules}
    cascade = [by_name[x] for x in order]

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                  "base_failed boolean, kept boolean, rejected_by string")
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            d = Doc(t)
            why = "base" if base_fails(d) else next((r.name for r in cascade if r.fails(d)), None)
            rows.append((d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words,
                         why == "base", why is None, why))
        return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                           "base_failed", "kept", "rejected_by"])

    return df.withColumn(out, judge(F.col(text)))
