"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of labelled text knows every string that occurs in
it.  A document is parsed greedily into the longest strings that the automaton knows; the
fewer phrases it takes, the closer the text is to the language.  The language with the
fewest phrases, normalised by the information a phrase carries (the logarithm of the
training length), wins.  Every letter and mark of the samples has a code of its own, whatever
the script; upper and lower case share one.

Learning uses a bounded sample: about ``rows_per_language`` labelled documents for each
language, at most ``longest`` characters of each, cut off at ``chars_per_language``.  The automata
are broadcast to the tasks, each with the columns of its own letters: dense tables, or hash
tables where these are more than ``DENSE``.  Prediction reads whole texts: they are cut into
segments of ``SEGMENT`` characters, parsed from the root each, so that all segments of a
batch walk their automata together in numpy.

Defined results: a null text, or one without letters, is ``und`` with score 0, as is every
text if nothing could be learned; marks alone are no letters.  Ties go to the first language by name.  A document with
a null id is neither held out nor learned from.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

SEGMENT = 256
#: Codes: nothing, a gap, letters and marks in no sample, and from FIRST on those in one.
PAD, GAP, OTHER, FIRST = 0, 1, 2, 3
#: Columns (unknown, and one for each code) up to which an automaton is a dense table.
DENSE = 64

#: Characters that Java does not know yet may be letters to Python.
LETTER, NO_LETTERS = r"[\p{L}\p{Cn}]", r"^[\P{L}&&\P{Cn}]+"


class Automaton:
    """A language's suffix automaton.  States are numbered from 1 (the root) and multiplied
    by the number of columns; 0 is unknown.  Column 0 is every code that it never has."""

    def __init__(self, step: list[dict[int, int]], wide: bool):
        codes = np.unique([c for row in step for c in row]).astype(np.int64)
        self.columns = np.zeros(codes[-1] + 2 if len(codes) else 1, dtype=np.int32)
        self.columns[codes] = np.arange(1, len(codes) + 1)
        self.start = width = len(codes) + 1
        keys = np.array([(i + 1) * width + self.columns[c] for i, row in enumerate(step) for c in row], dtype=np.int64)
        values = np.array([(j + 1) * width for row in step for j in row.values()], dtype=np.int64)
        self.root = np.full(width, width, dtype=np.int64 if wide else np.int32)  # a letter the language never has is a phrase of its own
        self.root[keys[:len(step[0])] - width] = values[:len(step[0])]
        self.keys = None
        if wide:
            self._hash(keys, values)
        else:
            self.values = np.zeros((len(step) + 1) * width, dtype=np.int32)
            self.values[keys] = values

    def column(self, codes: np.ndarray) -> np.ndarray:
        """The columns of codes; what lies beyond the language's last code is unknown."""
        return self.columns.take(codes, mode="clip")

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing, at most a quarter full; key 0 is a free place."""
        self.bits = max(2, (4 * len(keys)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.int64)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            spots, first = np.unique(at[left], return_index=True)
            free = self.keys[spots] == 0
            self.keys[spots[free]], self.values[spots[free]] = keys[left[first[free]]], values[left[first[free]]]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def follow(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The next states; 0 where there is none."""
        key = state + column
        if self.keys is None:
            return self.values[key]
        at = self._place(key)
        found = self.keys[at]
        out = np.where(found == key, self.values[at], 0)
        left = np.flatnonzero((found != key) & (found != 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            found = self.keys[at[left]]
            hit = found == key[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found != 0)]
        return out


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray  # code of each code point
    tables: list[Automaton]
    bits: np.ndarray  # information of a phrase
    own: np.ndarray | None = None  # bits a character that one half of the sample takes for the other


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


def dense(step: list[dict[int, int]]) -> Automaton:
    """The automaton as one dense table, or as a hash table if it has many letters."""
    return Automaton(step, wide=len({c for row in step for c in row}) + 1 > DENSE)


def classes_of(text: str | None, classes: np.ndarray) -> np.ndarray:
    """The text's character classes, gaps run together and stripped from its ends."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = classes[points]
    c = c[np.append(True, (c[1:] != GAP) | (c[:-1] != GAP))] if len(c) else c
    return c[1 if len(c) and c[0] == GAP else 0:len(c) - (1 if len(c) > 1 and c[-1] == GAP else 0)]


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """The lower case of each letter and mark; 0 for other code points.  Marks spell vowels
    in many scripts; variation selectors and enclosing marks only change a symbol's look."""
    out = np.zeros(0x110000, dtype=np.int32)
    for i in range(0x110000):
        ch = chr(i)
        if ch.isalpha() or (unicodedata.category(ch) in ("Mn", "Mc") and not (0xFE00 <= i <= 0xFE0F or 0xE0100 <= i <= 0xE01EF)):
            out[i] = ord(ch.lower()) if len(ch.lower()) == 1 else i
    return out


def letter_classes(texts) -> np.ndarray:
    """A code for every letter and mark of the texts, and what else a code point is."""
    fold = folded()
    seen = np.zeros(0x110000, dtype=bool)
    for t in texts:
        seen[fold[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4")]] = True
    seen[0] = False
    code = np.full(0x110000, OTHER, dtype=np.int32)
    code[seen] = FIRST + np.arange(seen.sum())
    code[0] = GAP
    return code[fold].astype(np.min_scalar_type(int(code.max())))


def learnable(df: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    return df.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull())


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def equal_pieces(texts: list[str], size: int) -> list[str]:
    """The beginnings of all texts, as long as one another, ``size`` characters together;
    what shorter texts leave goes to the others."""
    left, share = size, 0
    for i, n in enumerate(sorted(map(len, texts))):
        share = max(1, left // (len(texts) - i))
        left -= min(n, share)
    return [t[:share] for t in texts]


def learn(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = 64,
          chars_per_language: int = 20_000, longest: int = 20_000, max_languages: int = 128) -> Model:
    """Fit on a sample of the rows that ``learnable`` gives, drawn by a hash of id and text;
    about ``rows_per_language`` texts of each language reach the driver, and at most four
    times as many in all.  Of a text of more than ``longest`` characters, so many from its
    first letter on are taken.  The texts of a language have equal shares of its
    ``chars_per_language``, so that no long one stands for all.  A language whose draw has no letter takes the text with
    letters of the smallest hash."""
    prepare(df.sparkSession)
    rows = learnable(df, id_col, text, lang)
    rows = rows.where(F.length(text) > 0)
    piece = F.when(F.length(text) <= longest, F.col(text)).otherwise(F.substring(F.regexp_replace(text, NO_LETTERS, ""), 1, longest))
    sizes = {r["l"]: r["n"] for r in rows.groupBy(F.col(lang).alias("l")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} labels; their automata would not fit")
    texts: dict[str, list] = {name: [] for name in sorted(sizes)}
    if sizes:
        h = F.pmod(F.xxhash64(id_col, text), F.lit(1 << 30))
        share = F.coalesce(*[F.when(F.col(lang) == k, F.lit(min(1.0, rows_per_language / n))) for k, n in sizes.items()])
        drawn = rows.select(F.col(lang).alias("l"), piece.alias("t"), h.alias("h"), share.alias("s")).where(F.col("h") < F.col("s") * (1 << 30))
        # Four times what is expected is never reached unless whole rows are repeated.
        drawn = drawn.drop("s").distinct().orderBy("h", "l").limit(4 * rows_per_language * len(sizes))
        for r in sorted(drawn.collect(), key=lambda r: (r["l"], r["h"], r["t"])):
            texts[r["l"]].append(r["t"])
        bare = [k for k, v in texts.items() if not any(ch.isalpha() for t in v for ch in t)]
        if bare:
            first = F.substring(F.regexp_replace(F.min_by(text, h), NO_LETTERS, ""), 1, longest)
            for r in rows.where(F.col(lang).isin(bare) & F.col(text).rlike(LETTER)).groupBy(F.col(lang).alias("l")).agg(first.alias("t")).collect():
                texts[r["l"]] = [r["t"]]
    texts = {k: v for k, v in texts.items() if any(ch.isalpha() for t in v for ch in t)}
    classes, tables, bits, own = letter_classes(t for v in texts.values() for t in v), [], [], []
    for name in texts:
        codes = classes_of("\n".join(equal_pieces(texts[name], chars_per_language)), classes)[:chars_per_language]
        tables.append(dense(suffix_automaton(codes.tolist())))
        bits.append(math.log2(len(codes) + 1))
        half = len(codes) // 2
        test = Model([name], classes, [dense(suffix_automaton(codes[:half].tolist()))], np.array([math.log2(half + 1)]))
        own.append(count_phrases([codes[half:]], test)[0, 0] * test.bits[0] / max(1, len(codes) - half))
    return Model(list(texts), classes, tables, np.array(bits), np.array(own))


def count_phrases(codes: list[np.ndarray], model: Model) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns)."""
    segments = [max(1, -(-len(c) // SEGMENT)) for c in codes]
    first = np.concatenate([[0], np.cumsum(segments)])
    lanes = np.zeros((first[-1], SEGMENT), dtype=np.result_type(np.uint8, *codes))
    for c, a in zip(codes, first):
        lanes.reshape(-1)[a * SEGMENT:a * SEGMENT + len(c)] = c
    used = (lanes != PAD).sum(axis=1)
    order = np.argsort(-used, kind="stable")
    steps = np.ascontiguousarray(lanes[order].T)  # step by step, the longest lanes first
    active = np.searchsorted(-used[order], -np.arange(SEGMENT), side="left")
    out = np.zeros((len(codes), len(model.tables)))
    for k, table in enumerate(model.tables):
        root = table.root
        state, fails = np.full(first[-1], table.start, dtype=root.dtype), np.zeros(first[-1], dtype=np.int32)
        for t in range(SEGMENT):
            n = active[t]
            if not n:
                break
            c = table.column(steps[t, :n])
            new = table.follow(state[:n], c)
            lost = np.flatnonzero(new == 0)
            fails[lost] += 1
            new[lost] = root[c[lost]]
            state[:n] = new
        by_lane = np.empty_like(fails)
        by_lane[order] = fails
        out[:, k] = np.add.reduceat(by_lane, first[:-1]) + np.array(segments)
    return out


def identify_languages(df: DataFrame, model: Model, text: str = "text", out: str = "language", max_rate: float = 8.0) -> DataFrame:
    """Add a struct ``out``: ``lang`` (``und`` if there is none), ``score`` (1 less the ratio
    of the best to the second entropy), ``rate`` (bits a character in the best language)
    and ``accepted`` (a language was found, and its phrases are not mere single letters:
    at most ``max_rate`` bits a character; texts of a learned language take 2 to 6).  In
    scripts of many letters texts take more: up to a quarter more than the language's sample
    takes itself is accepted, if that is less than 19 of 20 letters being phrases.  The first
    phrase, which every text needs, does not count for this, so that short texts stay; a text
    of which no learned language has a letter is not accepted."""
    shared = prepare(df.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rate double, accepted boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        codes = [classes_of(t, m.classes) for t in texts]
        rows = [("und", 0.0, None, False)] * len(codes)
        some = [i for i, t in enumerate(texts) if any(ch.isalpha() for ch in t or "")]
        if some and m.tables:
            limits = np.maximum(max_rate, np.minimum(0.95 * m.bits, 1.25 * m.own)) if m.own is not None else np.full(len(m.bits), max_rate)
            costs = count_phrases([codes[i] for i in some], m) * m.bits
            for i, cost in zip(some, costs):
                best, *rest = sorted((c, k) for k, c in enumerate(cost))
                rate = best[0] / len(codes[i])
                letters = codes[i][codes[i] >= FIRST]
                known = any(t.column(letters).any() for t in m.tables)
                accepted = known and rate - m.bits[best[1]] / len(codes[i]) <= limits[best[1]]
                rows[i] = (m.languages[best[1]], 1.0 - best[0] / rest[0][0] if rest else 1.0, rate, bool(accepted))
        return pd.DataFrame(rows, columns=["lang", "score", "rate", "accepted"])

    return df.withColumn(out, predict(F.col(text)))
