"""Small tables with every awkward row, and brute-force versions of the operators."""

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or add; as extra columns they must do no harm.
CLASHES = ["mark", "_mark", "h", "size", "root", "fp", "id", "n", "r", "spans", "quality", "language", "copies", "_copy", "host", "value", "at"]

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly mix old potions near a frozen river bank and "
         "nobody in the village knows why the lanterns burn so late at night or who keeps the tall iron gate open ")


def edge_rows():
    long = " ".join(f"word{i} of{i % 97}" for i in range(30_000))
    return [
        (1, PROSE * 3, "en", "a", 10), (2, PROSE * 3, "en", "a", 10), (2, PROSE * 3, "en", "a", 10),
        (3, None, "en", "a", 0), (4, "", None, None, None), (None, PROSE + "x", "en", "b", 3), (None, PROSE + "x", "en", "b", 3),
        (5, " \t\n\x0b ", "en", "b", 5), (6, "ünï 日本 🙂 " * 40, None, "b", 9), (7, long, "en", "c", len(long)),
        (8, "##$$ &&& || " * 30, "en", None, 1), (9, "line one\nline one\n\nline two\n" * 30, "en", "c", 1),
        (10, 'password = "hunter22" and api_key: ABCdef123456 or token=abc', "en", "c", 1), (11, "a\u00a0b\u2003c\x1cd", "fr", "c", 7),
    ]


def edge_docs(spark, clashes=True, rows=None):
    df = spark.createDataFrame(edge_rows() if rows is None else rows, DOCS)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    return df


def components(items, linked):
    """Brute force: the smallest reachable index of each item."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]
