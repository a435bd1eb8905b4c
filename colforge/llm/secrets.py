"""Secret scans with corpus-wide ownership frequency.

Each text is searched for assignments of passwords and keys, access keys and long hex
strings (the base kinds), and for other long strings of letters and digits (candidates).
All found values are hashed and counted over the corpus by distinct repositories and
distinct owners.  A value that many owners share is a widely copied example; one that only
few have looks live, in however many repositories.  Equal texts count once, for the smallest
of their owners and repositories, so that cross-posted copies are no spread.  Candidates that
look live become spans of kind ``owned``; base spans stay and are marked ``live`` or not.

Only DataFrame functions are used.  Positions are code points, found by splitting a text
at the matches and adding up the lengths.  Most texts have nothing to find and are passed
by after one regular expression; only values' hashes are shuffled for the counts.

Defined results: a null text has no spans.  A null owner or repository counts as one.
Repeated rows have the same spans and, sharing their text, count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colforge.session import materialize

from .common import free_name, prepare

_KEYWORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX, CANDIDATE = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9+/_-]{20,}"
#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "owned")
#: Every match of a kind lies in a text that this finds something in.
ANY = f"{_KEYWORD}|[A-Za-z0-9+/_-]{{20}}"
_SPANS = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string>>"


def _found(text: Column, pattern: str, kind: str, value) -> Column:
    """The matches of ``pattern``, left to right, with their places."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    empty = F.struct(F.lit(0).alias("at"), F.lit(None).cast(_SPANS).alias("all"))
    empty = empty.withField("all", F.array().cast(_SPANS))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.alias("end"), F.lit(kind).alias("kind"), value(part["hit"]).alias("value"))
        return F.when(part["hit"].isNull(), state).otherwise(F.struct(end.alias("at"), F.concat(state["all"], F.array(span)).alias("all")))

    return F.aggregate(parts, empty, step, lambda s: s["all"])


def base_spans(text: Column) -> Column:
    assign = F.filter(_found(text, ASSIGN, "assign", lambda m: F.regexp_extract(m, ASSIGN, 1)), lambda s: F.length(s["value"]) >= 6)
    whole = lambda m: m
    return F.concat(assign, _found(text, ACCESS, "access", whole), _found(text, HEX, "hex", whole))


def candidate_spans(text: Column, base: Column) -> Column:
    """Long strings with a letter and a digit that no base span overlaps."""
    mixed = F.filter(_found(text, CANDIDATE, "owned", lambda m: m), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return F.filter(mixed, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def scan_secrets(df: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", max_owners: int = 5,
                 max_repositories: int = 5, max_owner_share: float = 0.01, out: str = "spans") -> DataFrame:
    """Add ``out``, an array of (``start``, ``end``, ``kind``, ``live``) by start and kind;
    ends are exclusive.  A value is an example if more than ``max_owners`` owners, more than
    ``max_owner_share`` of all owners and more than ``max_repositories`` repositories have
    it, equal texts counted once; any other is live.  An input column called ``out`` is
    replaced."""
    prepare(df.sparkSession)
    limit = F.greatest(F.lit(float(max_owners)), F.lit(max_owner_share) * df.select(owner).distinct().count())
    df = df.drop(*[c for c in [out] if c not in (text, owner, repository)])
    own = {c: free_name(df, f"_{c}") for c in ("row", "base", "found", "same")}
    any_ = F.coalesce(F.col(text).rlike(ANY), F.lit(False))
    none = F.array().cast("array<struct<start:int,end:int,kind:string,live:boolean>>")
    hits = df.where(any_).withColumn(own["base"], base_spans(F.col(text)))
    hits = (hits.withColumn(own["found"], F.concat(own["base"], candidate_spans(F.col(text), F.col(own["base"]))))
            .withColumn(own["found"], F.transform(own["found"], lambda s: s.withField("value", F.sha2(s["value"], 256)))).drop(own["base"])
            .withColumn(own["same"], F.sha2(F.col(text), 256)).withColumn(own["row"], F.monotonically_increasing_id()))
    hits = materialize(hits, "secrets")
    spans = hits.select(F.col(own["row"]).alias("row"), F.col(own["same"]).alias("same"), F.struct(F.col(owner)).alias("o"), F.struct(F.col(repository)).alias("r"), F.explode(own["found"]).alias("s"))
    once = spans.groupBy("s.value", "same").agg(F.min(F.struct("o", "r")).alias("first")).select("value", "first.*")
    owners = once.select("value", "o").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("owners"))
    repos = once.select("value", "r").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("repos"))
    live = owners.join(repos, "value").where((F.col("owners") <= limit) | (F.col("repos") <= max_repositories)).select("value", F.lit(True).alias("live"))
    marked = (spans.select("row", "s.*").join(live, "value", "left").where("kind <> 'owned' or live")
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind_no", "end", "kind", F.coalesce("live", F.lit(False)).alias("live")))).alias("all"))
              .select(F.col("row").alias(own["base"]), F.transform("all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["live"].alias("live"))).alias(out)))
    with_spans = (hits.join(marked, F.col(own["row"]) == F.col(own["base"]), "left")
                  .withColumn(out, F.coalesce(out, none)).drop(*own.values()))
    return df.where(~any_).withColumn(out, none).unionByName(with_spans)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mask: str = "[SECRET]") -> DataFrame:
    """``text`` with every span replaced by ``mask``; spans that overlap get one."""
    t = F.col(text)

    def step(state: Column, s: Column) -> Column:
        kept = F.concat(state["out"], t.substr(state["at"] + 1, s["start"] - state["at"]), F.lit(mask))
        return (F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), kept.alias("out")))
                .otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))))

    done = F.aggregate(F.col(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], t.substr(s["at"] + 1, F.length(t))))
    return df.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(t))
