"""URL filters: explicit host and path rules, then an empirical-Bayes host reputation.

Labelled page outcomes are counted by host, registered domain and suffix.  Each level is
shrunk towards the rest of the one above with a beta-binomial prior whose strength is
estimated from the spread of the rates at that level (method of moments) and limited by
the evidence for its mean, so a host with few labelled pages takes after its domain, and a
host with many speaks for itself.  A url is blocked
when the lower posterior bound of its host's bad rate is above ``max_bad_rate``.

Only DataFrame functions are used.  Pages are joined to one row per distinct host, which
holds the host's verdict and the rules that can apply to it and is written first; a host
with very many pages is a skewed join that Spark splits.

Defined results: a null url or one without ``://`` has an empty host and path, and takes
part as the host ``''``.  Null outcomes and null labelled urls count for no host.
Repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colforge.session import materialize

from .common import free_name, prepare

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Prior strength (pseudo-observations) stays in this range; the middle value is used
#: where the labelled groups are too few to estimate it.
MIN_STRENGTH, DEFAULT_STRENGTH, MAX_STRENGTH = 1.0, 10.0, 1000.0


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")


def _suffix(name: Column, suffixes: tuple[str, ...]) -> Column:
    """``suffix_of`` of a host without user and port.  A name can only end in a suffix of k
    labels if its last k labels are that suffix, so one lookup for each k is enough."""
    out = F.substring_index(name, ".", -1)
    for k in sorted({s.count(".") + 1 for s in suffixes}):
        tail = F.substring_index(name, ".", -k)
        out = F.when(tail.isin([s for s in suffixes if s.count(".") + 1 == k]), tail).otherwise(out)
    return out


def _domain(name: Column, suffix: Column) -> Column:
    before = name.substr(F.lit(1), F.length(name) - F.length(suffix) - 1)
    return F.when(name == suffix, suffix).otherwise(F.concat_ws(".", F.substring_index(before, ".", -1), suffix))


def suffix_of(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    """The public suffix: one of ``suffixes`` (like ``co.uk``), else the last label."""
    return _suffix(_name(host), suffixes)


def domain_of(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    """The registered domain: the suffix with one label before it."""
    return _domain(_name(host), suffix_of(host, suffixes))


def _with_levels(df: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """Add ``suffix`` and ``domain`` of each ``host``, every step on the column before it:
    written into one another they are a plan of thousands of expressions."""
    name, suffix = free_name(df, "_name"), F.col("suffix")
    df = df.withColumn(name, _name(F.col("host"))).withColumn("suffix", _suffix(F.col(name), suffixes))
    return df.withColumn("domain", _domain(F.col(name), suffix)).drop(name)


def _moments(children: DataFrame, parent: str) -> DataFrame:
    """One row on the spread that the rates k/n of ``children`` have round the rate of their
    ``parent``, and all their n and k."""
    groups = children.groupBy(parent).agg(F.sum("n").alias("pn"), F.sum("k").alias("pk"), F.count(F.lit(1)).alias("g"),
                                          F.sum(F.col("n") * F.col("n")).alias("nn"),
                                          F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kkn"))
    p = F.col("pk") / F.col("pn")
    pq = p * (1 - p)
    spread = F.col("kkn") - F.col("pk") * p  # sum of n (k/n - p)^2
    return groups.agg(F.lit(parent).alias("parent"), F.sum("pn").alias("n"), F.sum("pk").alias("k"), F.sum(spread - pq * (F.col("g") - 1)).alias("over"),
                      F.sum(pq * (F.col("pn") - F.col("nn") / F.col("pn") - (F.col("g") - 1))).alias("room"))


def _strength(row) -> float:
    """Concentration of the beta prior of a level, from its ``_moments``."""
    if not row["room"] or row["room"] <= 0:
        return DEFAULT_STRENGTH
    rho = row["over"] / row["room"]
    return min(MAX_STRENGTH, max(MIN_STRENGTH, 1 / rho - 1)) if rho > 0 else MAX_STRENGTH


def host_reputation(hosts: DataFrame, outcomes: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """For each ``host`` of ``hosts``: ``a``, ``b``, the beta posterior of its bad rate.
    ``outcomes`` has ``host`` and ``bad`` (boolean; null rows do not count).  They are
    counted once, by host, and the counts written; three rows of sums reach the driver."""
    n, k = F.sum("n").alias("n"), F.sum("k").alias("k")
    by_host = (outcomes.where("bad is not null and host is not null").groupBy("host")
               .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k")))
    by_host = materialize(_with_levels(by_host, suffixes), "host-outcomes")
    by_domain = by_host.groupBy("suffix", "domain").agg(n, k)
    by_suffix = by_domain.groupBy("suffix").agg(n, k)
    levels = _moments(by_suffix.withColumn("all", F.lit(1)), "all").union(_moments(by_domain, "suffix")).union(_moments(by_host, "domain"))
    found = {r["parent"]: r for r in levels.collect()}
    total = {c: found["all"][c] or 0 for c in ("n", "k")}
    overall = (total["k"] + 1.0) / (total["n"] + 2.0)
    s_suffix, s_domain, s_host = (_strength(found[c]) for c in ("all", "suffix", "domain"))

    counts = (_with_levels(hosts.select("host"), suffixes).join(by_host.select("host", F.col("n").alias("nh"), F.col("k").alias("kh")), "host", "left")
              .join(by_domain.select("domain", F.col("n").alias("nd"), F.col("k").alias("kd")), "domain", "left")
              .join(by_suffix.select("suffix", F.col("n").alias("ns"), F.col("k").alias("ks")), "suffix", "left"))
    counts = counts.select("host", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("nh", "kh", "nd", "kd", "ns", "ks")])
    # Each level's prior comes from the others of the level above, so nothing counts twice,
    # and is no stronger than the evidence for it.
    both = lambda strength, evidence: F.lit(strength) * evidence / (F.lit(strength) + evidence)
    step = counts.withColumn("m", both(s_suffix, F.lit(total["n"] + 2.0)))
    step = step.withColumn("e", F.col("ns") - F.col("nd") + F.col("m")).withColumn("p", (F.col("ks") - F.col("kd") + F.col("m") * overall) / F.col("e"))
    step = step.withColumn("m", both(s_domain, F.col("e")))
    step = step.withColumn("e", F.col("nd") - F.col("nh") + F.col("m")).withColumn("p", (F.col("kd") - F.col("kh") + F.col("m") * F.col("p")) / F.col("e"))
    step = step.withColumn("m", both(s_host, F.col("e")))
    return step.select("host", (F.col("kh") + F.col("m") * F.col("p")).alias("a"), (F.col("nh") - F.col("kh") + F.col("m") * (1 - F.col("p"))).alias("b"))


def lower_bound(a: Column, b: Column, z: float) -> Column:
    """Lower posterior bound of a beta rate: the mean less ``z`` standard deviations."""
    p = a / (a + b)
    return p - F.lit(z) * F.sqrt(p * (1 - p) / (a + b + 1))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[UrlRule], url: str = "url",
                max_bad_rate: float = 0.5, z: float = 1.645, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the longest rule that fits, else null), ``verdict``
    (the rule's, else the reputation's) and ``bad_bound`` to ``pages``; input columns of
    these names are replaced, all others stay.  ``outcomes`` has ``url`` and ``bad``."""
    prepare(pages.sparkSession)
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict", "bad_bound") if c != url])
    key = free_name(pages, "_host")
    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    known = host_reputation(hosts, outcomes.select(host_of(F.col("url")).alias("host"), "bad"), suffixes)
    host = F.col("host")
    longest = sorted(rules, key=lambda r: -len(r.text))
    fitting = F.filter(F.array(*[
        F.when((host == r.host) | host.endswith(f".{r.host}"),
               F.struct(F.lit(r.text).alias("rule"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")))
        for r in longest]), lambda r: r.isNotNull()) if rules else F.lit(None).cast("array<struct<rule:string,path:string,verdict:string>>")
    known = known.select(F.col("host").alias(key), lower_bound(F.col("a"), F.col("b"), z).alias(f"{key}_bound"), fitting.alias(f"{key}_rules"))
    known = materialize(known, "host-verdicts")  # of known size, and both sides of the join are plain shuffles
    path = path_of(F.col(url))
    rule = F.get(F.filter(F.col(f"{key}_rules"), lambda r: F.startswith(path, r["path"])), F.lit(0))
    joined = pages.withColumn(key, host_of(F.col(url))).join(known, key)
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns], F.col(key).alias("host"), path.alias("path"), rule["rule"].alias("rule"),
                         F.coalesce(rule["verdict"], F.when(F.col(f"{key}_bound") > max_bad_rate, "block").otherwise("allow")).alias("verdict"),
                         F.col(f"{key}_bound").alias("bad_bound"))
