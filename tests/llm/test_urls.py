import random

import pytest
from pyspark.sql import functions as F

from colforge.llm import urls
from colforge.llm.queries import RULES, SUFFIXES


def run(spark, pages, outcomes=(), rules=RULES, **kw):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(pages)], "page_id long, url string").withColumn("host", F.lit("mine")).withColumn("_host", F.lit("x"))
    out = spark.createDataFrame(list(outcomes) or [(None, None)], "url string, bad boolean")
    return {r["page_id"]: r for r in urls.filter_urls(df, out, rules, **kw).collect()}


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://A.Example.NET/de/x?q#f", "a.example.net", "/de/x", "net/", "block"),
    ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("x://b.example.com/de/?a", "b.example.com", "/de/", "example.com/de/", "block"),
    ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
    ("http://a.net", "a.net", "", None, "allow"), ("http://a.net?/x", "a.net", "", None, "allow"),
    ("http://Ünï.NET/", "Ünï.net", "/", "net/", "block"), ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("no scheme.net/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://x\ny.net/\nz", "x\ny.net", "/\nz", "net/", "block"),
])
def test_rules(spark, url, host, path, rule, verdict):
    r = run(spark, [url])[0]
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)
    assert r["_host"] == "x"


def test_reputation_shrinks_to_the_domain(spark):
    rnd = random.Random(3)
    outcomes = [(f"http://s{i}.bad.com/{j}", rnd.random() < 0.95) for i in range(30) for j in range(20)]
    outcomes += [(f"http://s{i}.good.com/{j}", rnd.random() < 0.05) for i in range(30) for j in range(20)]
    outcomes += [("http://lone.fresh.com/", True), (None, True), ("http://s0.good.com/", None)]
    got = run(spark, ["http://s1.bad.com/", "http://new.bad.com/", "http://new.good.com/", "http://lone.fresh.com/"], outcomes, rules=[])
    assert [got[i]["verdict"] for i in range(4)] == ["block", "block", "allow", "allow"]
    assert got[0]["rule"] is None and got[1]["bad_bound"] > 0.5 > got[2]["bad_bound"]


def test_suffix_and_domain(spark):
    rows = spark.createDataFrame([("a.b.co.uk:80",), ("u@b.com",), ("com",), ("",), ("x.y.z.org",)], "host string")
    got = rows.select(urls.suffix_of(F.col("host"), ("co.uk",)), urls.domain_of(F.col("host"), ("co.uk",))).collect()
    assert [tuple(r) for r in got] == [("co.uk", "b.co.uk"), ("com", "b.com"), ("com", "com"), ("", ""), ("org", "z.org")]


def test_sites_of_one_public_suffix_do_not_share_a_reputation(spark):
    rnd = random.Random(5)
    outcomes = [(f"http://s{i}.bad.co.uk/{j}", rnd.random() < 0.95) for i in range(20) for j in range(20)]
    outcomes += [(f"http://s{i}.good.co.uk/{j}", rnd.random() < 0.05) for i in range(20) for j in range(20)]
    pages = ["http://new.bad.co.uk/", "http://new.good.co.uk/"]
    whole = run(spark, pages, outcomes, rules=[], suffixes=SUFFIXES)
    assert [whole[i]["verdict"] for i in range(2)] == ["block", "allow"]
    shared = run(spark, pages, outcomes, rules=[])  # co.uk as one registered domain
    assert len({shared[i]["bad_bound"] for i in range(2)}) == 1


def test_query_and_sql_agree_on_suffixes_and_repeated_pages(spark, tmp_path):
    import duckdb
    from colforge.llm import queries as Q
    rnd = random.Random(6)
    hosts = ["a.bad.co.uk", "b.bad.co.uk", "x.good.co.uk", "co.uk", "bad.co.uk", "com", "y.z.com", "z.com", "one.net.au", "net.au", "", "u@b.co.jp:80", "l" * 5000 + ".co.uk"]
    pages = [(i // 2, f"http://{h}/{'p' * (i % 3)}") for i, h in enumerate(hosts * 12)] + [(7, None), (7, "no scheme"), (None, "http://bad.co.uk/")]
    labels = [(i, int(rnd.random() < (0.1 if "bad" in hosts[2 * i % len(hosts)] else 0.9)), 0) for i in range(70)]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = sorted(map(str, (tuple(r) for r in Q.op3_url_filter(spark, str(tmp_path)).collect())))
    pages, labels = pages.toPandas(), labels.toPandas()  # read by DuckDB
    pages["page_id"] = pages["page_id"].astype("Int64")
    want = duckdb.sql(Q._OP3_SQL).limit(10**6).fetchall()
    assert got == sorted(map(str, want)) and len(got) == 159


def test_empty(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.filter_urls(empty, spark.createDataFrame([], "url string, bad boolean"), RULES).count() == 0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = urls.filter_urls(df, spark.createDataFrame([], "url string, bad boolean"), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_plan_does_not_grow_with_the_suffixes(spark):
    """The driver plans and compiles these expressions; nested per suffix they took its memory."""
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    outcomes = spark.createDataFrame([("http://a.net/", True)], "url string, bad boolean")
    sizes = [len(urls.filter_urls(pages, outcomes, RULES, suffixes=tuple(f"s{i}.uk" for i in range(n)))._jdf.queryExecution().optimizedPlan().toString())
             for n in (1, 60)]
    assert sizes[1] < sizes[0] + 4000


def test_outcomes_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)
    outcomes = spark.createDataFrame([("http://a.net/", True), ("http://b.a.net/", False), (None, True)], "url string, bad boolean")
    seen = F.udf(lambda u: (read.add(1), u)[1], "string").asNondeterministic()
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, "http://c.org/")], "page_id long, url string")
    out = urls.filter_urls(pages, outcomes.select(seen("url").alias("url"), "bad"), RULES, suffixes=SUFFIXES)
    assert out.count() == 2 and len(out.collect()) == 2
    assert read.value == 3


def test_suffixes_of_several_lengths(spark):
    suffixes = ("co.uk", "a.co.uk", "org", "", "x.org")
    hosts = ["", "uk", "co.uk", ".co.uk", "b.co.uk", "a.co.uk", "c.a.co.uk", "xa.co.uk", "x.org", "yx.org", "a.", "com.", "u@p.x.org:8", "a..co.uk", "é.x.org"]

    def plain(host):
        name = host.split("@")[-1].split(":")[0]
        return max((s for s in suffixes if name == s or name.endswith("." + s)), key=len, default=name.split(".")[-1])
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r[0]: r[1] for r in rows.select("host", urls.suffix_of(F.col("host"), suffixes)).collect()}
    assert got == {h: plain(h) for h in hosts}
