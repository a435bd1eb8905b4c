import gzip
import os
import re

import pytest
from pyspark.sql import functions as F

from colforge.llm import warc

ROWS = [(1, "http://a/", "<p>é🙂"), (2, None, "<p>é🙂"), (3, "http://c/ x\r\ny", None), (4, "http://d/", ""), (None, "http://e/", "<p>é🙂"),
        (5, "http://f/", "z" * 300_000), (6, "http://g/", "head\r\n\r\nmore"), (6, "http://g/", "head\r\n\r\nmore"), (None, "n", "only")]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("payload", F.lit("mine")).withColumn("_n", F.lit(1))
    path = str(tmp_path_factory.mktemp("warc") / "a")
    warc.write_archive(df.repartition(3), path)
    return path


def test_round_trip(spark, archive):
    got = sorted(((r["record_id"] or "", r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"]) for r in warc.read_archive(spark, archive).collect()), key=str)
    want = []
    for i, _, h in ROWS:
        raw = (h or "").encode()
        same = [j for j, _, x in ROWS if (x or "") == (h or "") and j is not None]
        first = min(same, default=None)
        revisit = first is not None and i != first
        want.append((str(i or ""), "revisit" if revisit else "response", str(first) if revisit else None, len(raw), warc.payload_digest(raw), None if revisit else raw))
    assert got == sorted(((a, b, c, d, e, None if f is None else bytearray(f)) for a, b, c, d, e, f in want), key=str)


def test_headers_and_url(spark, archive):
    rows = warc.read_archive(spark, archive, "record_id string, target_uri string").collect()
    assert {r["record_id"]: r["target_uri"] for r in rows if r["record_id"]}["3"] == "http://c/%20x%0D%0Ay"
    assert [r["target_uri"] for r in rows if r["record_id"] == "2"] == [None]


def test_filters_are_pushed_down(spark, archive):
    df = warc.read_archive(spark, archive).where("record_type = 'revisit' and target_uri like 'http://g%'")
    assert [r["record_id"] for r in df.collect()] == []
    df = warc.read_archive(spark, archive).where((F.col("record_type") == "revisit") & F.col("refers_to").isin("1", "9"))
    assert sorted(str(r["record_id"]) for r in df.collect()) == ["2", "None"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and not re.search(r"[*)+-] ?Filter ", plan)  # Spark tests nothing again


def test_unwanted_payloads_are_not_inflated(archive):
    reader = warc.WarcReader({"path": archive}, warc_schema("record_id string, record_type string"))
    reader.tests = [("record_type", lambda x, v: x == v, "response")]
    total = sum(os.path.getsize(os.path.join(archive, f)) for f in os.listdir(archive) if f.endswith(".gz"))
    assert total > 0
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert {r[1] for r in rows} == {"response"} and len(rows) == 6


def warc_schema(text):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(text)


def test_archives_from_elsewhere(spark, tmp_path):
    records = [warc.record_bytes(str(i), "response", f"http://x/{i}", None, b"payload %d" % i * 5000, "2020-01-01T00:00:00Z") for i in range(4)]
    (tmp_path / "gz").mkdir()
    (tmp_path / "plain").mkdir()
    (tmp_path / "gz" / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "plain" / "a.warc").write_bytes(b"".join(records))
    for kind in ("gz", "plain"):
        for columns in (warc.SCHEMA, "record_id string"):
            rows = warc.read_archive(spark, str(tmp_path / kind), columns).collect()
            assert sorted(r["record_id"] for r in rows) == list("0123")
            if columns == warc.SCHEMA:
                assert all(bytes(r["payload"]) == b"payload %d" % int(r["record_id"]) * 5000 for r in rows)


def http(header, payload):
    return b"HTTP/1.1 200 OK\r\n" + header + b"\r\n" + payload


def foreign(record_id, block, kind="response"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{record_id}>\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


FOREIGN = [foreign(0, http(b"X-Long: " + b"h" * 8192 + b"\r\nContent-Length: 7\r\n", b"payload")), foreign(1, http(b"", b"no\r\n\r\nlength" * 30_000)),
           foreign(2, b"software: x\r\n\r\ny", "warcinfo"), foreign(3, http(b"Content-Length: 99\r\n", b""), "revisit"), foreign(4, b""), foreign(5, http(b"", b""), "revisit"),
           foreign(6, http(b"", b"last"))]
WANT = {"0": (7, b"payload"), "1": (360_000, b"no\r\n\r\nlength" * 30_000), "2": (16, None), "3": (99, None), "4": (0, b""), "5": (None, None), "6": (4, b"last")}


@pytest.mark.parametrize("kind", ["one member", "a member each", "two of three", "plain", "no line breaks between"])
def test_all_records_of_foreign_archives(spark, tmp_path, kind):
    raw = {"one member": gzip.compress(b"".join(FOREIGN)), "a member each": b"".join(map(gzip.compress, FOREIGN)),
           "two of three": gzip.compress(b"".join(FOREIGN[:3])) + gzip.compress(b"".join(FOREIGN[3:])), "plain": b"".join(FOREIGN),
           "no line breaks between": b"".join(r[:-4] for r in FOREIGN)}[kind]
    (tmp_path / ("a.warc.gz" if "member" in kind or "three" in kind else "a.warc")).write_bytes(raw)
    full = {r["record_id"]: (r["payload_bytes"], None if r["payload"] is None else bytes(r["payload"])) for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert full == WANT
    # the size does not depend on the columns that are asked for
    sizes = {r[0]: r[1] for r in warc.read_archive(spark, str(tmp_path), "record_id string, payload_bytes long").collect()}
    assert sizes == {k: v[0] for k, v in WANT.items()}
    some = warc.read_archive(spark, str(tmp_path)).where("record_type = 'revisit'")
    assert sorted(r["record_id"] for r in some.collect()) == ["3", "5"]


def test_a_cut_off_archive_ends(spark, tmp_path):
    whole = gzip.compress(b"".join(FOREIGN), mtime=0)
    for n in (30, len(whole) // 2, len(whole) - 5):
        (tmp_path / "a.warc.gz").write_bytes(whole[:n])
        assert warc.read_archive(spark, str(tmp_path), "record_id string").count() <= len(FOREIGN)


def test_columns_with_names_used_inside(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    df = df.select("*", *[F.lit(c).alias(c) for c in ("_first", "_digest", "n", "_n", "payload", "record_type")])
    out = warc.with_revisits(df)
    assert set(df.columns) <= set(out.columns)
    rows = {r["page_id"]: r for r in out.collect()}
    assert (rows[2]["record_type"], rows[2]["refers_to"], rows[1]["record_type"]) == ("revisit", 1, "response")
    assert all(r["_first"] == "_first" and r["_digest"] == "_digest" and r["n"] == "n" for r in rows.values())
    assert sorted(warc.round_trip(df).select("page_id", "payload_bytes", "refers_to").collect()) == [(1, 2, None), (2, 2, 1)]


def test_members_are_plain_gzip():
    raw = warc.record_bytes("1", "response", "u", None, b"x" * 5000, "d")
    member = warc.gzip_member(raw, 1)
    assert gzip.decompress(member + member) == raw * 2


def test_empty(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.with_revisits(df, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
