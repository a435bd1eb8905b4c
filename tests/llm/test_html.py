import random
import re

import pytest
from pyspark.sql import functions as F

from colforge.llm import html
from colforge.llm import queries as Q

from .helpers import SF


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("a<p>b<p>c", "a\n\nb\n\nc"), ("a<div>b</div>c", "a\nb\nc"), ("x<br>y", "x\ny"),
    ("<p>a <b>b</b>  c\n d</p>", "a b c d"), ("1 &lt; 2 &amp; 3&nbsp;x", "1 < 2 & 3\xa0x"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>z", "- a\n- b\n  3. x\n  4. y\n\nz"),
    ("<table><tr><td>aa<td>b<tr><td>c<td>dddd</table>", "aa  b\nc   dddd"),
    ("<table><thead><tr><th>h<tbody><tr><td>1<br>2<td>x</table>", "h\n1  x\n2"),
    ("<table><tr><td>a</td><td><table><tr><td>in<td>ner</table></td></tr></table>", "a  in  ner"),
    ("<table><tr><td colspan=2>wide<td>x<tr><td>a<td>b<td>c</table>", "wide     x\na     b  c"),
    ("<pre> x\n   y</pre>", " x\n   y"), ("<head><title>t</title></head><body>b", "b"), ("<script>if (a<b) '</p>'</script>s", "s"),
    ("<p hidden>no</p><p style='color:red; DISPLAY : none'>no</p><p style='visibility:hidden'>no</p>yes", "yes"),
    ("<!-- no --><![CDATA[ no ]]>yes<![bad x>", "yes"), ("<dl><dt>t<dd>d<dd>e</dl>", "t\n  d\n  e"), ("<img alt='pic'><input type=hidden value=no>", "pic"),
    ("<head><title>t</title>visible words<p>x", "visible words\n\nx"), ("<head><title>t</title><br>lost line<p>x", "lost line\n\nx"),
    ("<head>\n <meta name=a>\n<title>t</title>\n<img alt=pic> x", "pic x"), ("<head><script>s</script><hr>y", "y"),
    ("<input type=text value=shown>", "shown"), ("<input value=a> <input type=SEARCH value=b> <input type=password value=no><input type=checkbox value=no>", "a b"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes<i>also</i></b>no</div>", "yesalso"),
    ("<p style='display:none'>no<b style='visibility:visible'>no</b></p>yes", "yes"), ("<ul style='visibility:collapse'><li>no<li style='visibility:visible'>b</ul>", "- b"),
    ("<svg><title>no</title><text x=1>drawn</text><defs><text>no</text></defs></svg>", "drawn"),
    ("</div></p>x</table></td>", "x"), ("<li>lone<td>cell", "- lonecell"), ("<blockquote>q</blockquote>", "  q"),
])
def test_layout(page, text):
    assert html.render(page) == text


def visible_words(page):
    page = re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", page)
    return re.findall(r"\w+", re.sub(r"&\w+;", " ", re.sub(r"<[^>]*>", " ", page)))


def test_all_visible_words_are_there(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.op7_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        assert "".join(visible_words(pages[r["page_id"]])) == "".join(re.findall(r"\w+", r["text"]))


def test_broken_pages_never_fail():
    rnd = random.Random(2)
    bits = ["<p", ">", "<table>", "</table>", "<td", "<li>", "</ul>", "<ul>", "<!", "<![", "--", "<!--", "&", "&#", "&#x110000;", "<script>", "</script", "text ", "\x00", "<a href='", '"', "=", "/", "<pre>\n", "<tr>", "<ol start=9999999999>", "<td colspan=99999>", "<head>", "<?", "</", "<br/>", "<select><option>"]
    for _ in range(1500):
        html.render("".join(rnd.choices(bits, k=rnd.randint(1, 40))))


def test_depth_and_length_are_no_limit():
    assert html.render("<div><ul><li>" * 5000 + "deep").endswith("deep")
    assert html.render("<p>w " * 100_000).count("w") == 100_000


def test_spark_rows(spark):
    df = spark.createDataFrame([(1, "<p>a"), (2, None), (2, None)], "page_id long, html string").withColumn("text", F.lit("mine")).withColumn("tag", F.lit("x"))
    assert sorted(tuple(r) for r in html.extract_text(df).select("page_id", "text", "tag").collect()) == [(1, "a", "x"), (2, "", "x"), (2, "", "x")]
    assert html.extract_text(df.limit(0)).count() == 0
