"""The registered queries of the training-data operators, with their SQL where there is one.

Each entry of ``Q`` is ``name -> (callable(spark, sf_dir) -> DataFrame, SQL or None)``.
Operators whose hash or model SQL lacks have None and are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting, codebooks, digest, divergence, html, langid, mixing, packing, quality, secrets, simhash, urls, warc
from .common import table

#: The file of the public byte-level tokenizer; a parameter of the packing operator.
TOKENIZER = "byte_bpe_50k.json"

RULES = [urls.UrlRule("block", "net", "/"), urls.UrlRule("allow", "example.net", "/en/"),
         urls.UrlRule("block", "example.com", "/de/"), urls.UrlRule("allow", "org", "/fr/")]


# Public suffixes of two labels under which many owners register domains; the
# commonest of the public suffix list.  Any other host's suffix is its last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr",
            "com.br", "com.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.tw")


def read_tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.apply_quality(docs).select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                                              "quality.n_repeat_words", "quality.base_failed", "quality.kept")


_OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
c AS (SELECT rid, doc_id, words, lines, len(words) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             length(regexp_replace(text, '[^\x21-\x40\x5B-\x60\x7B-\x7E]', '', 'g')) AS n_other,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets FROM w),
win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s
        FROM (SELECT rid, words, unnest(range(1, greatest(n_words - 1, 1))) AS i FROM c)),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM win),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE n > 1) GROUP BY rid),
top AS (SELECT rid, max(n) AS top_word FROM (SELECT rid, x, count(*) AS n FROM (SELECT rid, unnest(words) AS x FROM c) GROUP BY rid, x) GROUP BY rid),
f AS (SELECT c.*, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(top_word, 0) AS top_word
      FROM c LEFT JOIN cov USING (rid) LEFT JOIN top USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 12 * n_words
            OR 10 * n_other > 4 * word_chars OR 10 * n_dup_lines > 3 * len(lines) OR 10 * n_bullets > 9 * len(lines)
            OR 4 * top_word > n_words) AS kept
FROM b
"""


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The test tables label documents, not pages: a page takes the label of the document
    with its number, and counts as bad if that is of low quality or toxic."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    labels = table(spark, sf, "labels")
    outcomes = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urls.filter_urls(pages, outcomes, RULES, suffixes=SUFFIXES).select("page_id", "host", "path", "rule", "verdict")


_OP3_SQL = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
l AS (SELECT host, quality = 0 OR toxic = 1 AS bad FROM p JOIN labels ON page_id = doc_id),
nm AS (SELECT DISTINCT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM p),
sx AS (SELECT host, name, string_split(name, '.') AS labels, array_to_string(string_split(name, '.')[-2:], '.') IN {SUFFIXES} AS two FROM nm),
lv AS (SELECT host, CASE WHEN two THEN array_to_string(labels[-2:], '.') ELSE labels[-1] END AS suffix,
              array_to_string(labels[(CASE WHEN two THEN -3 ELSE -2 END):], '.') AS domain FROM sx),
bh AS (SELECT host, suffix, domain, count(*) AS n, sum(bad::INT)::BIGINT AS k FROM l JOIN lv USING (host) WHERE bad IS NOT NULL GROUP BY ALL),
bd AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM bh GROUP BY ALL),
bs AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM bd GROUP BY ALL),
overall AS (SELECT (coalesce(sum(k), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 2.0::DOUBLE) AS p FROM bs),
kids AS (SELECT 'suffix' AS lvl, 'all' AS par, n::DOUBLE AS n, k::DOUBLE AS k FROM bs
         UNION ALL SELECT 'domain', suffix, n, k FROM bd UNION ALL SELECT 'host', domain, n, k FROM bh),
par AS (SELECT lvl, par, sum(n) AS pn, sum(k) AS pk, count(*) AS g, sum(n * n) AS nn, sum(k * k / n) AS kkn FROM kids GROUP BY ALL),
mom AS (SELECT lvl, sum(kkn - pk * pk / pn - pk / pn * (1 - pk / pn) * (g - 1)) AS over_,
               sum(pk / pn * (1 - pk / pn) * (pn - nn / pn - (g - 1))) AS room FROM par GROUP BY lvl),
st AS (SELECT lvl, CASE WHEN room IS NULL OR room <= 0 THEN 10.0::DOUBLE WHEN over_ <= 0 THEN 1000.0::DOUBLE
                        ELSE least(1000.0::DOUBLE, greatest(1.0::DOUBLE, room / over_ - 1)) END AS s FROM mom),
sv AS (SELECT coalesce((SELECT s FROM st WHERE lvl = 'suffix'), 10.0::DOUBLE) AS ss, coalesce((SELECT s FROM st WHERE lvl = 'domain'), 10.0::DOUBLE) AS sd,
              coalesce((SELECT s FROM st WHERE lvl = 'host'), 10.0::DOUBLE) AS sh),
ct AS (SELECT lv.host, coalesce(bh.n, 0)::DOUBLE AS nh, coalesce(bh.k, 0)::DOUBLE AS kh, coalesce(bd.n, 0)::DOUBLE AS nd, coalesce(bd.k, 0)::DOUBLE AS kd,
              coalesce(bs.n, 0)::DOUBLE AS ns, coalesce(bs.k, 0)::DOUBLE AS ks
       FROM lv LEFT JOIN bh USING (host) LEFT JOIN bd ON bd.domain = lv.domain LEFT JOIN bs ON bs.suffix = lv.suffix),
tot AS (SELECT coalesce(sum(n), 0) + 2.0::DOUBLE AS e FROM bs),
ms AS (SELECT ct.*, sd, sh, overall.p AS p0, ss * tot.e / (ss + tot.e) AS m FROM ct, sv, tot, overall),
es AS (SELECT *, ns - nd + m AS e, (ks - kd + m * p0) / (ns - nd + m) AS p1 FROM ms),
md AS (SELECT * EXCLUDE (m), sd * e / (sd + e) AS m FROM es),
ed AS (SELECT * EXCLUDE (e), nd - nh + m AS e, (kd - kh + m * p1) / (nd - nh + m) AS p2 FROM md),
mh AS (SELECT * EXCLUDE (m), sh * e / (sh + e) AS m FROM ed),
ph AS (SELECT host, kh + m * p2 AS a, nh - kh + m * (1 - p2) AS b FROM mh),
rep AS (SELECT host, a / (a + b) - 1.645::DOUBLE * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5::DOUBLE AS bad FROM ph),
r(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (SELECT DISTINCT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM (SELECT DISTINCT host, path FROM p) JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path)
SELECT page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN rep.bad THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN rep USING (host) LEFT JOIN f ON f.host = p.host AND f.path = p.path
"""


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


_OP4_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)::BIGINT) & 31) + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first OR first IS NULL THEN NULL ELSE first END AS refers_to
FROM f
"""


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM d GROUP BY source),
o AS (SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / w AS full_at FROM s),
v AS (SELECT *, row_number() OVER (ORDER BY full_at, source NULLS LAST) AS i,
             (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s) - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
             / (sum(w) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lvl FROM o),
x AS (SELECT min(i) AS i FROM v WHERE lvl <= full_at),
t AS (SELECT source, source_size, CASE WHEN v.i < x.i THEN cap::DOUBLE ELSE least(cap::DOUBLE, (SELECT lvl FROM v v2 WHERE v2.i = x.i) * w) END AS target FROM v, x),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
g AS (SELECT source, h, sum(size)::BIGINT AS words FROM d GROUP BY source, h),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto FROM g),
a AS (SELECT c.source, c.h, q.target - passes * source_size AS budget, upto, upto - words AS below FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source),
k AS (SELECT source, h, upto <= budget OR (below <= budget AND upto - budget < budget - below) AS more FROM a)
SELECT d.doc_id, d.size, q.source_size, q.target, d.size * (passes + CASE WHEN more THEN 1 ELSE 0 END) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source JOIN k ON k.source IS NOT DISTINCT FROM d.source AND k.h = d.h
"""


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), read_tokenizer())


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = html.extract_text(table(spark, sf, "pages").select("page_id", "html"))
    return pages.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf, "documents").select("doc_id", "text", "source"))
    base = F.filter("spans", lambda s: s["kind"] != "owned")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


def _op8_find(kind: str, pattern: str, value: str = "m") -> str:
    """SQL for the matches of a pattern with their places, by the lengths of the gaps."""
    p = pattern.replace("'", "''")
    return f"""SELECT rid, '{kind}' AS kind, (list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda g: length(g))), 0))::BIGINT AS s,
       length(hits[i]) AS n, {value.replace('m', 'hits[i]')} AS value
  FROM (SELECT rid, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT rid, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS gaps FROM d WHERE regexp_matches(text, '{p}')))"""


_ASSIGN_SQL = secrets.ASSIGN.replace("'", "''")


def _op8_sql(max_owners: int = 5, max_repositories: int = 5, max_owner_share: float = 0.01) -> str:
    """The rule of ``scan_secrets``: a value is an example if more than ``max_owners`` owners,
    more than that share of all owners and more than ``max_repositories`` repositories have
    it; of equal texts the one of the smallest owner and repository counts."""
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source FROM documents),
f AS MATERIALIZED (
  SELECT rid, kind, s, s + n AS e, CASE WHEN kind = 'assign' THEN regexp_extract(value, '{_ASSIGN_SQL}', 1) ELSE value END AS value FROM (
  {_op8_find('assign', secrets.ASSIGN)} UNION ALL {_op8_find('access', secrets.ACCESS)} UNION ALL
  {_op8_find('hex', secrets.HEX)} UNION ALL {_op8_find('owned', secrets.CANDIDATE)})),
b AS (SELECT * FROM f WHERE kind IN ('access', 'hex') OR (kind = 'assign' AND length(value) >= 6)),
c AS (SELECT * FROM f WHERE kind = 'owned' AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
      AND NOT EXISTS (SELECT 1 FROM b WHERE b.rid = f.rid AND b.s < f.e AND f.s < b.e)),
u AS MATERIALIZED (SELECT * FROM b UNION ALL SELECT * FROM c),
t AS (SELECT value, source, doc_id, row_number() OVER (PARTITION BY value, text ORDER BY source NULLS FIRST, doc_id NULLS FIRST) AS i FROM u JOIN d USING (rid)),
n AS (SELECT value, count(DISTINCT source) + max((source IS NULL)::INT) AS owners, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS repos FROM t WHERE i = 1 GROUP BY value),
x AS (SELECT value FROM n WHERE owners > greatest({max_owners}, {max_owner_share}::DOUBLE * (SELECT count(*) FROM (SELECT DISTINCT source FROM d))) AND repos > {max_repositories}),
k AS (SELECT rid, kind, s, e, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END AS no FROM u
      WHERE kind <> 'owned' OR value NOT IN (SELECT value FROM x)),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (kind <> 'owned'), '') AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) AS spans FROM k GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = langid.identify_languages(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return digest.neighbour_digests(table(spark, sf, "documents"))


def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows, books = codebooks.learn_codes(table(spark, sf, "embeddings"), "embedding", "vec_id", "label")
    coded = rows.select(F.col("k").alias("vec_id"), "g", codebooks.code_text("c").alias("code"), codebooks.error_of("e").alias("error"))
    coded = codebooks.with_group_sum(coded, "g", "error", "label_error")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def _op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Complete scans in every round: ``a`` assigns, ``b`` moves the entries."""
    assign = "SELECT p.rid, p.j, p.x, min(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) ** 2))::BIGINT * {n} + b.e) AS m FROM p JOIN {b} b ON b.j = p.j GROUP BY ALL"
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED (" + assign.format(n=entries, b=f"b{r}") + ")")
        steps.append(f"""s{r} AS (SELECT j, m % {entries} AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM (SELECT j, m, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY ALL)""")
        steps.append(f"""m{r} AS (SELECT j, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY j, e)""")
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.j, b.e, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN m{r} m ON m.j = b.j AND m.e = b.e)")
    steps.append("z AS (" + assign.format(n=entries, b=f"b{rounds}") + ")")
    return f"""
WITH u AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding AS y FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x::DOUBLE) * 4096 > 134217728)) = 0),
f AS (SELECT len(y) AS d FROM u ORDER BY vec_id NULLS LAST, y LIMIT 1),
k AS MATERIALIZED (SELECT u.*, list_transform(y, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM u, f WHERE len(y) = d),
c AS (SELECT vec_id, arg_min(v, y) AS v, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS e FROM k GROUP BY vec_id ORDER BY vec_id NULLS LAST LIMIT {entries}),
p AS MATERIALIZED (SELECT rid, j, v[j * len(v) // {parts} + 1:(j + 1) * len(v) // {parts}] AS x FROM k, range({parts}) t(j)),
b0 AS (SELECT j, e, v[j * len(v) // {parts} + 1:(j + 1) * len(v) // {parts}] AS x FROM c, range({parts}) t(j)),
{(',' + chr(10)).join(steps)},
w AS (SELECT rid, string_agg(printf('%02x', m % {entries}), '' ORDER BY j) AS code, sum(m // {entries})::BIGINT AS error FROM z GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY j, e)) AS books FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, books AS codebooks_sha256 FROM w JOIN k USING (rid), h
"""


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf, "documents"))


_OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
           FROM documents),
o AS (SELECT rid, lang, source, unnest(words) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
z AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS size FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
l AS (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY ALL),
lz AS (SELECT lang, sum(n)::BIGINT AS size FROM l GROUP BY lang),
p AS MATERIALIZED (SELECT k.lang, z.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (z.size + 5 * v.v) AS p
      FROM k JOIN z ON z.lang = k.lang JOIN v ON v.lang = k.lang LEFT JOIN c ON c.lang = k.lang AND c.source = z.source AND c.term = k.term),
q AS (SELECT l.lang, l.term, 1 + (1000000000::HUGEINT * (l.n + 5)) // (lz.size + 5 * v.v) AS q FROM l JOIN lz USING (lang) JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - q.q)::BIGINT FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE C) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 50
"""


def op13_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = boosting.learn(docs, table(spark, sf, "labels"), langid.held_out)
    scored = boosting.score_texts(docs, model, out="score")
    return scored.select("doc_id", langid.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


Q = {
    "op1_quality_rules": (op1_quality_rules, _OP1_SQL),
    "op2_simhash": (op2_simhash, None),
    "op3_url_filter": (op3_url_filter, _OP3_SQL),
    "op4_warc": (op4_warc, _OP4_SQL),
    "op5_mixing": (op5_mixing, _OP5_SQL),
    "op6_packing": (op6_packing, None),
    "op7_html_text": (op7_html_text, None),
    "op8_secrets": (op8_secrets, _op8_sql()),
    "op9_language_id": (op9_language_id, None),
    "op10_fingerprints": (op10_fingerprints, None),
    "op11_vector_codes": (op11_vector_codes, _op11_sql()),
    "op12_source_divergence": (op12_source_divergence, _OP12_SQL),
    "op13_quality_classifier": (op13_quality_classifier, None),
}
