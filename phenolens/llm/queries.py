"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed values of the contracts: A-Z, and the six stripped white-space characters.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def register(name: str, sql: str | None = None):
    def deco(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f
    return deco


@register("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.sharding import shard_documents
    return shard_documents(documents(spark, sf_dir), 8)


@register("op3_line_dedup", f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM d),
k AS (SELECT doc_id, pos, line, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM l),
g AS (SELECT key, max(doc_id) AS keep_doc FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, pos, line, g.key IS NOT NULL AND k.doc_id < keep_doc AS dropped FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.line_dedup import dedup_lines
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op5_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM d""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.exact_dedup import exact_dedup
    return exact_dedup(documents(spark, sf_dir))


_WORDS = f"regexp_extract_all({_LOWER.format('coalesce(text, {q})')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".replace(
    "{q}", "''")


@register("op9_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT n, item_id, array_to_string(w[i:i + n - 1], ' ') AS span
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
ns AS (SELECT DISTINCT n FROM bl),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS span
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.span = bw.span),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.decontamination import decontaminate
    return decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


@register("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.packing import pack_documents
    return pack_documents(documents(spark, sf_dir))


@register("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.html_extraction import extract_main
    return extract_main(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@register("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.quality import classify
    return classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def url_list_events(pages: DataFrame) -> DataFrame:
    """Dated events of three lists about the hosts of ``pages``; days and choices follow from
    the hosts' MD5: hosts that a block list adds, removes and sometimes adds again, whole
    domains that a second list holds for some days, and sections that an allow list excepts."""
    from phenolens.llm.url_filters import host, path

    def digits(col):
        return F.conv(F.substring(F.md5(col), 1, 6), 16, 10).cast("int")

    urls = pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).filter("host is not null")
    hosts = urls.select("host").distinct().withColumn("x", digits(F.col("host")))
    day = F.col("x") % 200
    block = [hosts.filter("x % 2 = 0").select(F.col("host").alias("pattern"), F.lit("block").alias("list"),
                                              F.lit(False).alias("allow"), d.alias("day"), F.lit(a).alias("added"))
             for d, a in ((day, True), (day + 40 + F.col("x") % 50, False))]
    block.append(hosts.filter("x % 4 = 0").select(
        F.col("host").alias("pattern"), F.lit("block").alias("list"), F.lit(False).alias("allow"),
        (day + 120).alias("day"), F.lit(True).alias("added")))
    domains = (hosts.select(F.substring_index("host", ".", -2).alias("pattern")).distinct()
               .withColumn("x", digits(F.col("pattern"))))
    domain = [domains.select("pattern", F.lit("domain").alias("list"), F.lit(False).alias("allow"), d.alias("day"),
                             F.lit(a).alias("added")) for d, a in ((F.col("x") % 300, True), (F.col("x") % 300 + 20, False))]
    sections = (urls.select(F.concat("host", F.lit("/"), F.split("path", "/")[1], F.lit("/")).alias("pattern")).distinct()
                .withColumn("x", digits(F.col("pattern"))).filter("x % 3 = 0"))
    allow = [sections.select("pattern", F.lit("allow").alias("list"), F.lit(True).alias("allow"), d.alias("day"),
                             F.lit(a).alias("added")) for d, a in ((F.col("x") % 250, True), (F.col("x") % 250 + 100, False))]
    out = None
    for part in block + domain + allow:
        part = part.select("list", "pattern", "allow", "day", "added")
        out = part if out is None else out.unionByName(part)
    return out


_HOST = """nullif(regexp_replace(regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\\\]*)', 1)),
 '^.*@', ''), '\\.?(:[0-9]*)?$', ''), '')"""
_PATH = """regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\\\]*([^?#]*)', 1)"""


@register("op10_url_filters", f"""
WITH c AS (SELECT page_id, url, ((page_id * 37) % 365)::INT AS day, {_HOST} AS host,
                  CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END AS path FROM pages),
h AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::INT AS x FROM c WHERE host IS NOT NULL),
dm AS (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS pattern FROM h),
dx AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 6))::INT AS x FROM dm),
s AS (SELECT DISTINCT host || '/' || string_split(path, '/')[2] || '/' AS pattern FROM c WHERE host IS NOT NULL),
sx AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 6))::INT AS x FROM s),
e AS (SELECT 'block' AS list, host AS pattern, false AS allow, x % 200 AS a, x % 200 + 40 + x % 50 AS z FROM h WHERE x % 2 = 0
      UNION ALL SELECT 'block', host, false, x % 200 + 120, 1000000 FROM h WHERE x % 4 = 0
      UNION ALL SELECT 'domain', pattern, false, x % 300, x % 300 + 20 FROM dx
      UNION ALL SELECT 'allow', pattern, true, x % 250, x % 250 + 100 FROM sx WHERE x % 3 = 0),
m AS (SELECT c.page_id, e.list, e.allow FROM c JOIN e ON day >= a AND day < z AND CASE WHEN contains(pattern, '/')
        THEN starts_with(host || path, pattern) ELSE host = pattern OR ends_with(host, '.' || pattern) END),
g AS (SELECT page_id, count(*) AS n, list_sort(list(DISTINCT list)) AS lists, bool_or(allow) AS allow FROM m GROUP BY page_id)
SELECT c.page_id, url, day, host, coalesce(n, 0)::BIGINT AS n_active, coalesce(array_to_string(lists, ','), '') AS lists,
       coalesce(allow, true) AS allowed FROM c LEFT JOIN g ON c.page_id = g.page_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.url_filters import judge
    pages = table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", ((F.col("page_id") * 37) % 365).cast("int").alias("day"))
    return judge(captures, url_list_events(pages)).withColumn("lists", F.array_join("lists", ","))


@register("op7_near_dedup", f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM (SELECT * FROM s WHERE g IN (SELECT g FROM f)) a
      JOIN (SELECT * FROM s WHERE g IN (SELECT g FROM f)) b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(seen) AS component_id, d.doc_id = min(seen) AS kept
FROM d JOIN r ON d.doc_id = r.node LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.near_dedup import near_dedup
    return near_dedup(documents(spark, sf_dir))


@register("op6_suffix_array_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s),
x AS (SELECT doc_id, i FROM w JOIN m ON w.s = m.s AND doc_id > low),
g AS (SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 50 AS new FROM x),
n AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM n GROUP BY doc_id, run),
p AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
k AS (SELECT p.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.suffix_dedup import remove_repeats
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_lexical_search", f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
n AS (SELECT doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
p AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, a GROUP BY term, docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
m AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM n, a),
s AS (SELECT item_id, p.doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, p.doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.lexical_search import search
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


@register("op12_license_scans")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from phenolens.llm.license_scan import scan, summarise
    return summarise(scan(documents(spark, sf_dir)))
