"""Queries over the driver's tables, one or more an operator, each with the SQL that DuckDB holds it against.

Where the tables lack a column that an operator needs (phones, coordinates, several e-mails), it is made from keys by the
same arithmetic on both sides.
"""

from __future__ import annotations

import math
import uuid

from harrow.functions import documents, emails, places, text, web
from harrow.operators import clusters, dedup, filters, joins, leads
from harrow.sources import pages as fetched
from harrow.sources import tables, xlsx
from harrow.streaming import resume
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crawl, jobs
from .variants import FORMATTING, LISTINGS, PT_HOTELS, SEARCH_URL, SK_AGENCIES

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "pages":  # whole pages of 10,000 rows at once are too much for a Python worker
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return tables.spread(df, "c_custkey") if name == "customer" else df


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_EXTRACT = r"""list_distinct(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7}\b'), lambda x: lower(x)),
  lambda x: NOT regexp_matches(x, '\.(png|jpg|jpeg|gif|svg|webp|pdf|css|js|ico|woff|woff2|mp4|mp3)$')))"""
_GENERIC, _BAD, _PRE = _quoted(emails.GENERIC_DOMAINS), _quoted(emails.BAD_WORDS), _quoted(emails.PREFIXES)
_SCORE = f"""(CASE WHEN dom IN ({_GENERIC}) THEN 0 ELSE 10 END + CASE WHEN len(list_filter([{_PRE}], lambda w: contains(loc, w))) > 0 THEN 5 ELSE 0 END
  - CASE WHEN len(list_filter([{_BAD}], lambda w: contains(loc, w) OR contains(dom, w))) > 0 THEN 20 ELSE 0 END)::DOUBLE - length(e) * 0.01::DOUBLE"""


@query(f"SELECT doc_id, array_to_string(list_sort({_EXTRACT}), ', ') AS emails, len({_EXTRACT})::INT AS n FROM documents")
def email_extract(spark, sf_dir):
    e = emails.extract(F.col("text"))
    return t(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(e), ", ").alias("emails"), F.size(e).alias("n"))


@query(f"""WITH x AS (SELECT unnest({_EXTRACT}) AS e FROM documents)
SELECT split_part(e, '@', 2) AS domain, count(*) AS addresses, count(DISTINCT e) AS distinct_addresses FROM x GROUP BY 1""")
def email_domain_stats(spark, sf_dir):
    e = t(spark, sf_dir, "documents").select(F.explode(emails.extract(F.col("text"))).alias("e"))
    return e.groupBy(emails.domain(F.col("e")).alias("domain")).agg(F.count("e").alias("addresses"), F.countDistinct("e").alias("distinct_addresses"))


_LOCALS = ("info", "jane", "noreply", "sales.team", "bob", "admin", "x", "testing", "contact-us", "maria")
_HOSTS = ("gmail.com", "acme.nz", "shop.co.nz", "example.com", "wix.com", "a.io", "outlook.com")


def _address(k: str, a: int, b: int, sql: bool):
    if sql:
        return f"[{_quoted(_LOCALS)}][(({k} * {a}) % {len(_LOCALS)} + 1)::INT] || '@' || [{_quoted(_HOSTS)}][(({k} * {b}) % {len(_HOSTS)} + 1)::INT]"
    pick = lambda words, m: F.element_at(F.array(*map(F.lit, words)), ((F.col(k) * m) % len(words) + 1).cast("int"))
    return F.concat(pick(_LOCALS, a), F.lit("@"), pick(_HOSTS, b))


@query(f"""WITH c AS (SELECT c_custkey, [{_address('c_custkey', 3, 5, True)}, {_address('c_custkey', 7, 11, True)}, {_address('c_custkey', 1, 2, True)}] AS es FROM customer),
u AS (SELECT c_custkey, generate_subscripts(es, 1) AS i, unnest(es) AS e FROM c),
s AS (SELECT *, split_part(e, '@', 1) AS loc, split_part(e, '@', 2) AS dom FROM u),
r AS (SELECT c_custkey, e, {_SCORE} AS s, i FROM s)
SELECT c_custkey, e AS best_email FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY s DESC, i) AS k FROM r) WHERE k = 1""")
def email_score_best(spark, sf_dir):
    cell = F.concat_ws(", ", *[_address("c_custkey", a, b, False) for a, b in ((3, 5), (7, 11), (1, 2))])
    return t(spark, sf_dir, "customer").select("c_custkey", emails.best(cell).alias("best_email"))


_ANCHORS = """regexp_extract_all(coalesce(html, ''), '(?is)<a\\b[^>]*\\bhref="([^"]*)"[^>]*>(.*?)</a>', 1)"""


@query(f"SELECT page_id, len({_ANCHORS})::INT AS links, array_to_string({_ANCHORS}, ' ') AS hrefs FROM pages")
def link_extract(spark, sf_dir):
    a = web.anchors(F.col("html"))
    return t(spark, sf_dir, "pages").select("page_id", F.size(a).alias("links"), F.array_join(F.transform(a, lambda x: x["href"]), " ").alias("hrefs"))


@query("""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<a\\b[^>]*\\bhref="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, count(*) AS same_host FROM l WHERE href <> '' AND NOT regexp_matches(lower(href), '^(mailto:|tel:|javascript:|#)')
 AND (NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:|^//') OR starts_with(href, regexp_extract(url, '^[a-z]+://[^/?#]*')))
GROUP BY page_id""")
def link_same_host(spark, sf_dir):
    links = t(spark, sf_dir, "pages").select("page_id", "url", F.explode(web.anchors(F.col("html"))).alias("a")).where(web.is_page_link(F.col("a.href")))
    full = links.withColumn("link", web.resolve(F.col("url"), F.col("a.href")))
    return full.where(web.host(F.col("link")) == web.host(F.col("url"))).groupBy("page_id").agg(F.count("*").alias("same_host"))


@query(f"""WITH p AS (SELECT page_id, url, html, regexp_extract(url, '^[a-z]+://[^/?#]*') AS base FROM pages),
l AS (SELECT page_id, url, base, generate_subscripts(h, 1) AS pos, unnest(h) AS href, unnest(b) AS label FROM
  (SELECT page_id, url, base, {_ANCHORS} AS h, {_ANCHORS.replace(', 1)', ', 2)')} AS b FROM p)),
f AS (SELECT page_id, pos, split_part(base || href, '#', 1) AS link, url, lower(href) AS a, lower(regexp_replace(label, '<[^>]*>', ' ', 'g')) AS b FROM l
  WHERE href LIKE '/%' AND href NOT LIKE '//%'),
s AS (SELECT *, CASE WHEN len(list_filter([{_quoted(web.CONTACT_WORDS)}], lambda w: contains(a, w) OR contains(b, w))) > 0 THEN 2
  WHEN len(list_filter([{_quoted(web.SERVICE_WORDS)}], lambda w: contains(a, w) OR contains(b, w))) > 0 THEN 1 ELSE 0 END AS priority FROM f WHERE link <> url),
o AS (SELECT page_id, link, priority, pos, row_number() OVER (PARTITION BY page_id, link ORDER BY priority DESC, pos) AS k FROM s),
r AS (SELECT page_id, link, priority::INT AS priority, row_number() OVER (PARTITION BY page_id ORDER BY priority DESC, pos)::INT AS rank FROM o WHERE k = 1)
SELECT * FROM r WHERE rank <= 4""")
def link_priority_topk(spark, sf_dir):
    return leads.next_pages(t(spark, sf_dir, "pages"))


#: Mixed markup after every page: quotes of both kinds and none, references, raw text, comments, inline and block elements. k is the page's number.
_MIXED = (
    "<p>mail info&#64;p", "k", ".nz or <b>sales</b><i>@p", "k", ".nz</i></p><div>x</div><a HREF='/one/", "k", "'>One &amp; <b>on</b>ly</a><a class=x href=two?k=", "k",
    "&amp;y=1>Two</a><script>var a = '<a href=\"no\">bad@p", "k", ".nz</a>';</script><!-- <a href='never'>c@p", "k", ".nz</a> --><a href=\"mailto:Boss@P", "k", ".nz?subject=x\">write</a>",
    "<a title='>' href = 'https://www.facebook.com/p", "k", "'>f</a><template>t@p", "k", ".nz</template>",
)


@query("""WITH h AS (SELECT page_id, page_id::VARCHAR AS k, regexp_replace(html, '(?is)<(script|style|title)[^>]*>.*?</(script|style|title)>|<!--.*?-->', ' ', 'g') AS x, html FROM pages),
t AS (SELECT *, regexp_replace(regexp_replace(x, '(?i)</?(a|b|i|em|strong|span|small|u|img)(\\s[^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS seen FROM h),
e AS (SELECT *, list_filter(list_transform(regexp_extract_all(replace(replace(seen, '&#64;', '@'), '&amp;', '&'), '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,7}\\b'), lambda m: lower(m)),
  lambda m: NOT regexp_matches(m, '\\.(png|jpg|jpeg|gif|svg|webp|pdf|css|js|ico|woff|woff2|mp4|mp3)$')) AS es FROM t)
SELECT page_id, array_to_string(list_sort(list_distinct(es || ['info@p' || k || '.nz', 'sales@p' || k || '.nz', 'boss@p' || k || '.nz'])), ', ') AS email,
 'https://www.facebook.com/p' || k AS facebook, len(regexp_extract_all(html, '<a href="')) + 4 AS links, '/one/' || k || ' One & only' AS first, 'two?k=' || k || '&y=1 Two' AS second FROM e""")
def page_contacts(spark, sf_dir):
    """S21 and X1b on the pages with mixed markup appended: addresses, social links and anchors as a reader of the page has them."""
    more = F.concat(*[F.col("page_id").cast("string") if p == "k" else F.lit(p) for p in _MIXED])
    p = t(spark, sf_dir, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), F.lit("</p>"), more).alias("html"))
    links = p.select("page_id", web.anchors(F.col("html")).alias("a"))
    shown = lambda i: F.concat(F.element_at("a", i)["href"], F.lit(" "), F.element_at("a", i)["label"])
    links = links.select("page_id", F.size("a").cast("long").alias("links"), shown(-4).alias("first"), shown(-3).alias("second"))
    return jobs.page_emails(p).select("page_id", "email", F.array_join("facebook", " ").alias("facebook")).join(links, "page_id")


@query("""SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS text_length FROM pages""")
def html_title_strip(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", web.title(F.col("html")).alias("title"), F.length(web.strip_tags(F.col("html"))).cast("long").alias("text_length"))


_SITE = r"regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '^www\.', ''), '/$', '')"


@query(f"SELECT page_id, {_SITE} AS website, row_number() OVER (ORDER BY {_SITE} = '', {_SITE}, page_id)::INT AS position FROM pages")
def website_normalize_sort(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", text.website_key(F.col("url")).alias("website"))
    return dedup.numbered(p, [(F.col("website") == "").cast("int"), F.col("website"), F.col("page_id")], "position")


@query("SELECT text, lang, min(doc_id) AS doc_id FROM documents GROUP BY text, lang")
def fullrow_dedup_first(spark, sf_dir):
    return dedup.first_of_equal_rows(t(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["text", "lang"], "doc_id")


@query("""WITH k AS (SELECT *, trim(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS name_key FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY p_size DESC, p_retailprice DESC, p_partkey) AS k, min(p_partkey) OVER (PARTITION BY name_key) AS group_pos
FROM k WHERE name_key <> '') SELECT name_key, p_partkey, p_size, p_retailprice, group_pos FROM r WHERE k = 1""")
def name_key_best_rep(spark, sf_dir):
    p = t(spark, sf_dir, "part").withColumn("name_key", text.name_key(F.col("p_name"))).select("p_partkey", "name_key", "p_size", "p_retailprice")
    return dedup.best_of_group(p, "name_key", [F.col("p_size"), F.col("p_retailprice")], "p_partkey")


@query("""WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY (c_custkey % 3 = 0), c_custkey) AS n, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'e' || ((c_custkey * 7919) % 400) END AS e,
'p' || ((c_custkey * 104729) % 500) AS p FROM customer),
f AS (SELECT 0::BIGINT AS n, 0::BIGINT AS c_custkey, false AS kept, []::VARCHAR[] AS se, []::VARCHAR[] AS sp
UNION ALL SELECT r.n, r.c_custkey, NOT ((r.e <> '' AND list_contains(f.se, r.e)) OR list_contains(f.sp, r.p)),
CASE WHEN r.e = '' OR list_contains(f.se, r.e) OR list_contains(f.sp, r.p) THEN f.se ELSE list_append(f.se, r.e) END,
CASE WHEN (r.e <> '' AND list_contains(f.se, r.e)) OR list_contains(f.sp, r.p) THEN f.sp ELSE list_append(f.sp, r.p) END
FROM f JOIN r ON r.n = f.n + 1) SELECT c_custkey FROM f WHERE kept""")
def greedy_two_key_dedup(spark, sf_dir):
    k = F.col("c_custkey")
    c = t(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("e"), (k * 7919) % 400)).alias("e"), F.concat(F.lit("p"), (k * 104729) % 500).alias("p")
    )
    return dedup.greedy_two_key(c, "e", "p", "c_custkey").select("c_custkey")


_PHONE = "CASE c_custkey % 4 WHEN 0 THEN '+64 9 ' || c_custkey WHEN 1 THEN '0030-210-' || (c_custkey * 7919) WHEN 2 THEN '''''30 ' || c_custkey ELSE '(09) ' || c_custkey END"


@query(f"""WITH d AS (SELECT c_custkey, {_PHONE} AS phone FROM customer), g AS (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS x FROM d)
SELECT c_custkey, CASE WHEN starts_with(x, '64') THEN '0' || substr(x, 3) ELSE x END AS nz,
CASE WHEN starts_with(x, '0030') AND length(x) > 10 THEN substr(x, 5) WHEN starts_with(x, '30') AND length(x) > 10 THEN substr(x, 3) ELSE x END AS gr,
'''' || ltrim(phone, '''') AS quoted FROM g""")
def phone_key_rules(spark, sf_dir):
    k = F.col("c_custkey")
    phone = F.when(k % 4 == 0, F.concat(F.lit("+64 9 "), k)).when(k % 4 == 1, F.concat(F.lit("0030-210-"), k * 7919)).when(k % 4 == 2, F.concat(F.lit("''30 "), k)).otherwise(F.concat(F.lit("(09) "), k))
    return t(spark, sf_dir, "customer").select("c_custkey", text.phone_key(phone, "nz").alias("nz"), text.phone_key(phone, "gr").alias("gr"), text.phone_quoted(phone).alias("quoted"))


@query("SELECT p_partkey FROM part WHERE p_type IS NULL OR trim(lower(p_type)) IN ('', 'economy', 'standard anodized', 'promo')")
def category_exact(spark, sf_dir):
    return t(spark, sf_dir, "part").where(joins.allowed(F.col("p_type"), ("economy", "standard anodized", "promo"))).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'a') AND (contains(lower(p_type), 'o') OR contains(lower(p_type), 'econ'))")
def category_contains(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    return p.where(joins.allowed(F.col("p_type"), ("o", "econ"), contains=True, blank=False) & joins.allowed(F.col("p_name"), ("a",), contains=True)).select("p_partkey")


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'e') THEN 'with e' WHEN contains(lower(p_name), 'a') THEN 'with a' ELSE 'other' END AS category FROM part""")
def category_translate_first(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", joins.translate_first(F.col("p_name"), {"e": "with e", "a": "with a"}, "other").alias("category"))


_WORDS = list(PT_HOTELS)[:6]


@query(f"""WITH c AS (SELECT c_custkey, [{_quoted([*_WORDS, 'outro', ''])}][(c_custkey % 8 + 1)::INT] AS raw FROM customer)
SELECT c_custkey, CASE raw {' '.join(f"WHEN '{w}' THEN '{PT_HOTELS[w]}'" for w in _WORDS)} WHEN '' THEN 'none' ELSE raw END AS category FROM c""")
def category_translate_exact(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, [*_WORDS, "outro", ""])), (F.col("c_custkey") % 8 + 1).cast("int"))
    c = t(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return joins.translate(c, "raw", PT_HOTELS, "category", lower=True, default="none").select("c_custkey", "category")


@query("""SELECT n_name, s.c_mktsegment FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s
WHERE NOT EXISTS (SELECT 1 FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey WHERE c.c_nationkey = n_nationkey AND c.c_mktsegment = s.c_mktsegment AND o.o_totalprice > 497000)""")
def anti_progress_grid(spark, sf_dir):
    c, n = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    large = t(spark, sf_dir, "orders").where("o_totalprice > 497000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    done = c.join(large, "c_custkey", "left_semi").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_mktsegment")
    return joins.open_grid(n.select("n_name"), c.select("c_mktsegment").distinct(), done, ["n_name", "c_mktsegment"]).select("n_name", "c_mktsegment")


@query("""SELECT c_custkey, c_name, coalesce(nullif((SELECT arg_max(o_orderstatus, o_orderkey) FROM orders WHERE o_custkey = c_custkey), ''), '') AS email FROM customer""")
def enrich_sync_lastwins(spark, sf_dir):
    base = t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("").alias("email"))
    up = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("email"), "o_orderkey")
    return joins.sync_last(base, up, "c_custkey", "email", "o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'O')")
def still_to_do(spark, sf_dir):
    done = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return joins.still_to_do(t(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey", F.col("o_orderstatus") == "O")


@query("""WITH a AS (SELECT DISTINCT lower(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS k FROM part),
b AS (SELECT DISTINCT left(k, 5 + ascii(k) % 4) AS k FROM a WHERE length(k) % 3 = 0) SELECT k FROM a WHERE k <> '' AND NOT EXISTS (SELECT 1 FROM b WHERE contains(a.k, b.k) OR contains(b.k, a.k))""")
def theta_containment_anti(spark, sf_dir):
    a = t(spark, sf_dir, "part").select(F.lower(F.regexp_replace("p_name", "[^A-Za-z0-9]", "")).alias("k")).distinct()
    b = a.where(F.length("k") % 3 == 0).select(F.expr("left(k, 5 + ascii(k) % 4)").alias("k")).distinct()
    return joins.without_contained(a.where("k <> ''"), b, "k")


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 1 AND 5 OR p_size BETWEEN 20 AND 29 OR p_size BETWEEN 45 AND 47")
def range_semi_join(spark, sf_dir):
    ranges = spark.createDataFrame([(1, 5), (20, 29), (45, 47)], "lo int, hi int")
    return joins.in_ranges(t(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("p_size"), ranges)


_METRO = ", ".join(f"('{s}', {a}, {b})" for s, a, b in places.METRO_RANGES)


@query(f"""WITH c AS (SELECT c_custkey, ['NSW', 'VIC', 'QLD', 'WA', 'SA', 'ACT', 'TAS'][(c_custkey % 7 + 1)::INT] AS state, (2000 + (c_custkey * 37) % 5300)::INT AS postcode FROM customer)
SELECT c.* FROM c WHERE EXISTS (SELECT 1 FROM (VALUES {_METRO}) m(state, lo, hi) WHERE m.state = c.state AND c.postcode BETWEEN m.lo AND m.hi)""")
def metro_postcodes(spark, sf_dir):
    k = F.col("c_custkey")
    state = F.element_at(F.array(*map(F.lit, ("NSW", "VIC", "QLD", "WA", "SA", "ACT", "TAS"))), (k % 7 + 1).cast("int"))
    c = t(spark, sf_dir, "customer").select("c_custkey", state.alias("state"), (2000 + (k * 37) % 5300).cast("int").alias("postcode"))
    ranges = spark.createDataFrame([*places.METRO_RANGES], "state string, lo int, hi int")
    return joins.in_ranges(c, F.col("postcode"), ranges, ["state"])


_LAT, _LNG = "-44 + ((c_custkey * 7919) % 350) / 10.0::DOUBLE", "112 + ((c_custkey * 104729) % 420) / 10.0::DOUBLE"


def _points(spark, sf_dir):
    k = F.col("c_custkey")
    lat, lng = -44 + ((k * 7919) % 350) / F.lit(10.0), 112 + ((k * 104729) % 420) / F.lit(10.0)
    return t(spark, sf_dir, "customer").select(k.alias("id"), lat.alias("lat"), lng.alias("lng"))


_KM = "12742.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h))"
_HAV = "pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)"


@query(f"""WITH p AS (SELECT c_custkey AS id, {_LAT} AS lat, {_LNG} AS lng FROM customer),
q AS (SELECT a.id AS earlier, b.id AS later, {_HAV} AS h FROM p a JOIN p b ON a.id < b.id AND abs(a.lat - b.lat) < 1)
SELECT earlier, later FROM q WHERE {_KM} <= 30""")
def haversine_pairs(spark, sf_dir):
    return clusters.within(_points(spark, sf_dir), 30.0)


@query(f"SELECT c_custkey AS id FROM customer WHERE {_LAT} > -44.0 AND {_LAT} < -10.0 AND {_LNG} > 112.0 AND {_LNG} < 154.0")
def bbox_filter(spark, sf_dir):
    return _points(spark, sf_dir).where(places.in_box(F.col("lat"), F.col("lng"), "au_loose")).select("id")


@query(f"""WITH RECURSIVE p AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) AS n, {_LAT} AS lat, {_LNG} AS lng FROM customer),
f AS (SELECT 0::BIGINT AS n, 0::BIGINT AS id, 0::BIGINT AS centre, []::STRUCT(id BIGINT, lat DOUBLE, lng DOUBLE)[] AS cs
UNION ALL SELECT p.n, p.id, coalesce(hit, p.id), CASE WHEN hit IS NULL THEN list_append(f.cs, {{'id': p.id, 'lat': p.lat, 'lng': p.lng}}) ELSE f.cs END
FROM f JOIN p ON p.n = f.n + 1, LATERAL (SELECT list_filter(f.cs, lambda c: 12742.0::DOUBLE * asin(sqrt(pow(sin(radians(p.lat - c.lat) / 2), 2)
 + cos(radians(c.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lng - c.lng) / 2), 2))) <= 60)[1].id AS hit))
SELECT id, centre FROM f WHERE n > 0""")
def leader_clusters(spark, sf_dir):
    return clusters.leader_clusters(_points(spark, sf_dir), 60.0).select("id", "centre")


_NAT = "CASE c_custkey % 3 WHEN 0 THEN '越南' WHEN 1 THEN '無限制' ELSE '' END"
_AGENCY = "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '不顯示' ELSE '02-1234' END"


@query(f"""WITH c AS (SELECT c_custkey, {_NAT} AS nat, (c_custkey * 13) % 70 AS q, {_AGENCY} AS agency, CASE WHEN c_custkey % 2 = 0 THEN 'hr@a.tw' ELSE '' END AS mail,
CASE WHEN c_mktsegment = 'BUILDING' THEN '製造工' ELSE '營造工' END AS cat FROM customer),
s AS (SELECT c_custkey, (CASE WHEN nat = '越南' THEN 30 WHEN nat = '無限制' THEN 10 ELSE 0 END + CASE WHEN q >= 50 THEN 25 WHEN q >= 20 THEN 15 ELSE 0 END + CASE WHEN mail <> '' THEN 10 ELSE 0 END
 + CASE WHEN agency IN ('', '不顯示') THEN 30 ELSE 0 END + CASE WHEN cat = '製造工' THEN 20 ELSE 0 END)::INT AS score FROM c)
SELECT c_custkey, score, CASE WHEN score >= 80 THEN 'HOT LEAD 🔥' WHEN score >= 50 THEN 'WARM LEAD ⚡' ELSE 'COLD LEAD ❄️' END AS tier, row_number() OVER (ORDER BY score DESC, c_custkey)::INT AS position FROM s""")
def lead_score_tier(spark, sf_dir):
    k = F.col("c_custkey")
    s = leads.lead_score(
        F.when(k % 3 == 0, "越南").when(k % 3 == 1, "無限制").otherwise(""), F.concat(((k * 13) % 70).cast("string"), F.lit("人")),
        F.when(k % 2 == 0, "hr@a.tw").otherwise(""), F.when(k % 4 == 0, "").when(k % 4 == 1, "不顯示").otherwise("02-1234"),
        F.when(F.col("c_mktsegment") == "BUILDING", "製造工").otherwise("營造工"),
    )
    df = t(spark, sf_dir, "customer").select("c_custkey", s["score"].alias("score")).withColumn("tier", leads.tier(F.col("score")))
    return dedup.numbered(df, [F.desc("score"), F.col("c_custkey")], "position")


@query("""SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS found FROM events""")
def json_key_search(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.array_join(documents.values_by_key(F.col("props"), ("k",)), ",").alias("found"))


@query("""SELECT row_number() OVER (ORDER BY c_custkey)::INT AS "No.", c_name AS "Công ty", '' AS "Chức danh", '''' || c_custkey AS "SĐT", 0 AS "Lần Follow-up", c_mktsegment AS "Category" FROM customer""")
def template_project(spark, sf_dir):
    c = dedup.numbered(t(spark, sf_dir, "customer"), [F.col("c_custkey")])
    return c.select(
        "`No.`", F.col("c_name").alias("Công ty"), F.lit("").alias("Chức danh"), text.phone_prefixed(F.col("c_custkey").cast("string")).alias("SĐT"),
        F.lit(0).alias("Lần Follow-up"), F.col("c_mktsegment").alias("Category"),
    )


@query("SELECT DISTINCT user_id FROM events")
def incremental_resume(spark, sf_dir):
    """Streaming: one run over all event files, then another that must add nothing."""
    at = f"{dedup.shared_root(spark)}/resume/{uuid.uuid4().hex}"
    schema = "user_id long"
    for _ in range(2):
        resume.run_new(spark, f"{sf_dir}/events.parquet*", schema, "user_id", f"{at}/out", f"{at}/state")
    return spark.read.schema(schema).parquet(f"{at}/out")


@query("""SELECT DISTINCT user_id, (user_id % 4 + 1)::INT AS attempt FROM events WHERE user_id % 4 < 3""")
def retry_until_done(spark, sf_dir):
    """2.8: five runs over all event files; a user's work succeeds at attempt user_id % 4 + 1, and three attempts are the most."""
    at, runs = f"{dedup.shared_root(spark)}/retry/{uuid.uuid4().hex}", []

    def work(due):
        return due.select("user_id", (F.col("user_id") % 4 < len(runs)).alias("ok"))

    for _ in range(5):
        runs.append(1)
        resume.run_until_done(spark, f"{sf_dir}/events.parquet*", "user_id long", "user_id", work, at, most=3)
    return resume.results(spark, at).select("user_id", F.col("attempt").cast("int").alias("attempt"))


_SITE_KIND = "CASE k % 8 WHEN 0 THEN 'site' WHEN 1 THEN 'subpages' WHEN 2 THEN 'facebook' WHEN 3 THEN 'instagram' WHEN 4 THEN 'none' WHEN 5 THEN 'facebook' WHEN 6 THEN 'none' ELSE 'site' END"


@query(f"""SELECT k AS site, {_SITE_KIND} AS source, CASE k % 8 WHEN 0 THEN 'a@h' || k || '.nz, b@h' || k || '.nz' WHEN 1 THEN 'a@c' || k || '.nz, d@c' || k || '.nz' WHEN 2 THEN 'f@g' || k || '.nz'
WHEN 3 THEN 'i@g' || k || '.nz' WHEN 5 THEN 'own@g' || k || '.nz' WHEN 7 THEN 'x@h' || k || '.nz' ELSE '' END AS email FROM (SELECT c_custkey AS k FROM customer)""")
def site_contacts(spark, sf_dir):
    """Sites whose address is on the home page, two subpages, the second social page, or nowhere; every table page is fetched too."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    kind, n = F.col("k") % 8, F.col("k").cast("string")
    text = lambda *parts: F.concat(*[n if x is None else F.lit(x) for x in parts])
    site = F.when(kind == 5, text("m.facebook.com/own", None)).when(kind == 6, "").when(kind == 7, text(" http://s", None, ".nz ")).otherwise(text("s", None, ".nz"))
    sites = c.select(F.col("k").alias("site"), site.alias("website"))
    links = text("<a href='/contact'>c</a><a href=blog>b</a><a href='about?x=1#y'>a</a><a href='http://other.nz/contact'>o</a>")
    fb = text("<a href='https://www.facebook.com/sharer.php?u=1'>s</a><a href='facebook.com/none", None, "'>n</a><a href='https://m.facebook.com/p", None, "'>p</a>")
    home = (
        F.when(kind == 0, text("<p>a@h", None, ".nz</p><a href='mailto:B@h", None, ".nz?s=1'>m</a>")).when(kind == 2, F.concat(links, fb)).when(kind == 3, F.concat(links, fb, text("<a href=instagram.com/u", None, ">i</a>")))
        .when(kind == 7, text("x@h", None, ".nz<script>no@h", None, ".nz</script>")).otherwise(links)
    )
    page = lambda url, html, where=None: (c.where(where) if where is not None else c).select(url.alias("url"), html.alias("html"))
    pages = page(F.concat(F.when(kind == 7, "http://s").otherwise("https://s"), n, F.lit(".nz")), home, kind != 6)
    pages = pages.union(page(text("https://s", None, ".nz/contact"), text("a@c", None, ".nz"), kind == 1)).union(page(text("https://s", None, ".nz/about?x=1"), text("<i>d@c", None, ".nz</i>"), kind == 1))
    pages = pages.union(page(text("https://www.facebook.com/p", None), text("f@g", None, ".nz"), kind == 2)).union(page(text("https://www.facebook.com/own", None), text("own@g", None, ".nz"), kind == 5))
    pages = pages.union(page(text("https://instagram.com/u", None), text("i@g", None, ".nz <a href='mailto:hidden@g.nz'>m</a>"), kind == 3))
    return crawl.site_contacts(sites, pages.union(t(spark, sf_dir, "pages").select("url", "html")))


@query("""SELECT c_custkey, c_name AS name, c_acctbal::VARCHAR AS balance FROM customer WHERE c_custkey % 5 > 0""")
def workbook_round_trip(spark, sf_dir):
    """S3, K5, K6: workbooks of a table, a sheet each, read back from a row on and without cells that were missing."""
    spark.dataSource.register(xlsx.XlsxSource)
    path = f"{dedup.shared_root(spark)}/books/{uuid.uuid4().hex}"
    c = t(spark, sf_dir, "customer").where("c_custkey % 5 > 0")
    c.select(F.col("c_custkey").cast("string"), "c_name", F.lit(None).cast("string").alias("none"), F.col("c_acctbal").cast("string")).repartition(3).write.format("xlsx").option("sheet", "Raw").mode("overwrite").save(path)
    back = xlsx.read_books(spark, f"{path}/*.xlsx", "Raw", 2, (1, 2, 4))
    return back.select(F.col("col1").cast("long").alias("c_custkey"), F.col("col2").alias("name"), F.col("col3").alias("balance"))


@query("""SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_orderkey % 7 > 0""")
def tab_separated(spark, sf_dir):
    """Lines of tabs, those with too few fields left out."""
    path = f"{dedup.shared_root(spark)}/tsv/{uuid.uuid4().hex}"
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderstatus")), F.col("o_orderpriority"))
    t(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    back = tables.read_tsv(spark, path, 3, {0: "o_orderkey", 1: "status", 2: "priority"})
    return back.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query("""WITH d AS (SELECT doc_id::VARCHAR AS doc_id, coalesce(lang, '') AS lang, replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents)
SELECT doc_id, lang, length(text) AS length, md5(text) AS digest FROM d""")
def csv_round_trip(spark, sf_dir):
    """Whole texts with quotes and line breaks written as files with a mark and a header each, and read by splits."""
    path = f"{dedup.shared_root(spark)}/csv/{uuid.uuid4().hex}"
    tables.write_csv(t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text"), path)
    back = tables.read_csv(spark, path)
    return back.select("doc_id", "lang", F.length("text").cast("long").alias("length"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query("""SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE value > 50) AS large FROM events GROUP BY event_type""")
def run_counters(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("rows"), F.count_if(F.col("value") > 50).alias("large"))


_URL = "'https://M.example/Maps/p?x=' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '!1s0xAB' || p_size || ':0xCD!3d-33.' || p_partkey || '!4d151.2' ELSE '@-36.5,174.' || p_size || ',12z' END"


@query(f"""WITH u AS (SELECT p_partkey, {_URL} AS url FROM part), x AS (SELECT *, regexp_extract(url, '1s(0x[0-9a-fA-F]+:0x[0-9a-fA-F]+)', 1) AS h FROM u)
SELECT p_partkey, lower(CASE WHEN h <> '' THEN h ELSE split_part(url, '?', 1) END) AS place,
(CASE WHEN contains(url, '!3d') THEN regexp_extract(url, '!3d(-?\\d+\\.\\d+)!4d(-?\\d+\\.\\d+)', 1) ELSE regexp_extract(url, '@(-?\\d+\\.\\d+),(-?\\d+\\.\\d+)', 1) END)::DOUBLE AS lat,
(CASE WHEN contains(url, '!3d') THEN regexp_extract(url, '!3d(-?\\d+\\.\\d+)!4d(-?\\d+\\.\\d+)', 2) ELSE regexp_extract(url, '@(-?\\d+\\.\\d+),(-?\\d+\\.\\d+)', 2) END)::DOUBLE AS lng FROM x""")
def map_links(spark, sf_dir):
    k = F.col("p_partkey")
    tail = F.when(k % 2 == 0, F.concat(F.lit("!1s0xAB"), F.col("p_size"), F.lit(":0xCD!3d-33."), k, F.lit("!4d151.2"))).otherwise(F.concat(F.lit("@-36.5,174."), F.col("p_size"), F.lit(",12z")))
    p = t(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("https://M.example/Maps/p?x="), k, tail).alias("url"))
    at = places.link_coordinates(F.col("url"))
    return p.select("p_partkey", places.place_key(F.col("url")).alias("place"), at["lat"].alias("lat"), at["lng"].alias("lng"))


_ADDR = "c_custkey || ' King St, Newtown ' || ['NSW', 'VIC', 'Rd'][(c_custkey % 3 + 1)::INT] || ' ' || (2000 + c_custkey % 900) || CASE WHEN c_custkey % 2 = 0 THEN ', Australia' ELSE '' END"


@query(f"""WITH a AS (SELECT c_custkey, {_ADDR} AS address FROM customer), b AS (SELECT *, regexp_replace(address, ', Australia$', '') AS x FROM a)
SELECT c_custkey, contains(lower(address), 'australia') OR c_custkey % 3 < 2 AS au, CASE WHEN c_custkey % 3 < 2 THEN 'Newtown' END AS suburb,
CASE WHEN c_custkey % 3 < 2 THEN regexp_extract(x, '(NSW|VIC) ', 1) END AS state, CASE WHEN c_custkey % 3 < 2 THEN right(x, 4) END AS postcode FROM b""")
def address_parse(spark, sf_dir):
    k = F.col("c_custkey")
    state = F.element_at(F.array(*map(F.lit, ("NSW", "VIC", "Rd"))), (k % 3 + 1).cast("int"))
    tail = F.when(k % 2 == 0, ", Australia").otherwise("")
    address = F.concat(k.cast("string"), F.lit(" King St, Newtown "), state, F.lit(" "), (2000 + k % 900).cast("string"), tail)
    c = t(spark, sf_dir, "customer").select("c_custkey", address.alias("a"))
    return c.select("c_custkey", places.in_country(F.col("a"), "au").alias("au"), places.parse_address(F.col("a"), "au").alias("p")).select("c_custkey", "au", "p.*")


_GREEK_KEYS, _GREEK_VALUES = list(text.GREEK), list(text.GREEK.values())
_GREEK_WORDS = ("Αθήνα", "ουι", "Ψari", "θέα", "Εύα", "αυγή", "Μπάντα", "ευΑΙ", "τζατζίκι", "Ηύ-ΓΚ", "ϊΰ ΐς")
_LATIN_WORDS = ("Athina", "oui", "PSari", "thea", "Eva", "avgi", "Mpanta", "evAI", "tzatziki", "Iv-GK", "iy is")


@query(f"""SELECT c_custkey, [{_quoted(_GREEK_VALUES)}][(c_custkey % {len(_GREEK_VALUES)} + 1)::INT] || '-' || [{_quoted(_LATIN_WORDS)}][(c_custkey % {len(_LATIN_WORDS)} + 1)::INT] || '.'
|| [{_quoted(_GREEK_VALUES)}][(c_custkey * 7 % {len(_GREEK_VALUES)} + 1)::INT] || 'x' AS latin FROM customer""")
def greek_to_latin(spark, sf_dir):
    """Every entry of the table, and words whose letter pairs come first."""
    pick = lambda words, m: F.element_at(F.array(*map(F.lit, words)), (F.col("c_custkey") * m % len(words) + 1).cast("int"))
    cell = F.concat(pick(_GREEK_KEYS, 1), F.lit("-"), pick(_GREEK_WORDS, 1), F.lit("."), pick(_GREEK_KEYS, 7), F.lit("x"))
    return t(spark, sf_dir, "customer").select("c_custkey", text.to_latin(cell).alias("latin"))


@query("""SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')""")
def missing_details(spark, sf_dir):
    found = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("status"))
    return joins.dependents(t(spark, sf_dir, "customer").select("c_custkey"), found, "c_custkey", "status", missing=True)


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1""")
def first_insert(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    return joins.first_per_key(o, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT p_partkey FROM part WHERE contains(lower(p_name), lower(p_brand)) OR contains(lower(p_brand), lower(p_name)) OR contains(lower(p_type), lower(p_name)) OR contains(lower(p_name), lower(p_type))""")
def name_match(spark, sf_dir):
    n = F.col("p_name")
    return t(spark, sf_dir, "part").where(filters.same_name(n, F.col("p_brand")) | filters.same_name(n, F.col("p_type"))).select("p_partkey")


_HREFS = "['https://www.facebook.com/p' || k, 'https://facebook.com/sharer.php?u=' || k, 'https://instagram.com/u' || k, 'https://www.instagram.com/about/' || k, 'https://x.example/' || k]"


@query(f"""WITH l AS (SELECT c_custkey AS k FROM customer), h AS (SELECT k, {_HREFS}[(k % 5 + 1)::INT] AS href FROM l)
SELECT k AS c_custkey, k % 5 = 0 AS facebook, k % 5 = 2 AS instagram, CASE WHEN k % 5 < 2 THEN 'facebook' WHEN k % 5 < 4 THEN 'instagram' ELSE 'regular' END AS kind FROM h""")
def social_links(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    heads = ("https://www.facebook.com/p", "https://facebook.com/sharer.php?u=", "https://instagram.com/u", "https://www.instagram.com/about/", "https://x.example/")
    href = F.concat(F.element_at(F.array(*map(F.lit, heads)), (F.col("c_custkey") % 5 + 1).cast("int")), k)
    c = t(spark, sf_dir, "customer").select("c_custkey", href.alias("h"))
    return c.select("c_custkey", web.is_facebook(F.col("h")).alias("facebook"), web.is_instagram(F.col("h")).alias("instagram"), web.website_kind(F.col("h")).alias("kind"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 4.5::DOUBLE ELSE 0::DOUBLE END AS rating, (CASE WHEN c_custkey % 2 = 0 THEN 1000 + c_custkey ELSE 0 END)::INT AS reviews,
CASE WHEN c_custkey % 2 = 0 THEN 'O''Neil-Smith' ELSE 'North Bay' END AS titled FROM customer""")
def numbers_and_titles(spark, sf_dir):
    k = F.col("c_custkey")
    rating = F.when(k % 3 == 0, "4.5").when(k % 3 == 1, "5,0").otherwise("new")
    n = (1000 + k).cast("string")
    reviews = F.when(k % 2 == 0, F.concat(F.lit("("), F.expr("left(cast(1000 + c_custkey as string), 1)"), F.lit(","), F.substring(n, 2, 9), F.lit(" reviews)"))).otherwise("none")
    name = F.when(k % 2 == 0, "o'NEIL-smith").otherwise("NORTH bay")
    return t(spark, sf_dir, "customer").select("c_custkey", text.number(rating).alias("rating"), text.first_integer(reviews).alias("reviews"), text.title_case(name).alias("titled"))


@query("""WITH r AS (SELECT p_partkey, 'u' || p_partkey % 300 AS url, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_type END AS category FROM part),
f AS (SELECT 'u' || s_suppkey AS url, min(CASE WHEN s_suppkey % 4 > 0 THEN s_name END) AS v FROM supplier GROUP BY 1)
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND v IS NOT NULL THEN v ELSE category END AS category FROM r LEFT JOIN f USING (url)""")
def category_repair(spark, sf_dir):
    k = F.col("p_partkey")
    rows = t(spark, sf_dir, "part").select(k, F.concat(F.lit("u"), (k % 300).cast("string")).alias("url"), F.when(k % 3 == 0, " ").otherwise(F.col("p_type")).alias("category"))
    found = F.when(F.col("s_suppkey") % 4 > 0, F.concat(F.lit("· "), F.col("s_name"), F.lit(" "))).otherwise(" · ")
    s = t(spark, sf_dir, "supplier").select(F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("url"), found.alias("category"))
    return joins.repair_blanks(rows, s, "url", "category").select("p_partkey", "category")


@query(f"""WITH l AS (SELECT 'ST' AS state, n_name AS name, n_nationkey * 1.5::DOUBLE - 10 AS lat, n_nationkey + 0.25::DOUBLE AS lng, 11 AS zoom, n_regionkey FROM nation),
g AS (SELECT *, unnest([{_quoted(LISTINGS['au_builders'].keywords)}]) AS keyword FROM l)
SELECT name, keyword, keyword || ' in ' || name || ', Australia' AS query, '{SEARCH_URL}' || replace(keyword, ' ', '+') || '/@' || lat || ',' || lng || ',11z?hl=en' AS url
FROM g WHERE NOT (n_regionkey = 1 AND keyword IN ('Contractor', 'Home builder'))""")
def search_grid(spark, sf_dir):
    k, n = F.col("n_nationkey"), t(spark, sf_dir, "nation")
    places_ = n.select(F.lit("ST").alias("state"), F.col("n_name").alias("name"), (k * 1.5 - 10).alias("lat"), (k + 0.25).alias("lng"), F.lit(11).alias("zoom"))
    done = n.where("n_regionkey = 1").select(F.lower("n_name").alias("location"), F.lit("st").alias("state"), F.explode(F.array(F.lit("contractor"), F.lit("home builder"))).alias("keyword"))
    out = jobs.searches(places_, "au_builders", done)
    return out.select("name", "keyword", F.col("Search_Query").alias("query"), F.col("search_url").alias("url"))


_FORMS = {
    "nz": ("k || ' Queen St, Ponsonby, Auckland ' || p || ', New Zealand'", "'Auckland'", "'NZ'", "p"),
    "lv": ("k || ' iela, Rīga, LV-' || p || ', Latvia'", "'Rīga'", "'LV'", "'LV-' || p"),
    "gr": ("'Odos A, Patra 262 ' || right(p, 2) || ', Greece'", "'Patra'", "'GR'", "'262 ' || right(p, 2)"),
    "pt": ("'Rua ' || k || ', Porto ' || p || '-' || right(p, 3) || ', Portugal'", "'Porto'", "'PT'", "p || '-' || right(p, 3)"),
    "sk": ("'Ulica ' || k || ', 811 ' || right(p, 2) || ' Bratislava, Slovakia'", "'Bratislava'", "'Bratislava'", "'811 ' || right(p, 2)"),
    "tw": ("left(p, 3) || ' 台灣台北市中正區路' || k || '號'", "'台北市中正區'", "'台北市'", "left(p, 3)"),
    "au_loose": ("k || ' King St, Perth, WA ' || p || ', Australia'", "'Perth'", "'WA'", "p"),
}
_CASE = lambda at: "CASE c_custkey % 7 " + " ".join(f"WHEN {i} THEN {f[at]}" for i, f in enumerate(_FORMS.values())) + " END"
_KP = "SELECT c_custkey, c_custkey::VARCHAR AS k, (1000 + c_custkey % 9000)::VARCHAR AS p FROM customer"


@query(f"""SELECT c_custkey, true AS inside, {_CASE(1)} AS suburb, {_CASE(2)} AS state, {_CASE(3)} AS postcode FROM ({_KP})""")
def address_forms(spark, sf_dir):
    """One address form of each of seven countries, by key."""
    c = t(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("k"), (1000 + F.col("c_custkey") % 9000).cast("string").alias("p"))
    c = c.withColumn("a", F.expr(_CASE(0)))
    own = lambda f: F.coalesce(*[F.when(F.col("c_custkey") % 7 == i, f(n)) for i, n in enumerate(_FORMS)])
    inside, parsed = own(lambda n: places.in_country(F.col("a"), n)), own(lambda n: places.parse_address(F.col("a"), n))
    return c.select("c_custkey", inside.alias("inside"), parsed.alias("x")).select("c_custkey", "inside", "x.*")


@query("""SELECT c_custkey, ['0', '', '', '', '0', '0'][c_custkey % 6 + 1] || c_custkey AS key FROM customer""")
def phone_rules_by_country(spark, sf_dir):
    rules, codes = ("au", "au_bare", "lv", "pt", "sk", "tw"), ("61", "61", "371", "351", "421", "886")
    k = F.col("c_custkey")
    raw = F.concat(F.lit("+"), F.element_at(F.array(*map(F.lit, codes)), (k % 6 + 1).cast("int")), F.lit(" "), k.cast("string"))
    c = t(spark, sf_dir, "customer").select(k, raw.alias("raw"))
    return c.select("c_custkey", F.coalesce(*[F.when(k % 6 == i, text.phone_key(F.col("raw"), r)) for i, r in enumerate(rules)]).alias("key"))


_GREEK_LOCALS, _GREEK_HOSTS = ("info", "joe", "gemi", "support", "hr.jobs", "mail", "noreply"), ("chamber.gr", "otenet.gr", "acme.gr", "gmail.com", "gemi.gr")
_GREEK_PICKS = ((3, 5), (1, 1), (5, 2))


def _greek_cell(sql: bool):
    if sql:
        return "[" + ", ".join(f"[{_quoted(_GREEK_LOCALS)}][(c_custkey * {a} % 7 + 1)::INT] || '@' || [{_quoted(_GREEK_HOSTS)}][(c_custkey * {b} % 5 + 1)::INT]" for a, b in _GREEK_PICKS) + "]"
    pick = lambda words, m: F.element_at(F.array(*map(F.lit, words)), (F.col("c_custkey") * m % len(words) + 1).cast("int"))
    return F.concat_ws(" ", *[F.concat(pick(_GREEK_LOCALS, a), F.lit("@"), pick(_GREEK_HOSTS, b)) for a, b in _GREEK_PICKS])


def _best_sql(name: str) -> str:
    """The best candidate under a variant's rules; '' where all are thrown out."""
    r = FORMATTING[name].rules
    has = lambda words, *cells: f"len(list_filter([{_quoted(words)}], lambda w: {' OR '.join(f'contains({c}, w)' for c in cells)})) > 0"
    whole = "e" if r.discard == "address" else "dom"
    points = f"""CASE WHEN dom IN ({_GENERIC}) THEN 0 ELSE 10 END + CASE WHEN {has(r.prefixes, 'loc')} THEN 5 ELSE 0 END - CASE WHEN {has(r.bad, 'loc', 'dom')} THEN 20 ELSE 0 END
      - CASE WHEN {has(emails.OLD_PROVIDERS, whole)} THEN {r.penalty} ELSE 0 END"""
    kept = f"WHERE NOT ({has(emails.REGISTRY_WORDS, whole)})" if r.discard else ""
    return f"SELECT c_custkey, '{name}' AS rules, e, row_number() OVER (PARTITION BY c_custkey ORDER BY ({points})::DOUBLE - length(e) * 0.01::DOUBLE DESC, i) AS k FROM s {kept}"


_RULES = ("gr_farms", "gr_brokers", "lv_metal")


@query(f"""WITH c AS (SELECT c_custkey, {_greek_cell(True)} AS es FROM customer), u AS (SELECT c_custkey, generate_subscripts(es, 1) AS i, unnest(es) AS e FROM c),
s AS (SELECT *, split_part(e, '@', 1) AS loc, split_part(e, '@', 2) AS dom FROM u),
b AS ({' UNION ALL '.join(_best_sql(r) for r in _RULES)})
SELECT c_custkey, rule AS rules, coalesce(e, '') AS best_email FROM (SELECT c_custkey, unnest([{_quoted(_RULES)}]) AS rule FROM customer) x
LEFT JOIN (SELECT c_custkey AS ck, rules AS rr, e FROM b WHERE k = 1) y ON ck = c_custkey AND rr = rule""")
def email_rule_variants(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", _greek_cell(False).alias("cell"))
    each = F.array(*[F.struct(F.lit(r).alias("rules"), emails.best(F.col("cell"), FORMATTING[r].rules).alias("best_email")) for r in _RULES])
    return c.select("c_custkey", F.explode(each).alias("x")).select("c_custkey", "x.*")


@query("""SELECT event_id, array_to_string(list_sort(list_distinct([event_id::VARCHAR, 's' || event_id % 7, 't', 'u' || event_id % 3])), ',') AS found FROM events""")
def json_nested_search(spark, sf_dir):
    """Nesting, lists, a matching key in capitals, and an object right under a matching key, which isn't entered."""
    e = F.col("event_id").cast("string")
    parts = [
        F.lit('{"a": [{"k": '), e, F.lit(', "x": {"k": " s'), (F.col("event_id") % 7).cast("string"), F.lit(' "}}, 2], "kk": {"k": 5, "y": [1]}, "K": ["t", "", {"k": "u'),
        (F.col("event_id") % 3).cast("string"), F.lit('"}]}'),
    ]
    return t(spark, sf_dir, "events").select("event_id", F.array_join(documents.values_by_key(F.concat(*parts), ("k",)), ",").alias("found"))


@query("""SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""")
def details_of_rows(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.lit("F")).alias("status"))
    return joins.dependents(t(spark, sf_dir, "customer").select("c_custkey"), o, "c_custkey", "status").select("c_custkey", "o_orderkey")


_CELLS = (*SK_AGENCIES, "sprostredkovanie práce", "")


@query(f"""WITH c AS (SELECT p_partkey, [{_quoted(_CELLS)}][p_partkey % {len(_CELLS)} + 1] AS cell FROM part)
SELECT p_partkey, cell IN ({_quoted(SK_AGENCIES)}) OR cell = '' AS cleaned, cell IN ({_quoted(SK_AGENCIES)}) AS listed,
CASE cell {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SK_AGENCIES.items())} ELSE cell END AS shown FROM c""")
def category_case_sensitive(spark, sf_dir):
    cell = F.element_at(F.array(*map(F.lit, _CELLS)), (F.col("p_partkey") % len(_CELLS) + 1).cast("int"))
    df = joins.translate(t(spark, sf_dir, "part").select("p_partkey", cell.alias("cell")), "cell", SK_AGENCIES, "shown")
    flag = lambda blank: joins.allowed(F.col("cell"), tuple(SK_AGENCIES), lower=False, blank=blank)
    return df.select("p_partkey", flag(True).alias("cleaned"), flag(False).alias("listed"), "shown")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'b' || c_custkey || '@x.tw' ELSE '' END AS email, 'en' || c_custkey % 5 AS other_language,
'work ' || c_custkey AS job, 'pay' AS conditions FROM customer""")
def employer_page_fields(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    mail = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<span>業務聯繫信箱：a@x.tw</span><span> 業務聯繫信箱： b"), k, F.lit("@x.tw</span>"))).otherwise("")
    html = F.concat(
        F.lit('<div class="text-top-info">'), mail, F.lit("<span>希望外國人其它語言：<b>en"), (F.col("c_custkey") % 5).cast("string"), F.lit("</b></span></div>"),
        F.lit('<div class="x text-con">工作內容：work '), k, F.lit('</div><div class="text-con">勞動條件：pay</div>'),
    )
    return fetched.employer_details(t(spark, sf_dir, "customer").select("c_custkey", html.alias("html")), "c_custkey")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best e-mail of every document, its score and tier by score: documents without an address stay."""
    e = F.array_join(emails.extract(F.col("text")), ", ")
    best = emails.best(F.col("emails"))
    df = t(spark, sf_dir, "documents").select("doc_id", "lang", e.alias("emails")).withColumn("best_email", best)
    s = F.when(F.col("best_email") != "", emails.score(F.col("best_email")))
    return df.withColumn("score", s).withColumn("tier", F.when(F.col("score") > 0, "business").when(F.col("score").isNotNull(), "doubtful").otherwise("none"))


assert math.isclose(2 * places.EARTH_KM, 12742.0)
