"""Queries that run cell rules, sources and whole jobs over rows made from `customer` and `part`, with their SQL.

Cells are made by one expression for both sides; k is c_custkey. Files are written from the tables and read back by the sources.
"""

from __future__ import annotations

import uuid

from harrow.functions import places, text, web
from harrow.operators import dedup, filters, joins
from harrow.sources import pages, tables
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jobs
from .variants import AU_CARS, GR_HOTELS, LISTINGS, SEARCH_URL, SK_AGENCIES, TW_BUILDERS

QUERIES: dict = {}
SQL: dict[str, str] = {}
_K = "(SELECT c_custkey AS k, cast(c_custkey AS string) AS n FROM customer)"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _made(spark: SparkSession, sf_dir: str, **cells: str) -> DataFrame:
    c = tables.spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k")), "k").withColumn("n", F.col("k").cast("string"))
    return c.select("k", "n", *[F.expr(e).alias(name) for name, e in cells.items()])


def _folder(spark: SparkSession, name: str) -> str:
    return f"{dedup.shared_root(spark)}/{name}/{uuid.uuid4().hex}"


_HIDDEN = "CASE k % 6 WHEN 0 THEN ' ' WHEN 1 THEN ' 不顯示 ' WHEN 2 THEN '8E+10' WHEN 3 THEN '1e+2' WHEN 4 THEN '02-' || n ELSE 'E5' END"


@query(f"SELECT k, trim(c) IN ('', '不顯示') OR contains(c, 'E+') OR contains(c, 'e+') AS hidden FROM (SELECT k, {_HIDDEN} AS c FROM {_K})")
def hidden_phones(spark, sf_dir):
    """P8"""
    return _made(spark, sf_dir, c=_HIDDEN).select("k", text.phone_hidden(F.col("c")).alias("hidden"))


_NAMES = "CASE k % 3 WHEN 0 THEN ' Ομάδα  ' || n || ' (ΑΒΓ)-Co.,x ' WHEN 1 THEN 'SIA \"Rīga ' || n || '\" Būve AS' ELSE '公 司（' || n || '）有限-公司' END"
_SHORT = "lower(c)"
for _form in text.LEGAL_FORMS:
    _SHORT = f"replace({_SHORT}, '{_form}', '')"


@query(f"""SELECT k, trim(regexp_replace(regexp_replace(lower(trim(c)), '[^a-z0-9\\sα-ωά-ώ]', '', 'g'), '\\s+', ' ', 'g')) AS greek,
lower(regexp_replace(trim(c), '[\\s\\-,.()（）]', '', 'g')) AS compact, regexp_replace({_SHORT}, '[^a-z0-9āčēģīķļņšūž]', '', 'g') AS company FROM (SELECT k, {_NAMES} AS c FROM {_K})""")
def name_keys(spark, sf_dir):
    """P10, P11, P12"""
    c = F.col("c")
    return _made(spark, sf_dir, c=_NAMES).select("k", text.name_key(c, "greek").alias("greek"), text.name_key(c, "compact").alias("compact"), text.company_key(c).alias("company"))


_SHOWN = "CASE k % 3 WHEN 0 THEN ' “SIA”  „x” ' || n WHEN 1 THEN 'phone:tel:+371 ' || n ELSE 'Address: a' || chr(10) || 'Nr. ' || n || '''s \"q\"' END"
_PLACE = "CASE k % 4 WHEN 0 THEN 'Iela ' || n || ', Ogres nov., LV-1' WHEN 1 THEN 'X pag., Y nov., LV-2' WHEN 2 THEN 'Iela 1, Rīga , LV' ELSE 'Iela ' || n END"


@query(f"""SELECT k, trim(regexp_replace(translate(c, '"“”„''', ''), '\\s+', ' ', 'g')) || ', Latvia' AS query, translate(c, '“”„', repeat('"', 3)) AS shown, replace(c, chr(10), '  ') AS flat,
trim(replace(replace(c, 'phone:tel:', ''), 'Address:', '')) AS bare, CASE k % 4 WHEN 0 THEN 'Ogres nov.' WHEN 1 THEN 'Y nov.' WHEN 2 THEN 'Rīga' ELSE 'LV' END AS district FROM (SELECT k, {_SHOWN} AS c FROM {_K})""")
def display_cells(spark, sf_dir):
    """P13, P14, P27, P34, P35"""
    c = F.col("c")
    return _made(spark, sf_dir, c=_SHOWN, a=_PLACE).select(
        "k", text.search_query(c).alias("query"), text.display_name(c).alias("shown"), text.one_line(c).alias("flat"), text.without_labels(c, "phone:tel:", "Address:").alias("bare"),
        places.district_from_address(F.col("a")).alias("district"),
    )


@query(f"""WITH x AS (SELECT k, list_transform(range(1, k % 9 + 2), lambda i: repeat('ab', ((k * i) % 5 + 1)::INT) || ((k + i) % 3)) AS xs FROM {_K})
SELECT k, (SELECT u FROM (SELECT unnest(xs) AS u) ORDER BY length(u) DESC, u LIMIT 1) AS longest,
array_to_string(xs[1:5], ', ') || CASE WHEN len(xs) > 5 THEN ' and ' || (len(xs) - 5) || ' more' ELSE '' END AS summary FROM x""")
def longest_and_summary(spark, sf_dir):
    """P37, P38"""
    xs = "transform(sequence(1L, k % 9 + 1), i -> concat(repeat('ab', cast((k * i) % 5 + 1 AS int)), cast((k + i) % 3 AS string)))"
    return _made(spark, sf_dir, xs=xs).select("k", text.longest(F.col("xs")).alias("longest"), text.summary(F.col("xs")).alias("summary"))


_CLASS = "CASE k % 5 WHEN 0 THEN 'Post Office Boxes' WHEN 1 THEN 'LVR' WHEN 2 THEN NULL WHEN 3 THEN 'Delivery Area' ELSE 'Large Volume x' END"
_CODE = "CASE k % 4 WHEN 0 THEN 'ADM2' WHEN 1 THEN 'adm3' WHEN 2 THEN 'ADM3' ELSE '' END"


@query("SELECT c_custkey AS k, c_custkey % 5 IN (2, 3) AS place, c_custkey % 4 IN (0, 2) AS area, c_custkey % 2 = 0 AND c_custkey % 3 > 0 AS repair FROM customer")
def row_filters(spark, sf_dir):
    """F12, F14, F19"""
    rows = _made(spark, sf_dir, c=_CLASS, f=_CODE, blank="CASE k % 2 WHEN 0 THEN ' ' ELSE 'x' END", url="CASE k % 3 WHEN 0 THEN '' ELSE 'u' END")
    return rows.select("k", filters.is_place(F.col("c")).alias("place"), filters.is_admin_area(F.col("f")).alias("area"), filters.needs_category(F.col("blank"), F.col("url")).alias("repair"))


#: Per listing variant: the country of its addresses, an address, its suburb, state and postcode, a listed category, how it is compared and whether a blank one passes.
_LISTED = {
    "au_cars": ("au_loose", "1 King St, Perth, WA 6000, Australia", "Perth", "WA", "6000", next(iter(AU_CARS)), "contains", False),
    "gr_hotels": ("gr", "Odos 1, Patra 262 21, Greece", "Patra", "GR", "262 21", next(iter(GR_HOTELS)), "contains", True),
    "sk_agencies": ("sk", "Ulica 1, 811 01 Bratislava, Slovakia", "Bratislava", "Bratislava", "811 01", next(iter(SK_AGENCIES)), "exact", False),
    "tw_builders": ("tw", "100 台灣台北市中正區路1號", "台北市中正區", "台北市", "100", next(iter(TW_BUILDERS)), "exact", False),
}
_CASES = {"name": "CASE k % 7 WHEN 0 THEN ' ' ELSE 'N' || n END"}


def _listed_sql(v: str) -> str:
    country, _, suburb, state, postcode, _, how, blank = _LISTED[v]
    ok = ["k % 4 = 0", *(["k % 4 = 1"] if blank else []), *(["k % 4 = 3"] if how == "contains" else [])]
    return f"SELECT '{v}' AS variant, k, '{suburb}' AS suburb, '{state}' AS state, '{postcode}' AS postcode FROM {_K} WHERE k % 7 > 0 AND k % 5 > 0 AND ({' OR '.join(ok)})"


@query(" UNION ALL ".join(map(_listed_sql, _LISTED)))
def listing_checks(spark, sf_dir):
    """S19, F7, F8, P25, 2.12: named listings inside the country whose category passes, of four variants."""
    out = None
    for v, (country, address, *_, category, _how, _blank) in _LISTED.items():
        q = category.replace("'", "''")
        rows = _made(
            spark, sf_dir, Name=_CASES["name"], Address=f"CASE k % 5 WHEN 0 THEN 'Paris' ELSE '{address}' END", URL="'u'", State="''",
            Category=f"CASE k % 4 WHEN 0 THEN '{q}' WHEN 1 THEN ' ' WHEN 2 THEN 'zzz' ELSE 'x {q}' END",
        )
        one = jobs.check_listings(rows, country, v).select(F.lit(v).alias("variant"), "k", "suburb", "state", "postcode")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH c AS (SELECT k, CASE k % 3 WHEN 0 THEN 30 WHEN 1 THEN 10 ELSE 0 END + CASE WHEN (k * 13) % 70 >= 50 THEN 25 WHEN (k * 13) % 70 >= 20 THEN 15 ELSE 0 END + CASE k % 2 WHEN 0 THEN 10 ELSE 0 END
+ CASE WHEN k % 4 < 2 THEN 30 ELSE 0 END + CASE k % 5 WHEN 0 THEN 20 ELSE 0 END AS s FROM {_K})
SELECT row_number() OVER (ORDER BY s DESC, k)::INT AS no, k::VARCHAR AS employer, s::INT AS score, CASE WHEN s >= 80 THEN 'HOT LEAD 🔥' WHEN s >= 50 THEN 'WARM LEAD ⚡' ELSE 'COLD LEAD ❄️' END AS tier FROM c""")
def employers_scored(spark, sf_dir):
    """X5, X6, O2 as the job: scored, best first, numbered anew."""
    rows = _made(spark, sf_dir, **{
        "Tên chủ sử dụng": "n", "Quốc tịch mong muốn": "CASE k % 3 WHEN 0 THEN '越南' WHEN 1 THEN '無限制' ELSE '' END", "Số lượng tuyển (Quota)": "concat(cast((k * 13) % 70 AS string), '人')",
        "Email liên hệ": "CASE k % 2 WHEN 0 THEN 'a@b.tw' ELSE '' END", "SĐT môi giới": "CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN ' 不顯示 ' ELSE '02' END", "Ngành nghề": "CASE k % 5 WHEN 0 THEN '製造工' ELSE 'x' END",
    })
    out = jobs.score_employers(rows.drop("n").withColumn("No.", F.lit("9")), "k")
    return out.select(F.col("`No.`").alias("no"), F.col("Tên chủ sử dụng").alias("employer"), F.col("Điểm đánh giá").alias("score"), F.col("Xếp loại Lead").alias("tier"))


_Y, _X = "-37 + (k % 40) * 0.05", "175 + ((k * 7) % 40) * 0.05"


@query(f"""WITH RECURSIVE p AS (SELECT k AS id, row_number() OVER (ORDER BY k) AS i, 'Town-' || (k % 300) AS name, (-37 + (k % 40) * 0.05::DOUBLE) AS lat, (175 + ((k * 7) % 40) * 0.05::DOUBLE) AS lng FROM {_K} WHERE k % 11 > 1),
f AS (SELECT 0::BIGINT AS i, 0::BIGINT AS id, 0::BIGINT AS centre, []::STRUCT(id BIGINT, lat DOUBLE, lng DOUBLE)[] AS cs
UNION ALL SELECT p.i, p.id, coalesce(hit, p.id), CASE WHEN hit IS NULL THEN list_append(f.cs, {{'id': p.id, 'lat': p.lat, 'lng': p.lng}}) ELSE f.cs END
FROM f JOIN p ON p.i = f.i + 1, LATERAL (SELECT list_filter(f.cs, lambda c: 12742.0::DOUBLE * asin(sqrt(pow(sin(radians(p.lat - c.lat) / 2), 2)
 + cos(radians(c.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lng - c.lng) / 2), 2))) <= 20)[1].id AS hit)),
g AS (SELECT f.centre, p.name, min(f.id) AS pos FROM f JOIN p USING (id) WHERE f.i > 0 GROUP BY ALL)
SELECT centre AS id, 11 AS zoom, string_agg(name, '|' ORDER BY pos) AS covered FROM g GROUP BY centre""")
def location_grid_centres(spark, sf_dir):
    """2.14, F13, F10, A8: search centres with the names they cover; rows without a number or outside the box are left out."""
    rows = _made(spark, sf_dir, name="concat('tOWN-', cast(k % 300 AS string))", state="'S'", lat=f"CASE k % 11 WHEN 0 THEN 'x' ELSE concat(' ', cast(cast({_Y} AS double) AS string)) END", lng=f"CASE k % 11 WHEN 1 THEN '20' ELSE cast(cast({_X} AS double) AS string) END")
    out = jobs.location_grid(rows.withColumnRenamed("k", "id"), "nz")
    return out.select("id", "zoom", F.array_join("covered", "|").alias("covered"))


@query(f"""WITH l AS (SELECT 'Co ' || (k % 400) AS name, min(k) AS k FROM {_K} GROUP BY 1)
SELECT name, '/c' || k AS href, CASE k % 3 WHEN 0 THEN 'Likvidēts' ELSE 'Aktīvs' END AS status, CASE WHEN k % 4 = 0 THEN NULL ELSE 'p2' || k END AS phone, CASE WHEN k % 4 = 0 THEN NULL WHEN k % 2 = 1 THEN 'e' || k ELSE '' END AS email,
k % 4 = 0 AS open FROM l""")
def registry_two_stages(spark, sf_dir):
    """S12, S13, 2.8: companies of list pages, the details of their own page, and those whose page is still open."""
    value = '<span class="flextable__value">'
    row = f"""concat('<div class="flextable__row"><a class="public_list__link" href="/c', n, '"> Co ', cast(k % 400 AS string), '</a>', CASE k % 3 WHEN 0 THEN '<div data-column-header-name="Statuss">{value}Likvidēts</span></div>' ELSE '' END, '</div>')"""
    cell = lambda label, v: f"""'<div class="wizardform__preview_row"><div class="wizardform__preview_label">{label}</div><div class="wizardform__preview_value"> ', {v}, ' </div></div>'"""
    own = "concat(" + cell("Tālruņa numurs", "'p1', n") + ", " + cell("Tālruņa numurs (2)", "'p2', n") + ", CASE k % 2 WHEN 1 THEN concat(" + cell("Elektroniskā pasta adrese", "'e', n") + ") ELSE '' END)"
    made = _made(spark, sf_dir, listed=row, own=own)
    links = pages.register_list(made.select(F.col("k").alias("page_id"), F.col("listed").alias("html")))
    details = pages.register_details(made.where("k % 4 > 0").select(F.concat(F.lit("/c"), F.col("n")).alias("href"), F.col("own").alias("html")))
    rows, left = jobs.registry_rows(links.select("name", "href", "status"), details.select("href", "phone", "email"))
    none = F.lit(None).cast("string")
    return rows.select("name", "href", "status", "phone", "email", F.lit(False).alias("open")).union(left.select("name", "href", "status", none, none, F.lit(True)))


@query(f"SELECT '/e' || k AS link, 'a  ' || k AS first FROM {_K} WHERE k % 3 > 0 AND k % 5 > 0")
def employer_table_rows(spark, sf_dir):
    """Table rows of enough cells whose link isn't finished, line breaks flattened."""
    html = "concat('<table><tr><td> a', chr(10), n, '</td>', repeat('<td>c</td>', CASE k % 3 WHEN 0 THEN 4 ELSE 10 END), '<td><a href=\"/e', n, '\">l</a></td></tr></table>')"
    made = _made(spark, sf_dir, html=html)
    done = made.where("k % 5 = 0").select(F.concat(F.lit("/e"), F.col("n")).alias("url"))
    return pages.employer_rows(made.select(F.col("k").alias("page_id"), "html"), done).select("link", F.col("cells")[0].alias("first"))


@query(f"SELECT DISTINCT 'town ' || (k % 500) AS location, 's' || (k % 3) AS state, 'nail' AS keyword FROM {_K} WHERE k % 2 = 0")
def finished_searches(spark, sf_dir):
    """Progress files of finished searches, one for each of 16 parts, read as lower-case triples."""
    path = _folder(spark, "progress")
    made = _made(spark, sf_dir, t="array(concat(' Town ', cast(k % 500 AS string)), concat('S', cast(k % 3 AS string)), 'Nail ')").where("k % 2 = 0")
    files = made.groupBy((F.col("k") % 16).alias("g")).agg(F.to_json(F.struct(F.collect_list("t").alias("completed"))).alias("value")).select("value")
    files.write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_done(spark, path)


@query(f"SELECT k, 'u' || k AS url FROM {_K} WHERE k % 3 > 0")
def resume_by_link(spark, sf_dir):
    """2.8, U2: rows whose link no progress file names."""
    path = _folder(spark, "links")
    made = _made(spark, sf_dir, url="concat('u', n)").select("k", "url")
    done = made.where("k % 3 = 0").groupBy((F.col("k") % 16).alias("g")).agg(F.to_json(F.struct(F.collect_list("url").alias("completed_links"))).alias("value"))
    done.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return joins.still_to_do(made, tables.read_links(spark, path), "url")


@query(f"SELECT n AS id, 'Town ' || n AS name FROM {_K}")
def lines_after_header(spark, sf_dir):
    """Files whose header stands after lines of another kind."""
    path = _folder(spark, "headed")
    lines = _made(spark, sf_dir, line="concat(n, ',Town ', n)").groupBy((F.col("k") % 16).alias("g")).agg(F.array_join(F.collect_list("line"), "\n").alias("x"))
    lines.select(F.concat(F.lit("notes\n1,2\nID,Name\n"), F.col("x")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_after_header(spark, path, "ID,Name").select(F.col("ID").alias("id"), F.col("Name").alias("name"))


@query(f"SELECT n AS id, CASE k % 4 WHEN 0 THEN '' ELSE 'x, \"y\"' || chr(10) || n END AS note FROM {_K} WHERE k % 4 < 3")
def columns_by_position(spark, sf_dir):
    """Short and blank rows of files read by position."""
    path = _folder(spark, "positional")
    line = F.when(F.col("k") % 4 == 0, F.col("n")).when(F.col("k") % 4 == 3, " ,, ").otherwise(F.concat(F.lit(" "), F.col("n"), F.lit(' ,skip,"x, ""y""\n'), F.col("n"), F.lit('",more')))
    lines = _made(spark, sf_dir).withColumn("line", line).groupBy((F.col("k") % 16).alias("g")).agg(F.array_join(F.collect_list("line"), "\n").alias("x"))
    lines.select(F.concat(F.lit("h,h,h\n"), F.col("x")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_positional(spark, path, {0: "id", 2: "note"})


@query(f"SELECT 'M ' || k AS name, k::VARCHAR AS member_id, CASE k % 3 WHEN 0 THEN '' ELSE 'm' || k || '.lv' END AS website, '+371 ' || k AS phone, 'a@m' || k || '.lv' AS email, 'Iela ' || k AS address FROM {_K} WHERE k % 5 > 0")
def organisation_cards(spark, sf_dir):
    """Cards inside the html member of a JSON answer, nameless ones left out; two cards an answer."""
    card = (
        """concat('<li itemscope itemtype="http://schema.org/Organization"><div itemprop="name"><a href="/en/member-database/', n, '">', CASE k % 5 WHEN 0 THEN ' ' ELSE concat(' M ', n, ' ') END, '</a></div>', """
        """CASE k % 3 WHEN 0 THEN '' ELSE concat('<span itemprop="url" class="x"><a href="u">m', n, '.lv</a></span>') END, '<i itemprop="telephone">+371 ', n, '</i><i itemprop="email">a@m', n, '.lv </i><b itemprop="address"> Iela ', n, '</b></li>')"""
    )
    made = _made(spark, sf_dir, card=card)
    bodies = made.groupBy((F.col("k") / 2).cast("long").alias("g")).agg(F.to_json(F.struct(F.array_join(F.collect_list("card"), "\n").alias("html"), F.lit(2).alias("count"))).alias("body"))
    return bodies.select(F.explode(web.member_cards(web.envelope_html(F.replace("body", F.lit("/"), F.lit("\\/"))))).alias("c")).select("c.*")


@query(f"SELECT 'Co ' || k AS name, '/company/' || (k % 300) || '/x' AS href, (k % 300)::VARCHAR AS number FROM (SELECT min(k) AS k FROM {_K} GROUP BY k % 300)")
def numbered_company_links(spark, sf_dir):
    """Links of companies, each address once by page order."""
    html = "concat('<a href=/other>o</a><a class=c href=\"/company/', cast(k % 300 AS string), '/x\">Co <b>', n, '</b></a><a href=\"/company/', cast(k % 300 AS string), '/x\">again</a>')"
    return pages.company_links(_made(spark, sf_dir, html=html).select(F.col("k").alias("page_id"), "html"))


@query(f"SELECT DISTINCT 'S' AS state, 'T' || k AS name, round(k / 7.0::DOUBLE, 6) AS lat, round(-k / 3.0::DOUBLE, 6) AS lng, 11 AS zoom FROM {_K}")
def location_dimension(spark, sf_dir):
    """Centres written with six decimals and a summary, read as a location table."""
    path = _folder(spark, "dimension")
    rows = _made(spark, sf_dir, state="'S'", name="concat('T', n)", lat="k / 7.0D", lng="-k / 3.0D", zoom="11", covered="array('a', n)")
    tables.write_dimension(rows.select("state", "name", "lat", "lng", "zoom", "covered"), path)
    return tables.read_locations(spark, path)


@query(f"SELECT n AS id, part FROM {_K}, (VALUES ('one'), ('two')) t(part) WHERE part = 'one' OR k % 2 = 0")
def appended_rows(spark, sf_dir):
    """K3: two batches of rows appended to one CSV table, each file with its header."""
    path = _folder(spark, "appended")
    for part, where in (("one", "true"), ("two", "k % 2 = 0")):
        tables.append_rows(_made(spark, sf_dir).where(where).select(F.col("n").alias("id"), F.lit(part).alias("part")), path)
    return tables.read_csv(spark, f"{path}/*.csv")


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders")
def counters_of_a_run(spark, sf_dir):
    """Counters observed while a table is written."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df, seen = tables.counters(orders, "run", done=F.col("o_orderstatus") == "F", large=F.col("o_totalprice") > 100000)
    df.write.parquet(_folder(spark, "counted"))
    return spark.createDataFrame([tuple(seen.get[c] for c in ("rows", "done", "large"))], "rows long, done long, large long")


def _search_sql(v: str) -> str:
    x = LISTINGS[v]
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in x.keywords)
    where = "name || ', ' || state" if x.state else "name"
    return f"""SELECT '{v}' AS variant, name, keyword, keyword || ' in ' || {where} || ', {x.country}' AS query,
    '{SEARCH_URL}' || replace(url_encode(keyword), '%20', '+') || '/@' || lat || ',' || lng || ',12z?hl={x.language}' AS url FROM l, (SELECT unnest([{words}]) AS keyword)"""


@query(f"""WITH l AS (SELECT 'ST' AS state, n_name AS name, n_nationkey * 1.5::DOUBLE - 10 AS lat, n_nationkey + 0.25::DOUBLE AS lng, n_regionkey FROM nation)
SELECT variant, name, keyword, query, url FROM ({' UNION ALL '.join(map(_search_sql, LISTINGS))}) JOIN l USING (name) WHERE NOT (n_regionkey = 1 AND length(keyword) % 2 = 0)""")
def search_grid_variants(spark, sf_dir):
    """2.12, P31, J1, J2: every place with every keyword of all 18 listing variants, less the finished searches."""
    n, k = spark.read.parquet(f"{sf_dir}/nation.parquet"), F.col("n_nationkey")
    at = n.select(F.lit("ST").alias("state"), F.col("n_name").alias("name"), (k * 1.5 - 10).alias("lat"), (k + 0.25).alias("lng"), F.lit(12).alias("zoom"))
    out = None
    for v, x in LISTINGS.items():
        even = [w.upper() for w in x.keywords if len(w) % 2 == 0]
        done = n.where("n_regionkey = 1").select(F.col("n_name").alias("location"), F.lit("st").alias("state"), F.explode(F.array(*map(F.lit, even)) if even else F.array().cast("array<string>")).alias("keyword"))
        one = jobs.searches(at, v, done).select(F.lit(v).alias("variant"), "name", "keyword", F.col("Search_Query").alias("query"), F.col("search_url").alias("url"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY e = '', k) AS i, * FROM (SELECT k, CASE k % 101 WHEN 0 THEN '' ELSE 'e' || ((k + 1) // 2) END AS e, CASE k % 67 WHEN 0 THEN '' ELSE 'p' || (k // 2) END AS p FROM {_K})),
f AS (SELECT 0::BIGINT AS i, 0::BIGINT AS k, false AS kept, []::VARCHAR[] AS se, []::VARCHAR[] AS sp
UNION ALL SELECT r.i, r.k, NOT ((r.e <> '' AND list_contains(f.se, r.e)) OR (r.p <> '' AND list_contains(f.sp, r.p))),
CASE WHEN r.e = '' OR list_contains(f.se, r.e) OR (r.p <> '' AND list_contains(f.sp, r.p)) THEN f.se ELSE list_append(f.se, r.e) END,
CASE WHEN r.p = '' OR (r.e <> '' AND list_contains(f.se, r.e)) OR list_contains(f.sp, r.p) THEN f.sp ELSE list_append(f.sp, r.p) END FROM f JOIN r ON r.i = f.i + 1)
SELECT k FROM f WHERE kept""")
def two_keys_in_chains(spark, sf_dir):
    """Chains in which each row is beaten by the one before it, with components of bounded size read side by side."""
    rows = _made(spark, sf_dir, e="CASE k % 101 WHEN 0 THEN '' ELSE concat('e', cast((k + 1) div 2 AS string)) END", p="CASE k % 67 WHEN 0 THEN '' ELSE concat('p', cast(k div 2 AS string)) END")
    return dedup.greedy_two_key(rows, "e", "p", "k", most=1000).select("k")
