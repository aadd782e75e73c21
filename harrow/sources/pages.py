"""Tables out of fetched pages: register lists and details, employer tables, company lists."""

from __future__ import annotations

from harrow.functions import web
from harrow.operators.filters import has_cells
from harrow.operators.joins import first_per_key
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    """The first path that is there, in any store Spark reads."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        if at.getFileSystem(conf).exists(at):
            return p
    return None


def _lateral(pages: DataFrame, html: str, function, key: str) -> DataFrame:
    return pages.select(key, html).lateralJoin(function(F.col(html).outer())).drop(html)


def register_list(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """name, href, reg_no and status of every listed company; of one name the first by page counts."""
    rows = _lateral(pages, html, web.ListedCompanies, key)
    return first_per_key(rows, "name", [F.col(key), F.col("href")])


def register_details(pages: DataFrame, key: str = "href", html: str = "html") -> DataFrame:
    """phone, email, legal_address and actual_address of every detail page; of several rows for one field the last of its page counts."""
    rows = _lateral(pages, html, web.LabelledValues, key)
    kind = F.lit(None)
    for field, words in reversed(list(web.DETAIL_LABELS.items())):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(F.col("label"), F.lit(w))
        kind = F.when(hit, field).otherwise(kind)
    rows = rows.withColumn("field", kind).where("field is not null")
    order = F.struct("at", "value")
    last = rows.groupBy(key).agg(*[F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, order)).alias(f) for f in web.DETAIL_LABELS])
    return last.na.fill("")


def employer_rows(pages: DataFrame, done: DataFrame, key: str = "page_id", html: str = "html", least: int = 11) -> DataFrame:
    """Rows of employer tables with enough cells and a link that isn't finished; line breaks in cells become two blanks."""
    rows = _lateral(pages, html, web.TableRows, key).where(has_cells(F.col("cells"), least) & (F.col("link") != ""))
    rows = rows.withColumn("cells", F.transform("cells", lambda c: F.replace(c, F.lit("\n"), F.lit("  "))))
    return rows.join(done.select(F.col("url").alias("link")).distinct(), "link", "left_anti")


def labelled(text: Column, label: str) -> Column:
    """What follows a label up to the end of its line, trimmed."""
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), f"{label}\\s*[:：]?\\s*([^\\n<]*)", 1))


def company_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(name, href, number) of company links in page order, each address once: the number stands in the address."""
    links = pages.select(key, F.posexplode(web.anchors(F.col(html))).alias("pos", "a")).where(F.col("a.href").contains("/company/"))
    first = links.groupBy(F.col("a.href").alias("href")).agg(F.min(F.struct(key, "pos", F.col("a.label").alias("name"))).alias("m"))
    return first.select("m.name", "href", F.regexp_extract("href", r"/company/(\d+)", 1).alias("number"))


# Labels of an employer's page and the columns they fill.
EMPLOYER_LABELS = {"email": "業務聯繫信箱：", "other_language": "希望外國人其它語言：", "job": "工作內容：", "conditions": "勞動條件："}


def employer_details(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    """email, other_language, job and conditions of employer pages: what stands beside a label in a span or a text block, the last one."""
    body = F.coalesce(F.col(html), F.lit(""))
    spans = F.regexp_extract_all(body, F.lit(r"(?is)<span\b[^>]*>(.*?)</span>"), F.lit(1))
    blocks = F.regexp_extract_all(body, F.lit(r'(?is)class="[^"]*\btext-con\b[^"]*"[^>]*>(.*?)</(?:div|p|li|td)>'), F.lit(1))
    own = {"email": spans, "other_language": spans, "job": blocks, "conditions": blocks}

    def value(name: str, label: str) -> Column:
        hit = F.filter(F.transform(own[name], web.strip_tags), lambda x: F.contains(x, F.lit(label)))
        return F.coalesce(F.trim(F.replace(F.get(hit, F.size(hit) - 1), F.lit(label), F.lit(""))), F.lit(""))

    return pages.select(key, *[value(n, w).alias(n) for n, w in EMPLOYER_LABELS.items()])
