"""Lead scores, tiers, and the choice of pages to look at next."""

from __future__ import annotations

from harrow.functions import text, web
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Points and the words of the reasons given.
HOT, WARM = 80, 50
TIERS = ("HOT LEAD 🔥", "WARM LEAD ⚡", "COLD LEAD ❄️")


def lead_score(nationality: Column, quota: Column, email: Column, agency_phone: Column, category: Column) -> Column:
    """struct(score, reasons): points for nationality, number wanted, an e-mail, no agency, and manufacturing."""
    nat, mail, phone, cat = (F.trim(text.blank(c)) for c in (nationality, email, agency_phone, category))
    n = F.coalesce(F.regexp_extract(F.trim(text.blank(quota)), "[0-9]+", 0).try_cast("int"), F.lit(0))
    made = cat.contains("製造工") | F.lower(cat).contains("sản xuất") | cat.contains("chế tạo")
    rules = [
        (nat.contains("越南"), 30, F.lit("Ưu tiên Việt Nam (+30)")),
        (~nat.contains("越南") & (nat.contains("無限制") | nat.contains("无限制")), 10, F.lit("Không giới hạn quốc tịch (+10)")),
        (n >= 50, 25, F.concat(F.lit("Số lượng tuyển lớn "), n.cast("string"), F.lit(" người (+25)"))),
        ((n >= 20) & (n < 50), 15, F.concat(F.lit("Số lượng tuyển vừa "), n.cast("string"), F.lit(" người (+15)"))),
        (mail.contains("@"), 10, F.lit("Có Email HR liên hệ (+10)")),
        ((phone == "") | phone.contains("不顯示"), 30, F.lit("Không qua môi giới / Liên hệ trực tiếp (+30)")),
        (made, 20, F.lit("Ngành sản xuất/chế tạo (+20)")),
    ]
    points = sum((F.when(c, p).otherwise(0) for c, p, _ in rules), F.lit(0))
    why = F.array_join(F.filter(F.array(*[F.when(c, r) for c, _, r in rules]), lambda x: x.isNotNull()), ", ")
    return F.struct(points.cast("int").alias("score"), why.alias("reasons"))


def tier(score: Column) -> Column:
    return F.when(score >= HOT, TIERS[0]).when(score >= WARM, TIERS[1]).otherwise(TIERS[2])


def next_links(pages: DataFrame, key: str, url: str, links: str, most: int = 4) -> DataFrame:
    """(key, link, priority, rank): up to `most` of an array of links(href, label) a page on its own host: contact-like first, then page
    order, each address once, not the page itself."""
    each = pages.select(key, url, F.posexplode(links).alias("pos", "a")).where(web.is_page_link(F.col("a.href")))
    each = each.withColumn("link", web.resolve(F.col(url), F.col("a.href"))).withColumn("priority", web.link_priority(F.col("a.href"), F.col("a.label")))
    each = each.where((web.host(F.col("link")) == web.host(F.col(url))) & (F.col("link") != F.col(url)))
    once = each.groupBy(key, "link").agg(F.max(F.struct("priority", (-F.col("pos")).alias("pos"))).alias("b"))
    w = Window.partitionBy(key).orderBy(F.desc("b.priority"), F.desc("b.pos"))
    return once.select(key, "link", F.col("b.priority").alias("priority"), F.row_number().over(w).alias("rank")).where(F.col("rank") <= most)


def next_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", most: int = 4) -> DataFrame:
    """next_links() of the anchors of raw pages."""
    return next_links(pages.select(key, url, web.anchors(F.col(html)).alias("_links")), key, url, "_links", most)


def first_source(rows: DataFrame, key: str, order: dict[str, int], source: str = "source", value: str = "email") -> DataFrame:
    """The first source, in the given order, that has a value for a key."""
    ranks = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    found = rows.where(F.col(value) != "").withColumn("_r", ranks[F.col(source)])
    return found.groupBy(key).agg(F.min(F.struct("_r", source, value)).alias("m")).select(key, f"m.{source}", f"m.{value}")
