"""Contacts of sites from fetched pages, in the order in which a site is searched: its own page, its subpages, its social pages.

A later source counts only for sites that no earlier one gave an address, so each step joins what is left of the sites to the pages. Pages
are an input, in any order, and each is scanned once.
"""

from __future__ import annotations

from harrow.functions import emails, markup, web
from harrow.functions.text import stripped
from harrow.operators import dedup, leads
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCES = {"site": 0, "subpages": 1, "facebook": 2, "instagram": 3}


def scanned(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, mails, seen, links, facebook, instagram) of each address: mails with those of links, seen those in the text alone.

    Of several pages of one address the one with most addresses counts, ties to the first by content. Written.
    """
    p = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("url"), markup.parsed(F.col(html)).alias("p"))
    hrefs = F.transform("p.links", lambda a: a["href"])
    own = lambda test: F.array_distinct(F.filter(hrefs, test))
    seen = emails.extract(F.col("p.text"))
    rows = p.select(
        "url", F.array_sort(F.array_union(emails.mailto(hrefs), seen)).alias("mails"), F.array_sort(seen).alias("seen"), F.col("p.links").alias("links"),
        own(web.is_facebook).alias("facebook"), own(web.is_instagram).alias("instagram"),
    )
    one = rows.groupBy("url").agg(F.max(F.struct(F.size("mails").alias("n"), "mails", "seen", "links", "facebook", "instagram")).alias("b"))
    return dedup._written(one.select("url", "b.mails", "b.seen", "b.links", "b.facebook", "b.instagram"))


def _first_with_mails(asked: DataFrame, found: DataFrame, source: str, mails: str) -> DataFrame:
    """Of each site's addresses(site, at, url) the first whose page has e-mails: (site, source, email)."""
    hits = asked.join(found, "url").where(F.size(mails) > 0)
    best = hits.groupBy("site").agg(F.min(F.struct("at", F.array_join(mails, ", ").alias("email"))).alias("m"))
    return best.select("site", F.lit(source).alias("source"), "m.email")


def site_contacts(sites: DataFrame, pages: DataFrame, site: str = "site", website: str = "website", url: str = "url", html: str = "html", most: int = 4) -> DataFrame:
    """(site, source, email): the addresses of each site, joined by commas, and where they were found; none and an empty text without any.

    A site that is itself a social page is looked for there alone. Of another, all subpages count together and the first social page with an
    address, those of the home page before those of its subpages. Sites without a website, and those whose pages weren't fetched, have none.
    """
    found = scanned(pages, url, html)
    at = stripped(F.col(website))
    given = sites.select(F.col(site).alias("site"), at.alias("website"), web.website_kind(at).alias("kind")).where(F.col("site").isNotNull())
    social = F.col("kind").isin("facebook", "instagram")
    target = F.when(F.col("kind") == "facebook", web.social_url(F.col("website"))).otherwise(web.with_scheme(F.col("website")))
    home = dedup._written(given.where("kind <> 'none'").select("site", "kind", target.alias("url")).join(found, "url"))

    def named(source: Column, mails: Column, rows: DataFrame) -> DataFrame:
        return rows.where(F.size(mails) > 0).select("site", source.alias("source"), F.array_join(mails, ", ").alias("email"))

    own = F.when(F.col("kind") == "instagram", F.col("seen")).otherwise(F.col("mails"))
    first = named(F.when(social, F.col("kind")).otherwise("site"), own, home)
    left = home.where(~social & (F.size("mails") == 0))
    subs = leads.next_links(left, "site", "url", "links", most).select("site", F.col("link").alias("url"), "rank").join(found, "url")
    subs = dedup._written(subs.select("site", "rank", "mails", "facebook", "instagram"))
    mails = subs.groupBy("site").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("mails")))).alias("mails"))
    second = named(F.lit("subpages"), F.col("mails"), mails)
    open_ = left.select("site", "facebook", "instagram", F.lit(0).alias("rank")).union(subs.select("site", "facebook", "instagram", "rank")).join(second.select("site"), "site", "left_anti")
    out = first.union(second)
    for source, mails in (("facebook", "mails"), ("instagram", "seen")):
        asked = open_.select("site", "rank", F.posexplode(source).alias("pos", "href"))
        address = web.social_url(F.col("href")) if source == "facebook" else web.with_scheme(F.col("href"))
        asked = asked.groupBy("site", address.alias("url")).agg(F.min(F.struct("rank", "pos")).alias("at"))
        out = out.union(_first_with_mails(asked, found, source, mails))
    best = leads.first_source(out.distinct(), "site", SOURCES)
    every = given.select("site").distinct().join(best, "site", "left")
    return every.select("site", F.coalesce("source", F.lit("none")).alias("source"), F.coalesce("email", F.lit("")).alias("email"))
