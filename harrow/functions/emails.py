"""E-mail addresses: extraction, scoring, choice of the best one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ADDRESS = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7}\b"
ASSET_ENDINGS = ("png", "jpg", "jpeg", "gif", "svg", "webp", "pdf", "css", "js", "ico", "woff", "woff2", "mp4", "mp3")
GENERIC_DOMAINS = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "live.com", "aol.com", "icloud.com", "mail.com", "ymail.com", "msn.com",
    "wix.com", "squarespace.com", "wordpress.com", "wixpress.com",
)
BAD_WORDS = ("wix", "support", "no-reply", "noreply", "test", "example", "domain")
REGISTRY_WORDS = (
    "cci", "chamber", "epimel", "epime", "eea.gr", "gov.gr", "evep", "eves", "eveh", "ebed", "icci", "bep.gr", "dramanet", "arcadianet",
    "eber.gr", "epimevro", "ebef", "gemi",
)
OLD_PROVIDERS = ("otenet.gr", "otenet")
PREFIXES = ("info", "hello", "contact", "salon", "bookings", "appointments", "enquiries", "manager", "office", "sales", "admin")


@dataclass(frozen=True)
class Rules:
    """How candidates are split, thrown out and scored.

    discard: words that rule an address out, tested on the whole address ("address"), its domain ("domain") or not at all.
    """

    prefixes: tuple[str, ...] = PREFIXES
    bad: tuple[str, ...] = BAD_WORDS
    separators: str = r"(?U)[,\s]+"
    discard: str = ""
    penalty: int = 0

    @classmethod
    def registry(cls, prefixes: tuple[str, ...]) -> Rules:
        return cls(prefixes, separators=r"(?U)[,\s;]+", discard="address", penalty=50)

    @classmethod
    def broker(cls, prefixes: tuple[str, ...]) -> Rules:
        return cls(prefixes, separators=r"(?U)[,\s;]+", discard="domain", penalty=5)


def _has(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def is_asset(c: Column) -> Column:
    return c.rlike(r"\.(" + "|".join(ASSET_ENDINGS) + r")\z")


def extract(text: Column) -> Column:
    """Distinct lower-case addresses of a text in order of first appearance, without names of asset files."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ADDRESS), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, F.lower), lambda e: ~is_asset(e)))


def mailto(hrefs: Column) -> Column:
    """Addresses of the mailto links among an array of hrefs, up to a question mark."""
    found = F.filter(hrefs, lambda h: h.startswith("mailto:"))
    found = F.transform(found, lambda h: F.lower(F.trim(F.substring_index(F.replace(h, F.lit("mailto:"), F.lit("")), "?", 1))))
    return F.array_distinct(F.filter(found, lambda e: (e != "") & ~is_asset(e)))


def local_part(e: Column) -> Column:
    return F.substring_index(e, "@", 1)


def domain(e: Column) -> Column:
    return F.substr(e, F.locate("@", e) + 1)


def candidates(cell: Column, rules: Rules = Rules()) -> Column:
    parts = F.transform(F.split(F.coalesce(cell, F.lit("")), rules.separators), F.lower)
    return F.filter(parts, lambda e: e.contains("@"))


def score(e: Column, rules: Rules = Rules()) -> Column:
    local, host = local_part(e), domain(e)
    points = F.when(host.isin(*GENERIC_DOMAINS), 0).otherwise(10) + F.when(_has(local, rules.prefixes), 5).otherwise(0)
    points = points - F.when(_has(local, rules.bad) | _has(host, rules.bad), 20).otherwise(0)
    if rules.penalty:
        points = points - F.when(_has(e if rules.discard == "address" else host, OLD_PROVIDERS), rules.penalty).otherwise(0)
    return points.cast("double") - F.length(e) * F.lit(0.01)


def best(cell: Column, rules: Rules = Rules()) -> Column:
    """The candidate with the highest score, the first of equals; empty without one."""
    found = candidates(cell, rules)
    if rules.discard:
        found = F.filter(found, lambda e: ~_has(e if rules.discard == "address" else domain(e), REGISTRY_WORDS))
    scored = F.transform(found, lambda e, i: F.struct(score(e, rules).alias("s"), (-i).alias("i"), e.alias("e")))
    return F.coalesce(F.array_max(scored)["e"], F.lit(""))
