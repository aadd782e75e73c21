"""Addresses, coordinates, map links and distances."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


@dataclass(frozen=True)
class Country:
    """How a country's addresses are recognised and cut; box: min/max latitude and longitude (exclusive)."""

    words: tuple[str, ...]
    places: tuple[str, ...] = ()
    pattern: str = ""
    unless: str = ""
    ends: tuple[str, ...] = ()
    starts: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    code: str = ""
    box: tuple[float, float, float, float] | None = None


# Words, places and postcode forms by country.
COUNTRIES = {
    "au": Country(("australia",), pattern=r"\b(nsw|vic|qld|wa|sa|tas|act|nt)\s+\d{4}\b", suffixes=("Australia",), box=(-45.0, -9.0, 110.0, 155.0)),
    "au_loose": Country(
        ("australia", ", au"), pattern=r"(^| )(nsw|vic|qld|wa|sa|act|tas|nt)( |$)|\b\d{4}\b", suffixes=("Australia",), box=(-44.0, -10.0, 112.0, 154.0)
    ),
    "nz": Country(
        ("new zealand", " nz"),
        ("auckland", "wellington", "christchurch", "hamilton", "tauranga", "dunedin", "palmerston north", "napier", "nelson", "rotorua", "whangarei",
         "invercargill", "new plymouth", "kapiti", "gisborne", "blenheim", "timaru", "taupo", "oamaru"),
        r"\b\d{4}\b", "australia", ends=("nz",), suffixes=("New Zealand",), code="NZ", box=(-48.0, -33.0, 165.0, 179.5),
    ),
    "lv": Country(
        ("latvia", "latvija", " lv-", ", lv "),
        ("rīga", "riga", "liepāja", "liepaja", "daugavpils", "jelgava", "jūrmala", "jurmala", "ventspils", "rēzekne", "rezekne", "valmiera", "jēkabpils",
         "jekabpils", "ogre", "salaspils"),
        r"\b\d{4}\b", starts=("lv-",), suffixes=("Latvia", "Latvija"), code="LV", box=(55.0, 58.5, 20.5, 28.5),
    ),
    "gr": Country(
        ("greece", "ελλάδα", "ελλας", ", gr"),
        ("athens", "αθήνα", "athina", "thessaloniki", "θεσσαλονίκη", "patras", "πάτρα", "heraklion", "ηράκλειο", "larissa", "λάρισα", "volos", "βόλος",
         "rhodes", "ρόδος", "chania", "χανιά", "ioannina", "ιωάννινα", "chalkida", "χαλκίδα", "kavala", "καβάλα", "serres", "σέρρες", "alexandroupoli",
         "αλεξανδρούπολη", "xanthi", "ξάνθη", "kerkyra", "κέρκυρα", "corfu", "mykonos", "μύκονος", "santorini", "σαντορίνη", "thira", "θήρα", "kos", "κως",
         "zakynthos", "ζάκυνθος", "kalamata", "καλαμάτα"),
        r"\b\d{3}\s?\d{2}\b", suffixes=("Greece", "Ελλάδα"), code="GR", box=(34.0, 42.5, 19.0, 29.8),
    ),
    "pt": Country(
        ("portugal", ", pt"),
        ("lisboa", "lisbon", "porto", "faro", "coimbra", "braga", "funchal", "ponta delgada", "aveiro", "leiria", "setúbal", "setubal", "évora", "evora",
         "viseu", "viana do castelo", "garda", "bragança", "braganca", "beja", "santarém", "santarem", "portimão", "portimao", "albufeira", "lagos",
         "cascais", "sintra", "estoril", "vilamoura"),
        r"\b\d{4}\b", suffixes=("Portugal",), code="PT", box=(32.0, 43.0, -32.0, -6.0),
    ),
    "sk": Country(
        ("slovakia", "slovensko", "slovenská", "slovenskej", "sr", "slovak republic"),
        ("bratislava", "kosice", "košice", "presov", "prešov", "zilina", "žilina", "nitra", "banska bystrica", "banská bystrica", "trnava", "martin",
         "trencin", "trenčín", "poprad", "prievidza", "zvolen", "povazska bystrica", "považská bystrica", "nove zamky", "nové zámky", "michalovce",
         "spisska nova ves", "spišská nová ves", "komarno", "komárno", "levice", "humenne", "humenné", "bardejov", "lipy", "ruzomberok", "ružomberok",
         "piestany", "piešťany", "miasto", "lucenec", "lučenec"),
        r"\b\d{3}\s?\d{2}\b", code="SK", box=(47.5, 50.0, 16.5, 23.0),
    ),
    "tw": Country(
        ("taiwan", "tai wan", "台灣", "臺灣", "中華民國", "r.o.c."),
        ("台北", "臺北", "新北", "桃園", "台中", "臺中", "台南", "臺南", "高雄", "基隆", "新竹", "嘉義", "苗栗", "彰化", "南投", "雲林", "屏東", "宜蘭", "花蓮",
         "台東", "臺東", "澎湖", "金門", "連江", "taipei", "taoyuan", "taichung", "tainan", "kaohsiung", "keelung", "hsinchu", "chiayi", "miaoli",
         "changhua", "nantou", "yunlin", "pingtung", "yilan", "hualien", "taitung", "penghu", "kinmen", "matsu"),
        code="TW", box=(21.8, 26.5, 119.3, 122.5),
    ),
}
SK_REGIONS = ("Bratislava", "Košice", "Prešov", "Žilina", "Nitra", "Banská Bystrica", "Trnava", "Trenčín")
TW_COUNTIES = (
    "台北市", "臺北市", "新北市", "桃園市", "台中市", "臺中市", "台南市", "臺南市", "高雄市", "基隆市", "新竹市", "新竹縣", "苗栗縣", "彰化縣", "南投縣", "雲林縣",
    "嘉義市", "嘉義縣", "屏東縣", "宜蘭縣", "花蓮縣", "台東縣", "臺東縣", "澎湖縣", "金門縣", "連江縣",
)
TW_LATIN = (
    "taipei", "new taipei", "taoyuan", "taichung", "tainan", "kaohsiung", "keelung", "hsinchu", "chiayi", "miaoli", "changhua", "nantou", "yunlin",
    "pingtung", "yilan", "hualien", "taitung", "penghu", "kinmen", "matsu",
)
#: Metropolitan postcodes: state, first, last (inclusive).
METRO_RANGES = (
    ("NSW", 2000, 2234), ("NSW", 2250, 2310), ("NSW", 2500, 2530), ("ACT", 2600, 2620), ("ACT", 2900, 2920), ("VIC", 3000, 3207), ("VIC", 3211, 3220),
    ("QLD", 4000, 4179), ("QLD", 4208, 4228), ("QLD", 4550, 4575), ("SA", 5000, 5174), ("WA", 6000, 6199), ("TAS", 7000, 7018),
)


def in_country(address: Column, country: str) -> Column:
    """Whether an address reads like one of the country: a word or place in it, or a postcode of its form."""
    c = COUNTRIES[country]
    low = F.lower(F.coalesce(address, F.lit("")))
    out = F.lit(False)
    for w in (*c.words, *c.places):
        out = out | low.contains(w)
    for w in c.ends:
        out = out | low.endswith(w)
    for w in c.starts:
        out = out | low.startswith(w)
    if c.pattern:
        out = out | (low.rlike("(?U)" + c.pattern) & (~low.contains(c.unless) if c.unless else F.lit(True)))
    return out & (low != "")


def _part(text: Column, back: int) -> Column:
    """Comma part of text counted from its end, trimmed; null if there are fewer."""
    parts = F.split(text, ",", -1)
    return F.trim(F.get(parts, F.size(parts) - back))


def _before(text: Column, match: Column) -> Column:
    """The last comma part before a match, without a closing comma."""
    head = F.regexp_replace(F.trim(F.substring(text, 1, 1_000_000).substr(F.lit(1), F.locate("\u0001", match) - 1)), ",+$", "")
    return F.coalesce(_part(head, 1), F.lit(""))


def _cut(text: Column, pattern: str) -> tuple[Column, Column]:
    """(the first match, the comma part before it) of a pattern; the match is empty if there is none."""
    found = F.regexp_extract(text, pattern, 0)
    marked = F.regexp_replace(text, f"(?s)^(.*?){pattern}.*$" if not pattern.endswith("$") else f"(?s)^(.*?){pattern}", "$1\u0001")
    return found, _before(text, marked)


def parse_address(address: Column, country: str) -> Column:
    """struct(suburb, state, postcode); nulls for an empty address or one that the country's form can't be read from."""
    c = COUNTRIES[country]
    text = F.coalesce(address, F.lit(""))
    if country == "sk":
        region = F.coalesce(*[F.when(F.lower(text).contains(r.lower()), F.lit(r)) for r in SK_REGIONS], F.lit(""))
        posts = F.regexp_extract_all(text, F.lit(r"(?U)\b\d{3}\s?\d{2}\b"), F.lit(0))
        post = F.coalesce(F.get(posts, F.size(posts) - 1), F.lit(""))  # the last one, as a house number may have five digits and stands before it
        out = (F.when(region == "", "SK").otherwise(region), F.when(region == "", "Slovakia").otherwise(region), post)
    elif country == "tw":
        bare = F.trim(F.regexp_replace(text, "Taiwan|taiwan|台灣|臺灣", ""))
        native = F.regexp_extract(text, "(" + "|".join(TW_COUNTIES) + ")", 0)
        latin = F.initcap(F.regexp_extract(text, r"(?i)\b(" + "|".join(TW_LATIN) + r")\b", 0))
        city = F.when(native != "", native).otherwise(latin)
        district = F.regexp_extract(bare, r"([^\s,]{2,5}(區|鄉|鎮|市))", 0)
        out = (F.when(district != "", district).otherwise(city), F.when(city != "", city).otherwise("TW"), F.regexp_extract(text, r"(?U)\b\d{3,6}\b", 0))
    else:
        for suffix in c.suffixes:
            text = F.trim(F.regexp_replace(text, rf"(?iu),\s*{suffix}\s*$", ""))
        if country == "nz":
            text = F.trim(F.regexp_replace(text, r"(?i)\s*NZ\s*$", ""))
        if country in ("au", "au_loose"):
            pattern = r"(?i)\b(NSW|VIC|QLD|WA|SA|TAS|ACT|NT)\s+(\d{4})$" if country == "au" else r"(?i),\s*([A-Z]{2,3})\s+(\d{4})$"
            found, before = _cut(text, pattern)
            hit = found != ""
            state, post = F.upper(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)
            second = _part(text, 2) if country == "au_loose" else F.lit(None)
            some = second.isNotNull()
            none = F.lit(None).cast("string")
            out = (F.when(hit, before).otherwise(second), F.when(hit, state).when(some, "").otherwise(none), F.when(hit, post).when(some, "").otherwise(none))
        else:
            forms = {"nz": [r"(?U)\b(\d{4})$"], "lv": [r"(?iU)\bLV-\d{4}\b", r"(?U)\b(\d{4})$"], "gr": [r"(?U)\b\d{3}\s?\d{2}\b"], "pt": [r"(?U)\b\d{4}-\d{3}\b"]}[country]
            suburb = F.coalesce(_part(text, 2), _part(text, 1))
            post = F.lit("")
            for k, pattern in reversed(list(enumerate(forms))):
                found, before = _cut(text, pattern)
                code = F.concat(F.lit("LV-"), found) if k else F.upper(found)
                suburb, post = F.when(found != "", before).otherwise(suburb), F.when(found != "", code).otherwise(post)
            out = (suburb, F.lit(c.code), post)
    empty = F.coalesce(address, F.lit("")) == ""
    return F.struct(*[F.when(~empty, v).alias(n) for n, v in zip(("suburb", "state", "postcode"), out, strict=True)])


def in_box(lat: Column, lng: Column, country: str) -> Column:
    a, b, c, d = COUNTRIES[country].box
    return (lat > a) & (lat < b) & (lng > c) & (lng < d)


def link_coordinates(url: Column) -> Column:
    """struct(lat, lng) of a map link: the place's own coordinates, else the viewport's; null without either."""
    pick = lambda k: F.coalesce(
        *[F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), p, k), F.lit("")) for p in (r"!3d(-?\d+\.\d+)!4d(-?\d+\.\d+)", r"@(-?\d+\.\d+),(-?\d+\.\d+)")]
    ).cast("double")
    return F.when(pick(1).isNotNull(), F.struct(pick(1).alias("lat"), pick(2).alias("lng")))


def place_key(url: Column) -> Column:
    """The pair of hex numbers that identifies a place in its link, else the link up to the question mark; lower case."""
    hexes = F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), "1s(0x[0-9a-fA-F]+:0x[0-9a-fA-F]+)", 1), F.lit(""))
    return F.lower(F.coalesce(hexes, F.substring_index(F.coalesce(url, F.lit("")), "?", 1)))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.sin(dlat / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlng / 2) ** 2
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def district_from_address(address: Column) -> Column:
    """The last comma part that names a municipality or one of two cities, else the country code."""
    parts = F.reverse(F.transform(F.split(F.coalesce(address, F.lit("")), ","), lambda p: F.trim(p)))
    hit = F.filter(parts, lambda p: F.lower(p).rlike("nov\\.|pag\\.|rīga|jūrmala"))
    return F.coalesce(F.get(hit, F.lit(0)), F.lit("LV"))
