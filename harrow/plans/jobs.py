"""The jobs end to end: clean listings, format leads, score employers, make location grids, enrich with e-mails."""

from __future__ import annotations

from harrow.functions import emails, markup, places, text, web
from harrow.operators import clusters, dedup, joins, leads
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .variants import CLEANING, FORMATTING, GRIDS, LISTINGS, SEARCH_URL, TEMPLATE


def cell(df: DataFrame, *names: str, take: str = "filled") -> Column:
    """A cell of the named columns that the table has: the first filled one without blanks at its ends, the first present one, or the first column's."""
    have = [F.col(f"`{n}`") for n in names if n in df.columns]
    if not have:
        return F.lit("")
    if take == "first":
        return text.blank(have[0])
    return text.first_filled(*have) if take == "filled" else F.coalesce(*[F.nullif(c, F.lit("")) for c in have], F.lit(""))


def clean(rows: DataFrame, variant: str, row_id: str = "row_id") -> DataFrame:
    """Equal rows once, category filter, phones quoted, rows with a website first by its key; keeps row_id.

    Equal rows are removed before phones are quoted, so rows that differ in quotes alone both stay.
    """
    c = CLEANING[variant]
    columns = [x for x in rows.columns if x != row_id]
    df = dedup.first_of_equal_rows(rows, columns, row_id)
    if c.values and "Category" in columns:
        df = df.where(joins.allowed(F.col("Category"), c.values, contains=c.contains, lower=c.lower, blank=c.blank))
    if "Phone" in columns:
        df = df.withColumn("Phone", text.phone_quoted(F.col("Phone")))
    key = text.website_key(F.col("Website"))
    return df.orderBy((key == "").cast("int"), key, row_id).select(*rows.columns)


def format_leads(rows: DataFrame, variant: str, row_id: str = "row_id") -> DataFrame:
    """Template rows of a listing table: closed ones out, best e-mail, one row a name, two-key rule, numbered, projected.

    A missing column is blank; rows whose name has nothing that its key keeps are left out, repeated rows fall to the first, and an empty table
    gives an empty one. Cells of `first` columns are shown as they are, all others without blanks at their ends.
    """
    v = FORMATTING[variant]
    of = lambda names: cell(rows, *names, take=v.cells.take)
    show = (lambda c: c) if v.cells.take == "first" else text.stripped
    df = rows
    if v.closed and "Permanently_Closed" in rows.columns:
        df = df.where(F.lower(text.stripped(F.col("Permanently_Closed"))) != "yes")
    tier = of(v.cells.tier) if any(c in rows.columns for c in v.cells.tier) else F.lit(v.default)
    df = df.select(
        F.col(row_id).alias("_id"), text.name_key(of(v.cells.name), v.names).alias("_key"), emails.best(of(v.cells.email), v.rules).alias("_email"),
        of(v.cells.phone).alias("_phone"), show(of(v.cells.shown)).alias("_name"), show(of(v.cells.link)).alias("_web"), show(of(v.cells.address)).alias("_address"),
        of(v.cells.category).alias("_category"), of(v.cells.pay).alias("_pay"), of(v.cells.until).alias("_until"), of(v.cells.broker).alias("_broker"), tier.alias("_tier"),
        (text.stripped(of(v.cells.site)) != "").cast("double").alias("_site"), *[text.number(cell(rows, c)).alias(f"_rank{i}") for i, c in enumerate(v.rank)],
    )
    rank = [(F.col("_email") != "").cast("double"), F.col("_site"), *[F.col(f"_rank{i}") for i in range(len(v.rank))]]
    df = dedup.best_of_group(df, "_key", rank, "_id")
    key = lambda c: text.phone_key(F.col(c), v.phone)
    if v.shows == "jobs":
        own = lambda c: F.when(text.stripped(F.col(c)) != text.NOT_SHOWN, F.nullif(key(c), F.lit("")))
        df = df.withColumn("_phone_key", F.coalesce(own("_phone"), own("_broker"), F.lit("")))
    else:
        df = df.withColumn("_phone_key", key("_phone"))
    df = dedup.greedy_two_key(df, "_email", "_phone_key", "group_pos")
    df = dedup.numbered(df, [(F.col("_email") == "").cast("int"), F.col("group_pos")])
    open_digits = lambda c: F.when(text.phone_hidden(F.col(c)) | (key(c) == ""), "").otherwise(text.phone_display(F.col(c), v.phone))
    if v.shows == "jobs":
        phone = open_digits("_phone")
    elif v.shows == "digits":
        # of a cell that is there but blank, only a registry's shows its apostrophe
        phone = F.when(F.col("_phone") == "", "").otherwise(F.concat(F.lit("'"), key("_phone"))) if v.cells.take == "present" else text.phone_display(F.col("_phone"), v.phone)
    else:
        phone = (text.phone_quoted if v.shows == "quoted" else text.phone_prefixed)(F.col("_phone"))
    if v.lookup == "first":
        df = df.withColumn("Category", joins.translate_first(F.col("_category"), v.table, v.default))
    elif v.lookup == "constant":
        df = df.withColumn("Category", F.lit(v.default))
    elif v.table:
        default = None if v.cells.tier else v.default
        df = joins.translate(df, "_category", v.table, "Category", lower=v.lookup == "lower", default=default, suffix=v.suffix, as_is=v.cells.take == "first")
    else:
        df = df.withColumn("Category", F.col("_category"))
    filled = {
        "Công ty": F.col("_name"), "SĐT": phone, "Liên Hệ": F.col("_web"), "Email": F.col("_email"), "Địa chỉ": F.col("_address"), "Lương": F.col("_pay"),
        "Hạn tuyển": F.col("_until"), "Lần Follow-up": F.lit(0), "Chức danh": F.col("Category") if v.cells.tier else F.lit(""),
    }
    out = [F.col("`No.`")]
    for name in TEMPLATE[1:]:
        out.append(filled.get(name, F.lit("")).alias(name))
        if name == "Công ty" and v.latin:
            out.append(text.to_latin(F.col("_name")).alias("Tên Latin"))
    if v.category:
        out.append((text.stripped(F.col("_tier")) if v.cells.tier else F.col("Category")).alias("Category"))
    if v.cells.broker:
        out.append(open_digits("_broker").alias("SĐT môi giới"))
    return df.orderBy("`No.`").select(*out)


def score_employers(rows: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Employers with score, tier and reasons, best first, numbered anew."""
    get = lambda n: cell(rows, n)
    s = leads.lead_score(get("Quốc tịch mong muốn"), get("Số lượng tuyển (Quota)"), get("Email liên hệ"), get("SĐT môi giới"), get("Ngành nghề"))
    df = rows.drop("No.").withColumn("_s", s).withColumns({"Điểm đánh giá": F.col("_s.score"), "Lý do xếp hạng": F.col("_s.reasons")})
    df = df.withColumn("Xếp loại Lead", leads.tier(F.col("_s.score"))).drop("_s")
    df = dedup.numbered(df, [F.desc("Điểm đánh giá"), F.col(row_id)])
    head = ["No.", "Điểm đánh giá", "Xếp loại Lead", "Lý do xếp hạng"]
    return df.orderBy("`No.`").select(*[f"`{c}`" for c in [*head, *[c for c in rows.columns if c not in ("No.", row_id)]]])


def location_grid(rows: DataFrame, country: str, metro: DataFrame | None = None) -> DataFrame:
    """Search centres of a country's places (id, name, state, lat, lng as text): numbers checked, box, metro ranges, clustered."""
    radius, zoom = GRIDS[country]
    df = rows.withColumns({c: F.trim(F.col(c)).try_cast("double") for c in ("lat", "lng")}).where("name <> '' and lat is not null and lng is not null")
    df = df.where(places.in_box(F.col("lat"), F.col("lng"), country))
    if metro is not None:
        df = joins.in_ranges(df, F.col("postcode").try_cast("int"), metro, ["state"])
    if country in ("au", "nz"):
        df = df.withColumn("name", text.title_case(F.col("name")))
    return clusters.centres_with_names(df, radius, zoom)


def searches(locations: DataFrame, variant: str, done: DataFrame) -> DataFrame:
    """Every place of a location table (state, name, lat, lng, zoom) with every keyword of a listing variant, less the finished ones.

    Adds keyword, Search_Query and the address of the search. done has (location, state, keyword) in lower case.
    """
    v = LISTINGS[variant]
    words = locations.sparkSession.createDataFrame([(k,) for k in v.keywords], "keyword string")
    grid = joins.open_grid(locations.withColumn("location", F.col("name")), words, done, ["location", "state", "keyword"]).drop("location")
    at = [F.col("name"), *([F.col("state")] if v.state else []), F.lit(v.country)]
    coded = F.replace(F.replace(F.url_encode("keyword"), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    where = F.concat(F.col("lat").cast("string"), F.lit(","), F.col("lng").cast("string"), F.lit(","), F.col("zoom").cast("string"))
    return grid.withColumn("Search_Query", F.concat(F.col("keyword"), F.lit(" in "), F.concat_ws(", ", *at))).withColumn(
        "search_url", F.concat(F.lit(SEARCH_URL), coded, F.lit("/@"), where, F.lit(f"z?hl={v.language}"))
    )


def check_listings(rows: DataFrame, country: str, variant: str | None = None) -> DataFrame:
    """Listings that name themselves, lie in the country by address and, where the link has coordinates, by its box.

    With a listing variant, their Category has to pass its check as well.
    """
    v = LISTINGS[variant] if variant else None
    if v and v.categories:
        rows = rows.where(joins.allowed(F.col("Category"), v.categories, contains=v.contains, lower=v.lower, blank=v.blank))
    at = places.link_coordinates(F.col("URL"))
    df = rows.withColumns({"_at": at, "place": places.place_key(F.col("URL")), "_a": places.parse_address(F.col("Address"), country)})
    df = df.where((F.trim(text.blank(F.col("Name"))) != "") & places.in_country(F.col("Address"), country))
    df = df.where(F.col("_at").isNull() | places.in_box(F.col("_at.lat"), F.col("_at.lng"), country))
    state = text.first_filled(F.col("_a.state"), F.col("State") if "State" in rows.columns else F.lit(""))
    return df.withColumns({"suburb": text.blank(F.col("_a.suburb")), "state": state, "postcode": text.blank(F.col("_a.postcode"))}).drop("_at", "_a")


def registry_rows(links: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, open): companies of list pages (name, href, ...) with the details of their own page, and those still without any."""
    some = details.withColumn("_some", F.lit(True))
    return joins.dependents(links, some, "href", "_some").drop("_some"), joins.dependents(links, some, "href", "_some", missing=True)


def page_emails(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Addresses of a page: mailto links and visible text, sorted and joined; and its social links. A null page has none."""
    seen = pages.select(key, markup.parsed(F.col(html)).alias("_p"))
    links = F.transform("_p.links", lambda a: a["href"])
    found = F.array_sort(F.array_union(emails.mailto(links), emails.extract(F.col("_p.text"))))
    return seen.select(
        key, F.array_join(found, ", ").alias("email"), F.array_distinct(F.filter(links, web.is_facebook)).alias("facebook"),
        F.array_distinct(F.filter(links, web.is_instagram)).alias("instagram"),
    )
