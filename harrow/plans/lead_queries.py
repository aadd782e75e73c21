"""Queries that run the formatting job for all 22 variants over rows made from `customer`, with SQL that states each variant's rules anew.

Cells are made by the same expressions on both sides; k is c_custkey. They hold blanks, blanks at the ends, repeated names, second columns,
apostrophes, prefixes of every country, cells without a digit and listed, unlisted and missing categories.
"""

from __future__ import annotations

from functools import reduce

from harrow.functions import emails
from harrow.sources import tables
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jobs, variants
from .variants import FORMATTING

_N = "cast({} AS string)"
_MAIL = (
    f"CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'joe' || {_N.format('k % 40')} || '@gmail.com Info@acme' || {_N.format('k % 70')} || '.nz' "
    f"WHEN 2 THEN 'support@x.com, sales@b' || {_N.format('k % 30')} || '.gr' WHEN 3 THEN 'a@chamber.gr hr@d' || {_N.format('k % 25')} || '.lv' ELSE 'mail@otenet.gr reservas@h' || {_N.format('k % 35')} || '.pt' END"
)
_PHONE = (
    "CASE k % 10 WHEN 0 THEN '' WHEN 1 THEN '+64 9 ' || {n} WHEN 2 THEN '''''+371 ' || {n} WHEN 3 THEN '0030 210 12345' || {n} WHEN 4 THEN 'n/a' WHEN 5 THEN '+421 9' || {n} "
    "WHEN 6 THEN '+886 2 ' || {n} WHEN 7 THEN ' (61) 4' || {n} WHEN 8 THEN '30-2101234' || {n} || '5' ELSE '+351 ' || {n} END"
).format(n=_N.format("k % 90"))
_SECOND = f"CASE k % 3 WHEN 0 THEN '+371 55' || {_N.format('k % 45')} ELSE '' END"
_NAME = f"CASE k % 9 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE ' Shop-' || {_N.format('k % 50')} || ' Ñandú (α) ' END"
_FIRM = f"CASE k % 4 WHEN 0 THEN '' ELSE 'Firm ' || {_N.format('k % 60')} END"
_SITE = f"CASE k % 3 WHEN 0 THEN ' ' ELSE 'https://s' || {_N.format('k')} || '.nz ' END"
_CATEGORIES = (
    "", " ", "zzz ", "Car Factory", " home builder", "ΓΡΑΦΕΊΟ Απασχόλησης", "Χόστελ", "Būvuzņēmums", "zivju ferma", "Liela metāla darbnīca", "kokzāģētava un galdniecība", "Albergue", " Sklad", "sklad",
    "Sprostredkovanie práce", "承包商", "紗廠 ",
)
_CATEGORY = f"CASE k % {len(_CATEGORIES)} " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CATEGORIES)) + " END"

#: Column names and cells of the four kinds of input table.
LISTING = {
    "Name": _NAME, "Công ty": _FIRM, "Email": _MAIL, "Liên Hệ mail": f"'second' || {_N.format('k % 20')} || '@e.lv'", "Phone": _PHONE, "SĐT": _SECOND, "Website": _SITE,
    "Liên Hệ": f"'l' || {_N.format('k')}", "Address": "CASE k % 4 WHEN 0 THEN ' ' ELSE '1 St ' END", "Địa chỉ": "'2 St'", "Category": _CATEGORY,
    "Reviews_Count": f"CASE k % 6 WHEN 0 THEN 'x' ELSE {_N.format('k % 7')} END", "Rating": f"{_N.format('k % 5')} || '.5'", "Permanently_Closed": "CASE k % 13 WHEN 0 THEN ' YES' ELSE '' END",
}
REGISTRY = {
    "Tên công ty": "CASE k % 3 WHEN 0 THEN '' ELSE 'Εταιρεία ' || " + _N.format("k % 80") + " END", "Tên tiếng Anh": _FIRM, "Điện thoại": "CASE k % 7 WHEN 0 THEN ' ' ELSE " + _PHONE + " END",
    "Email": _MAIL, "Link chi tiết": _SITE,
}
MEMBERS = {"name": _NAME, "Công ty": _FIRM, "email": _MAIL, "phone": _PHONE, "SĐT": _SECOND, "website": _SITE, "Liên Hệ": "'l'", "address": "' 1 St'"}
JOBS = {
    "Tên chủ sử dụng": f"CASE k % 8 WHEN 0 THEN ' ' ELSE '公 司,' || {_N.format('k % 70')} || '（台） ' END", "SĐT chủ": "CASE k % 4 WHEN 0 THEN '不顯示' WHEN 1 THEN '5E+3' ELSE " + _PHONE + " END",
    "SĐT môi giới": "CASE k % 6 WHEN 0 THEN ' 不顯示 ' ELSE " + _SECOND + " END", "Email liên hệ": _MAIL, "Link chi tiết": _SITE, "Số lượng tuyển (Quota)": _N.format("k % 9"),
    "Địa điểm làm việc": "' 台北 '", "Ngành nghề": "CASE k % 3 WHEN 0 THEN ' 製造工' WHEN 1 THEN 'x ' ELSE '' END", "Điều kiện lao động (Lương/Ăn ở)": "'pay'", "Ngày hết hạn": "'d'",
    "Xếp loại Lead": "CASE k % 2 WHEN 0 THEN 'HOT LEAD 🔥 ' ELSE '' END",
}

_STARTS = {"nz": ("64", "0"), "au": ("61", "0"), "au_bare": ("61", ""), "lv": ("371", ""), "pt": ("351", ""), "sk": ("421", "0"), "tw": ("886", "0")}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _key(cell: str, country: str) -> str:
    d = f"regexp_replace({cell}, '[^0-9]', '', 'g')"
    if country == "gr":
        return f"CASE WHEN starts_with({d}, '0030') AND length({d}) > 10 THEN substr({d}, 5) WHEN starts_with({d}, '30') AND length({d}) > 10 THEN substr({d}, 3) ELSE {d} END"
    start, to = _STARTS[country]
    return f"CASE WHEN starts_with({d}, '{start}') THEN '{to}' || substr({d}, {len(start) + 1}) ELSE {d} END"


def _first(*names: str) -> str:
    return "coalesce(" + ", ".join(f'nullif(trim("{n}"), \'\')' for n in names) + ", '')"


def _table(cell: str, table: dict[str, str]) -> str:
    return f"CASE {cell} " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items()) + " END"


def _kept(p: str) -> str:
    return f"CASE WHEN trim({p}) = '' THEN '' WHEN starts_with(trim({p}), '''') THEN trim({p}) ELSE '''' || trim({p}) END"


def _quoted(p: str) -> str:
    return f"CASE WHEN {p} = '' THEN '' ELSE '''' || ltrim({p}, '''') END"


def _digits(p: str, country: str) -> str:
    return f"CASE WHEN trim({p}) = '' THEN '' ELSE '''' || {_key(p, country)} END"


def _rank(c: str) -> str:
    return f"""CASE WHEN regexp_matches(trim("{c}"), '^[0-9]+(\\.[0-9]+)?$') THEN trim("{c}")::DOUBLE ELSE 0 END"""


def _best(variant: str) -> str:
    """The best address of the cell `mail`, by the variant's word lists."""
    r = FORMATTING[variant].rules
    has = lambda words, *cells: "(" + " OR ".join(f"contains({c}, {_q(w)})" for w in words for c in cells) + ")"
    loc, dom = "split_part(e, '@', 1)", "split_part(e, '@', 2)"
    generic = ", ".join(map(_q, emails.GENERIC_DOMAINS))
    whole = "e" if r.discard == "address" else dom
    points = f"CASE WHEN {dom} IN ({generic}) THEN 0 ELSE 10 END + CASE WHEN {has(r.prefixes, loc)} THEN 5 ELSE 0 END - CASE WHEN {has(r.bad, loc, dom)} THEN 20 ELSE 0 END"
    if r.penalty:
        points += f" - CASE WHEN {has(emails.OLD_PROVIDERS, whole)} THEN {r.penalty} ELSE 0 END"
    keep = f"AND NOT {has(emails.REGISTRY_WORDS, whole)}" if r.discard else ""
    return f"""coalesce((SELECT arg_max(e, ({points})::DOUBLE - length(e) * 0.01::DOUBLE - i * 1e-9::DOUBLE) FROM
      (SELECT unnest(list_transform(regexp_split_to_array(mail, '[,\\s]+'), lambda x: lower(x))) AS e, unnest(range(len(regexp_split_to_array(mail, '[,\\s]+')))) AS i) WHERE contains(e, '@') {keep}), '')"""


#: The rules of each variant, stated for SQL: country of the phones, how phones are shown, how names are compared, the shown category.
_ASCII, _GREEK, _COMPACT = "[^a-z0-9\\s]", "[^a-z0-9\\sα-ωά-ώ]", None
_CELL = _first("Category")
_LOW = f"lower({_CELL})"


def _in_order(table: dict[str, str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({_LOW}, {_q(k)}) THEN {_q(v)}" for k, v in table.items()) + f" ELSE {_q(default)} END"


PLAIN_RULES = {
    "nz_nails": ("nz", _kept, _ASCII, "''"), "nz_barbers": ("nz", _kept, _ASCII, '"Category"'), "nz_farms": ("nz", _kept, _ASCII, '"Category"'), "au_barbers": ("au", _kept, _ASCII, '"Category"'),
    **{n: (n[:2], None, _COMPACT, f'coalesce({_table("trim(" + chr(34) + "Category" + chr(34) + ")", t)}, "Category")')
       for n, t in (("sk_agencies", variants.SK_AGENCIES), ("sk_factories", variants.SK_FACTORIES), ("tw_builders", variants.TW_BUILDERS), ("tw_factories", variants.TW_FACTORIES))},
}
FILLED_RULES = {
    "au_cars": ("au_bare", _quoted, _ASCII, f"coalesce({_table(_LOW, variants.AU_CARS)}, nullif({_CELL}, ''), 'Gara sửa chữa ô tô')"),
    "au_builders": ("au_bare", _quoted, _ASCII, f"coalesce({_table(_LOW, variants.AU_BUILDERS)}, {_CELL})"),
    "pt_hotels": ("pt", _quoted, _ASCII, f"coalesce({_table(_LOW, variants.PT_HOTELS)}, {_CELL})"),
    "gr_brokers": ("gr", None, _GREEK, f"coalesce({_table(_LOW, variants.GR_BROKERS)}, nullif({_CELL}, ''), 'Môi giới lao động Hy Lạp')"),
    "gr_hotels": ("gr", None, _GREEK, f"coalesce({_table(_LOW, variants.GR_HOTELS)}, nullif({_CELL}, ''), 'Khách sạn') || ' Hy Lạp'"),
    "lv_builders": ("lv", None, _ASCII, f"coalesce({_table(_LOW, variants.LV_BUILDERS)}, {_CELL})"),
    "lv_fish": ("lv", None, _ASCII, f"coalesce({_table(_LOW, variants.LV_FISH)}, {_CELL})"),
    "lv_metal": ("lv", None, _ASCII, _in_order(variants.LV_METAL, "Gia công kim loại Latvia")),
    "lv_wood": ("lv", None, _ASCII, _in_order(variants.LV_WOOD, "Gia công gỗ Latvia")),
}
REGISTRY_RULES = {"gr_farms": "Nông lâm thủy sản Hy Lạp", "gr_builders": "Xây dựng Hy Lạp", "gr_makers": "Sản xuất Hy Lạp"}


def _cells(columns: dict[str, str]) -> str:
    return "(SELECT k, " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + " FROM (SELECT c_custkey AS k FROM customer))"


def _name_key(cell: str, drop: str | None) -> str:
    if drop is None:
        return f"lower(regexp_replace(trim({cell}), '[\\s\\-,.()（）]', '', 'g'))"
    return f"trim(regexp_replace(regexp_replace(lower(trim({cell})), '{drop}', '', 'g'), '\\s+', ' ', 'g'))"


def _select(variant: str, **cells: str) -> str:
    """One variant's rows before names are grouped."""
    mail, source, where = cells.pop("mail"), cells.pop("source"), cells.pop("where", "true")
    shown = ", ".join(f"{e} AS {n}" for n, e in cells.items())
    return f"SELECT '{variant}' AS variant, k, {shown}, {_best(variant)} AS email FROM (SELECT *, {mail} AS mail FROM {source} WHERE {where})"


_OPEN = """lower(trim("Permanently_Closed")) <> 'yes'"""


def _plain(v: str) -> str:
    country, show, drop, category = PLAIN_RULES[v]
    phone = '"Phone"'
    return _select(
        v, source="listing", where=_OPEN, mail='"Email"', key=_name_key('"Name"', drop), company='"Name"', phone_key=_key(phone, country), phone=show(phone) if show else _digits(phone, country),
        site="(trim(\"Website\") <> '')::INT", r1=_rank("Reviews_Count"), r2=_rank("Rating"), link='"Website"', address='"Address"', category=category, job="''", broker="''",
    )


def _filled(v: str) -> str:
    country, show, drop, category = FILLED_RULES[v]
    phone, metal = _first("Phone", "SĐT"), v in ("lv_metal", "lv_wood")
    return _select(
        v, source="listing", where=_OPEN, mail=_first("Email", "Category", "Liên Hệ mail"), key=_name_key(_first("Name", "Công ty"), drop), company=_first("Name", "Công ty"),
        phone_key=_key(phone, country), phone=show(phone) if show else _digits(phone, country),
        site=f"({_first('Website') if metal else _first('Website', 'Công ty', 'Liên Hệ')} <> '')::INT", r1=_rank("Reviews_Count"), r2="0" if metal else _rank("Rating"),
        link=_first("Website", "Công ty", "Liên Hệ") if v == "gr_brokers" else _first("Website", "Liên Hệ"), address=_first("Address", "Địa chỉ"), category=category, job="''", broker="''",
    )


def _registered(v: str) -> str:
    name, phone = """coalesce(nullif("Tên công ty", ''), "Tên tiếng Anh")""", '"Điện thoại"'
    return _select(
        v, source="registry", mail='"Email"', key=_name_key(name, _GREEK), company=f"trim({name})", phone_key=_key(phone, "gr"), phone=f"CASE WHEN {phone} = '' THEN '' ELSE '''' || {_key(phone, 'gr')} END",
        site="(trim(\"Link chi tiết\") <> '')::INT", r1="0", r2="0", link='trim("Link chi tiết")', address="''", category=_q(REGISTRY_RULES[v]), job="''", broker="''",
    )


def _member() -> str:
    phone = _first("phone", "SĐT")
    return _select(
        "lv_metal_members", source="members", mail=_first("email"), key=_name_key(_first("name", "Công ty"), _ASCII), company=_first("name", "Công ty"), phone_key=_key(phone, "lv"), phone=_digits(phone, "lv"),
        site=f"({_first('website')} <> '')::INT", r1="0", r2="0", link=_first("website", "Liên Hệ"), address=_first("address"), category="'Hiệp hội Cơ khí - Gia công kim loại Latvia (MASOC)'", job="''", broker="''",
    )


def _job() -> str:
    own, other = '"SĐT chủ"', '"SĐT môi giới"'
    clash = lambda c: f"CASE WHEN trim({c}) = '不顯示' THEN '' ELSE {_key(c, 'tw')} END"
    shown = lambda c: f"CASE WHEN trim({c}) IN ('', '不顯示') OR contains({c}, 'E+') OR contains({c}, 'e+') OR {_key(c, 'tw')} = '' THEN '' ELSE '''' || {_key(c, 'tw')} END"
    return _select(
        "tw_jobs", source="jobs", mail='"Email liên hệ"', key=_name_key('"Tên chủ sử dụng"', _COMPACT), company='"Tên chủ sử dụng"', phone_key=f"coalesce(nullif({clash(own)}, ''), {clash(other)})", phone=shown(own),
        site="(trim(\"Link chi tiết\") <> '')::INT", r1=_rank("Số lượng tuyển (Quota)"), r2="0", link='"Link chi tiết"', address='"Địa điểm làm việc"', category='trim("Xếp loại Lead")',
        job=f"coalesce({_table('trim(' + chr(34) + 'Ngành nghề' + chr(34) + ')', variants.TW_JOBS)}, \"Ngành nghề\")", broker=shown(other),
    )


def _sql(sources: dict[str, dict[str, str]], rows: list[str]) -> str:
    """Best row a name, the two-key rule read in order by recursion, numbers."""
    tables = ", ".join(f"{n} AS {_cells(c)}" for n, c in sources.items())
    return f"""WITH RECURSIVE {tables}, r AS ({' UNION ALL '.join(rows)}),
g AS (SELECT *, row_number() OVER (PARTITION BY variant, key ORDER BY (email <> '') DESC, site DESC, r1 DESC, r2 DESC, k) AS nth, min(k) OVER (PARTITION BY variant, key) AS pos FROM r WHERE key <> ''),
o AS (SELECT *, row_number() OVER (PARTITION BY variant ORDER BY email = '', pos) AS n FROM g WHERE nth = 1),
f AS (SELECT DISTINCT variant, 0::BIGINT AS n, false AS kept, []::VARCHAR[] AS se, []::VARCHAR[] AS sp FROM o
UNION ALL SELECT o.variant, o.n, NOT ((email <> '' AND list_contains(se, email)) OR (phone_key <> '' AND list_contains(sp, phone_key))),
CASE WHEN (email <> '' AND list_contains(se, email)) OR (phone_key <> '' AND list_contains(sp, phone_key)) OR email = '' THEN se ELSE list_append(se, email) END,
CASE WHEN (email <> '' AND list_contains(se, email)) OR (phone_key <> '' AND list_contains(sp, phone_key)) OR phone_key = '' THEN sp ELSE list_append(sp, phone_key) END
FROM f JOIN o ON o.variant = f.variant AND o.n = f.n + 1)
SELECT variant, row_number() OVER (PARTITION BY variant ORDER BY email = '', pos)::INT AS no, company, phone, link, email, address, category, job, broker
FROM o JOIN f USING (variant, n) WHERE kept"""


def _formatted(spark: SparkSession, sf_dir: str, columns: dict[str, str], names: list[str]) -> DataFrame:
    made = tables.spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k")), "k")
    made = made.select(F.col("k").alias("row_id"), *[F.expr(e).alias(n) for n, e in columns.items()])
    out = []
    for v in names:
        df = jobs.format_leads(made, v)
        has = lambda c: F.col(c) if c in df.columns else F.lit("")  # noqa: B023, E731
        out.append(df.select(
            F.lit(v).alias("variant"), F.col("`No.`").alias("no"), F.col("Công ty").alias("company"), F.col("SĐT").alias("phone"), F.col("Liên Hệ").alias("link"), F.col("Email").alias("email"),
            F.col("Địa chỉ").alias("address"), has("Category").alias("category"), has("Chức danh").alias("job"), has("SĐT môi giới").alias("broker"),
        ))
    return reduce(DataFrame.unionByName, out)


def format_plain_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight variants that show cells as they are."""
    return _formatted(spark, sf_dir, LISTING, list(PLAIN_RULES))


def format_filled_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine variants that take the first filled one of several columns."""
    return _formatted(spark, sf_dir, LISTING, list(FILLED_RULES))


def format_registry_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three company registers, the members' list and the job offers."""
    parts = [(REGISTRY, list(REGISTRY_RULES)), (MEMBERS, ["lv_metal_members"]), (JOBS, ["tw_jobs"])]
    return reduce(DataFrame.unionByName, [_formatted(spark, sf_dir, c, names) for c, names in parts])


#: The check of each cleaning variant, stated for SQL: its categories, whether a cell has to contain or equal one, in lower case or as it is, and whether blank ones pass.
_LISTS = {
    "au_cars": (variants.AU_CARS, "contains"), "gr_brokers": (variants.GR_BROKERS, "contains"), "au_builders": (variants.AU_BUILDERS, "contains"), "pt_hotels": (variants.PT_HOTELS, "contains"),
    "gr_hotels": (variants.GR_HOTELS, "contains"), "lv_metal": (variants.LV_METAL, "contains"), "lv_wood": (variants.LV_WOOD, "contains"), "lv_fish": ([k for k in variants.LV_FISH if k != "ražotājs"], "contains"),
    "lv_builders": (variants.LV_BUILDERS, "lower"), "nz_farms": (variants.NZ_FARMS, "lower"), "au_barbers": (["barber shop"], "lower"), "nz_barbers": (["barber shop"], "lower"),
    "sk_agencies": (variants.SK_AGENCIES, "exact"), "sk_factories": (variants.SK_FACTORIES, "exact"), "tw_builders": (variants.TW_BUILDERS, "exact"), "tw_factories": (variants.TW_FACTORIES, "exact"),
    "au_nails": ([], "all"), "nz_nails": ([], "all"),
}


def _passes(v: str) -> str:
    words, how = _LISTS[v]
    cell = """trim("Category")"""
    if how == "all":
        return "true"
    hit = " OR ".join(f"contains(lower({cell}), {_q(w)})" for w in words) if how == "contains" else f"{cell if how == 'exact' else f'lower({cell})'} IN ({', '.join(map(_q, words))})"
    return f"({cell} <> '' AND ({hit}))" if v == "gr_brokers" else f"({cell} = '' OR {hit})"


_ALL = ("Name", "Website", "Phone", "Address", "Category")
#: Rows 40 apart are equal, but for those whose phones differ in apostrophes alone.
_CLEAN = {n: LISTING[n].replace("k %", "(k % 400) %") for n in _ALL}
_CLEAN["Website"] = f"CASE k % 3 WHEN 0 THEN ' ' ELSE 'https://www.s' || {_N.format('k % 97')} || '.nz/' END"


def clean_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.13: equal rows once, category check, phones behind one apostrophe, for all 18 variants."""
    made = tables.spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k")), "k")
    made = made.select(F.col("k").alias("row_id"), *[F.expr(e).alias(n) for n, e in _CLEAN.items()])
    out = [jobs.clean(made, v).select(F.lit(v).alias("variant"), "row_id", F.col("Phone").alias("phone"), F.col("Category").alias("category")) for v in _LISTS]
    return reduce(DataFrame.unionByName, out)


_CLEAN_SQL = f"""WITH c AS {_cells(_CLEAN)}, d AS (SELECT min(k) AS row_id, {', '.join(f'"{n}"' for n in _ALL)} FROM c GROUP BY ALL)
{' UNION ALL '.join(f"SELECT '{v}' AS variant, row_id, {_quoted('trim(' + chr(34) + 'Phone' + chr(34) + ')')} AS phone, {chr(34)}Category{chr(34)} AS category FROM d WHERE {_passes(v)}" for v in _LISTS)}"""


QUERIES = {f.__name__: f for f in (format_plain_variants, format_filled_variants, format_registry_variants, clean_variants)}
SQL = {
    "clean_variants": _CLEAN_SQL,
    "format_plain_variants": _sql({"listing": LISTING}, [_plain(v) for v in PLAIN_RULES]),
    "format_filled_variants": _sql({"listing": LISTING}, [_filled(v) for v in FILLED_RULES]),
    "format_registry_variants": _sql({"registry": REGISTRY, "members": MEMBERS, "jobs": JOBS}, [*map(_registered, REGISTRY_RULES), _member(), _job()]),
}
