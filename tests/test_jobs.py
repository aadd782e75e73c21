"""Sources, sinks and whole jobs."""

import json
import zipfile

import pytest
from harrow.plans import jobs
from harrow.plans.variants import CLEANING, FORMATTING, LISTINGS, TEMPLATE
from harrow.sources import pages as fetched
from harrow.sources import tables, xlsx
from harrow.streaming import resume
from pyspark.sql import functions as F


def test_ragged_csv(spark, tmp_path):
    head = ",".join(tables.LISTING)
    (tmp_path / "a.csv").write_text("﻿" + head + "\n" + "A," * 11 + "u1,Yes\n" + '"B\nC",' + "x," * 10 + "u2\n", encoding="utf-8")
    rows = {r.URL: r for r in tables.read_listings(spark, str(tmp_path / "a.csv")).collect()}
    assert (rows["u1"].Permanently_Closed, rows["u2"].Permanently_Closed, rows["u2"].Name) == ("Yes", "No", "B\nC")


def test_other_sources(spark, tmp_path):
    (tmp_path / "p.csv").write_text("h,h,h\n a ,b,c\n,,\nd\n")
    assert [tuple(r) for r in tables.read_positional(spark, str(tmp_path / "p.csv"), {0: "x", 2: "y"}).collect()] == [("a", "c"), ("d", "")]
    (tmp_path / "t.tsv").write_text('1\tA"B\t3\n1\t2\n')
    assert [tuple(r) for r in tables.read_tsv(spark, str(tmp_path / "t.tsv"), 3, {1: "name"}).collect()] == [('A"B',)]
    (tmp_path / "h.csv").write_text("junk\nmore,junk\nID,Name\n1,x\n2,y\n")
    assert [(r.ID, r.Name) for r in tables.read_after_header(spark, str(tmp_path / "h.csv"), "ID,Name").orderBy("at").collect()] == [("1", "x"), ("2", "y")]
    (tmp_path / "s.json").write_text(json.dumps({"completed": [["Sydney", "NSW", "Nail"]]}))
    assert [tuple(r) for r in tables.read_done(spark, str(tmp_path / "s.json")).collect()] == [("sydney", "nsw", "nail")]
    state = {"completed_pages": [1], "company_links": {"A": {"href": "/1", "ur_num": "4", "status": "s"}}, "scraped_details": {"/1": {"phone": "1", "email": "", "legal_address": "", "actual_address": ""}, "/2": None}}
    (tmp_path / "r.json").write_text(json.dumps(state))
    links, details = tables.read_registry_state(spark, str(tmp_path / "r.json"))
    assert links.count() == 1 and [r.href for r in details.collect()] == ["/1"]


def test_csv_sink_has_a_mark(spark, tmp_path):
    tables.write_csv(spark.createDataFrame([("a", 'q"r')], "x string, y string").coalesce(1), str(tmp_path / "o"))
    (part,) = (tmp_path / "o").glob("*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfx,y") and tables.read_csv(spark, str(part)).first().y == 'q"r'


def test_xlsx_round_trip(spark, tmp_path):
    spark.dataSource.register(xlsx.XlsxSource)
    df = spark.createDataFrame([("1", "Zoë & <co>"), ("2", None)], "no string, name string").coalesce(1)
    df.write.format("xlsx").option("sheet", "Raw").mode("overwrite").save(str(tmp_path / "book"))
    got = spark.read.format("xlsx").option("sheet", "Raw").option("startRow", 2).option("width", 2).load(str(tmp_path / "book")).collect()
    assert sorted(tuple(r) for r in got) == [("1", "Zoë & <co>"), ("2", None)]
    names = spark.read.format("xlsx").option("startRow", 2).option("cols", "2").load(str(tmp_path / "book")).collect()
    assert {r[0] for r in names} == {"Zoë & <co>", None}


def listing(spark, rows):
    names = ["row_id", "Name", "Website", "Phone", "Address", "Rating", "Reviews_Count", "Category", "Permanently_Closed", "Email"]
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{n} string" for n in names[1:]))


ROWS = [
    (0, "Bella Nails", "https://www.b.nz/", "+64 9 1", "1 St", "4,0", "90", "Nail salon", "No", ""),
    (1, "Other", "", "021", "2 St", "4", "1", "", "No", "x@gmail.com"),
    (2, "bella  nails!", "a.nz", "+64 9 2", "1 St", "5", "3", "Nail salon", "", "info@b.nz joe@b.nz"),
    (3, "Closed", "c.nz", "1", "3 St", "5", "9", "x", "Yes", "info@c.nz"),
    (4, "Third", "d.nz", "021", "4 St", "5", "9", "x", "No", ""),
    (5, "美甲", "e.nz", "5", "5 St", "5", "9", "x", "No", "info@e.nz"),
    (6, "Other", "", "021", "2 St", "4", "1", "", "No", "x@gmail.com"),
]


def test_clean(spark):
    out = jobs.clean(listing(spark, ROWS), "nz_nails").collect()
    assert len(out) == 6 and [r.row_id for r in out][:2] == [2, 0] and out[0].Phone == "'+64 9 2"
    same = listing(spark, [ROWS[0], (9, *ROWS[0][1:])])
    assert [r.row_id for r in jobs.clean(same, "nz_nails").collect()] == [0]


def test_format(spark):
    out = jobs.format_leads(listing(spark, ROWS), "nz_nails").collect()
    assert out[0].__fields__ == list(TEMPLATE)
    assert [(r["No."], r["Công ty"], r["Email"], r["SĐT"]) for r in out] == [(1, "bella  nails!", "info@b.nz", "'+64 9 2"), (2, "Other", "x@gmail.com", "'021")]


#: Per variant: phone cell, how it is shown, category cell, how it is shown (None: no such column). Digits lose their prefix, or phones keep
#: what is there behind one apostrophe; a category is translated, kept, one of its kind, or the lead's tier.
CELLS = {
    "nz_nails": (" +64 9 1 ", "'+64 9 1", "Nail salon", None),
    "au_barbers": ("''+61 2 9", "''+61 2 9", " Barber shop ", " Barber shop "),
    "nz_barbers": ("'+64 9", "'+64 9", "Barber shop", "Barber shop"),
    "nz_farms": ("", "", "Orchard", "Orchard"),
    "au_cars": ("''+61 2 9", "'+61 2 9", " Car Factory", "Nhà máy sản xuất ô tô"),
    "au_builders": ("''+61 2 9", "'+61 2 9", " Home builder ", "Nhà thầu xây dựng nhà ở"),
    "gr_brokers": ("+30 210 1234567", "'2101234567", "Γραφείο απασχόλησης", "Văn phòng giới thiệu việc làm Hy Lạp"),
    "gr_hotels": ("0030 210 1234567", "'2101234567", "", "Khách sạn Hy Lạp"),
    "gr_farms": ("+30 210 1234567", "'2101234567", "x", "Nông lâm thủy sản Hy Lạp"),
    "gr_builders": (" ", "'", "x", "Xây dựng Hy Lạp"),
    "gr_makers": ("n/a", "'", "x", "Sản xuất Hy Lạp"),
    "lv_builders": ("+371 2", "'2", "BŪVUZŅĒMUMS", "Công ty xây dựng chung"),
    "lv_fish": ("none", "'", "Zivju ferma", "Trại cá"),
    "lv_metal": ("'+371 2", "'2", "Liela metāla darbnīca", "Xưởng gia công kim loại"),
    "lv_wood": ("+371 2", "'2", "x", "Gia công gỗ Latvia"),
    "lv_metal_members": ("+371 2", "'2", "x", "Hiệp hội Cơ khí - Gia công kim loại Latvia (MASOC)"),
    "pt_hotels": ("''+351 2", "'+351 2", "Outro ", "Outro"),
    "sk_agencies": ("+421 5", "'05", " Sprostredkovanie práce", "Môi giới việc làm"),
    "sk_factories": ("x", "'", " sklad ", " sklad "),
    "tw_builders": ("+886 2", "'02", "承包商", "Nhà thầu"),
    "tw_factories": ("+886 2", "'02", "紗廠", "Nhà máy kéo sợi"),
    "tw_jobs": ("02-1", "'021", "製造工", "COLD LEAD ❄️"),
}


@pytest.mark.parametrize("variant", sorted(FORMATTING))
def test_every_variant_formats(spark, variant):
    v = FORMATTING[variant]
    phone, shown, category, translated = CELLS[variant]
    names = dict(name=v.cells.name[0], email=v.cells.email[0], phone=v.cells.phone[0], site=v.cells.link[0], address=(*v.cells.address, "a")[0], category=(*v.cells.category, "c")[0])
    rows = [(0, "Alpha ", "joe@gmail.com info@acme.nz", phone, " a.b", "1 St ", category), (1, "Alpha", "", "", "", "", category)]
    out = jobs.format_leads(spark.createDataFrame(rows, "row_id long, " + ", ".join(f"`{n}` string" for n in names.values())), variant)
    n = len(TEMPLATE) + v.latin + v.category + bool(v.cells.broker)
    assert len(out.columns) == n and n in (19, 20, 21)
    (r,) = out.collect()
    as_is = v.cells.take == "first"
    address = ("1 St " if as_is else "1 St") if v.cells.address else ""
    assert (r["No."], r["Công ty"], r["Email"], r["SĐT"]) == (1, "Alpha " if as_is else "Alpha", "info@acme.nz", shown)
    assert (r["Liên Hệ"], r["Địa chỉ"]) == (" a.b" if as_is else "a.b", address)
    assert (r["Category"] if v.category else None) == translated
    assert r["Chức danh"] == ("Lao động sản xuất / Chế tạo" if variant == "tw_jobs" else "")


@pytest.mark.parametrize("variant", [n for n, v in FORMATTING.items() if v.cells.take == "filled" and v.cells.category])
def test_second_columns(spark, variant):
    """Each cell from a further column where the first is blank; a site may be named in the company column, but only brokers show it."""
    names = ["Name", "Công ty", "Email", "Category", "Liên Hệ mail", "Phone", "SĐT", "Website", "Liên Hệ", "Address", "Địa chỉ"]
    rows = [(0, " ", " Firm", "", "", "a@b.lv", " ", "5", "", "l.lv", None, "A 1"), (1, "Firm", "", " ", "x", "c@b.lv", "7", "", "", "", "", "")]
    (r,) = jobs.format_leads(spark.createDataFrame(rows, "row_id long, " + ", ".join(f"`{n}` string" for n in names)), variant).collect()
    site = "Firm" if variant == "gr_brokers" else "l.lv"
    assert (r["Công ty"], r["Email"], r["SĐT"], r["Liên Hệ"], r["Địa chỉ"]) == ("Firm", "a@b.lv", "'5", site, "A 1")


def test_registry_rows_by_their_english_name(spark):
    rows = [(0, "", "Acme Ltd", "1", "a@acme.gr"), (1, None, "Acme ltd.", "", ""), (2, "Ωμέγα", "Omega", "2", ""), (3, "", "", "3", "x@y.gr"), (4, " ", "Lost", "4", "")]
    df = spark.createDataFrame(rows, "row_id long, `Tên công ty` string, `Tên tiếng Anh` string, `Điện thoại` string, Email string")
    for variant in ("gr_farms", "gr_builders", "gr_makers"):
        assert [(r["Công ty"], r["Email"]) for r in jobs.format_leads(df, variant).collect()] == [("Acme Ltd", "a@acme.gr"), ("Ωμέγα", "")]


def test_job_rows_clash_by_the_brokers_phone(spark):
    rows = [(0, "甲", "不顯示", "02-1", "", "HOT LEAD 🔥 "), (1, "乙", "", "021", "", ""), (2, "丙", "5E+3", "03", "", "x"), (3, "丁", "", "", "", "x"), (4, "戊", "53", "9", "", "x")]
    df = spark.createDataFrame(rows, "row_id long, `Tên chủ sử dụng` string, `SĐT chủ` string, `SĐT môi giới` string, `Email liên hệ` string, `Xếp loại Lead` string")
    got = [(r["Công ty"], r["SĐT"], r["SĐT môi giới"], r["Category"]) for r in jobs.format_leads(df, "tw_jobs").collect()]
    assert got == [("甲", "", "'021", "HOT LEAD 🔥"), ("丙", "", "'03", "x"), ("丁", "", "", "x")]


def test_no_lead_from_an_empty_table(spark):
    for variant in FORMATTING:
        assert jobs.format_leads(spark.createDataFrame([], "row_id long, x string"), variant).schema.names[0] == "No."


def test_a_constant_category_needs_no_column(spark):
    df = spark.createDataFrame([], 'row_id long, `Tên công ty` string, Email string')
    assert "Category" in jobs.format_leads(df, "gr_farms").columns and jobs.format_leads(df, "gr_farms").count() == 0


@pytest.mark.parametrize("variant", ["au_cars", "gr_hotels", "gr_brokers", "sk_agencies", "tw_builders"])
def test_listing_variants(spark, variant):
    v = LISTINGS[variant]
    address = {"au_loose": "1 King St, Perth, WA 6000, Australia", "gr": "Odos 1, Patra 262 21, Greece", "sk": "Ulica 1, 811 01 Bratislava, Slovakia", "tw": "100 台灣台北市中正區路1號"}[v.place]
    first = v.categories[0]
    rows = [("a", first), ("b", ""), ("c", "zzz"), ("d", f"x {first}")]
    df = spark.createDataFrame([(n, address, "u", "", c) for n, c in rows], "Name string, Address string, URL string, State string, Category string")
    got = {r.Name for r in jobs.check_listings(df, v.place, variant).collect()}
    assert got == {"a"} | ({"b"} if v.blank else set()) | ({"d"} if v.contains else set())


def test_searches_and_registry(spark, tmp_path):
    grid = spark.createDataFrame([(0, "NSW", "O'Hara", -33.0, 151.0, 13, ["x"])], "id int, state string, name string, lat double, lng double, zoom int, covered array<string>")
    tables.write_dimension(grid, str(tmp_path / "d"))
    at = tables.read_locations(spark, str(tmp_path / "d"))
    done = spark.createDataFrame([], "location string, state string, keyword string")
    (r,) = jobs.searches(at, "au_nails", done).collect()
    assert r.Search_Query == "nail salon in O'Hara, NSW, Australia" and r.search_url.endswith("/nail+salon/@-33.0,151.0,13z?hl=en")
    assert jobs.searches(at, "au_nails", spark.createDataFrame([("o'hara", "nsw", "nail salon")], done.schema)).count() == 0
    links = spark.createDataFrame([("A", "/1"), ("B", "/2")], "name string, href string")
    rows, left = jobs.registry_rows(links, spark.createDataFrame([("/1", "5")], "href string, phone string"))
    assert [(r.name, r.phone) for r in rows.collect()] == [("A", "5")] and [r.name for r in left.collect()] == ["B"]


def test_books_from_any_store_and_tier_colours(spark, tmp_path):
    rows = iter([("1", "a", "HOT"), ("2", "b", "WARM lead"), ("3", "c", "x")])
    xlsx.write_book(str(tmp_path / "b.xlsx"), "Leads", ["no", "name", "tier"], rows, "tier")
    got = xlsx.read_books(spark, f"file://{tmp_path}/*.xlsx", "Leads", 2, (2, 3)).collect()
    assert sorted(tuple(r) for r in got) == [("a", "HOT"), ("b", "WARM lead"), ("c", "x")]
    with zipfile.ZipFile(tmp_path / "b.xlsx") as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert [sheet.count(f's="{k}"') for k in (1, 2, 3, 4)] == [3, 2, 2, 2]
    with pytest.raises(ValueError, match="read_books"):
        xlsx._local("s3a://x/y")


@pytest.mark.parametrize("variant", sorted(CLEANING))
def test_every_variant_cleans(spark, variant):
    c = CLEANING[variant]
    rows = [(i, "n", "w", "1", "", "", "", v, "", "") for i, v in enumerate([*c.values[:1], "", "zzz"])]
    kept = {r.Category for r in jobs.clean(listing(spark, rows), variant).collect()}
    assert kept == ({*c.values[:1]} | ({""} if c.blank else set()) if c.values else {"", "zzz"})


def test_employers_and_listings(spark):
    rows = spark.createDataFrame([(1, "1", "無限制", "5", "", "02", "x"), (2, "2", "越南", "60", "a@b.c", "", "製造工")], ["row_id", "No.", "Quốc tịch mong muốn", "Số lượng tuyển (Quota)", "Email liên hệ", "SĐT môi giới", "Ngành nghề"])
    out = jobs.score_employers(rows).collect()
    assert [(r["No."], r["Điểm đánh giá"]) for r in out] == [(1, 115), (2, 10)]
    urls = [("A", "1 King St, Newtown NSW 2042", "x!3d-33.8!4d151.2", ""), ("B", "1 King St, Newtown NSW 2042", "x!3d33.8!4d151.2", ""), ("", "Perth, Australia", "x", ""), ("C", "Paris", "x", "")]
    got = jobs.check_listings(spark.createDataFrame(urls, "Name string, Address string, URL string, State string"), "au").collect()
    assert [(r.Name, r.suburb, r.state, r.postcode) for r in got] == [("A", "Newtown", "NSW", "2042")]


def test_location_grid(spark):
    rows = [(0, "o'hara", "NSW", "-33.0", "151.0"), (1, "near", "NSW", "-33.01", "151.0"), (2, "off", "NSW", "40", "151"), (3, "bad", "NSW", "x", "151")]
    out = jobs.location_grid(spark.createDataFrame(rows, "id int, name string, state string, lat string, lng string"), "au").collect()
    assert [(r.name, r.covered, r.zoom) for r in out] == [("O'Hara", ["O'Hara", "Near"], 13)]


def test_page_emails(spark):
    html = "<a href='mailto:b@x.yz'>m</a> a@x.yz <a href=https://facebook.com/p>f</a> info&#64;acme.nz <span>d</span>@x.yz<script>'<b>no@x.yz</b>'</script><!-- no@x.yz -->"
    rows = [(1, html), (2, None), (3, ""), (4, "<p>q@x.yz" * 3), (5, '<a href="never closed q@x.yz')]
    got = {r.page_id: r for r in jobs.page_emails(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert (got[1].email, got[1].facebook, got[1].instagram) == ("a@x.yz, b@x.yz, d@x.yz, info@acme.nz", ["https://facebook.com/p"], [])
    assert [got[k].email for k in (2, 3, 4, 5)] == ["", "", "q@x.yz", ""]


def test_page_tables(spark, tmp_path):
    value = '<span class="flextable__value">{}</span>'
    row = '<div class="flextable__row"><a class="public_list__link" href="{}">{}</a><div data-column-header-name="Statuss">' + value + "</div></div>"
    pages = spark.createDataFrame([(1, row.format("/1", "Acme", "x") + row.format("/2", "Beta", "y")), (2, row.format("/3", "Acme", "z"))], "page_id int, html string")
    assert {(r.name, r.href, r.status) for r in fetched.register_list(pages).collect()} == {("Acme", "/1", "x"), ("Beta", "/2", "y")}
    cell = '<div class="wizardform__preview_row"><div class="wizardform__preview_label">{}</div><div class="wizardform__preview_value">{}</div></div>'
    html = cell.format("Tālruņa numurs", "1") + cell.format("Tālruņa numurs", "2") + cell.format("Faktiskā adrese", "Rīga")
    (d,) = fetched.register_details(spark.createDataFrame([("/1", html)], "href string, html string").coalesce(1)).collect()
    assert (d.phone, d.email, d.actual_address) == ("2", "", "Rīga")
    table = "<table><tr>" + "<td>a\nb</td>" * 11 + "<td><a href='/x'>l</a></td></tr><tr>" + "<td>c</td>" * 11 + "<td><a href='/done'>l</a></td></tr><tr><td>short</td></tr></table>"
    done = spark.createDataFrame([("/done",)], "url string")
    (r,) = fetched.employer_rows(spark.createDataFrame([(1, table)], "page_id int, html string"), done).collect()
    assert r.link == "/x" and r.cells[0] == "a  b"
    links = '<a href="/company/12/x">A</a><a href="/other">o</a><a href="/company/12/x">B</a>'
    assert [tuple(r) for r in fetched.company_links(spark.createDataFrame([(1, links)], "page_id int, html string")).collect()] == [("A", "/company/12/x", "12")]
    (tmp_path / "there.csv").write_text("x")
    assert fetched.first_existing(spark, f"file://{tmp_path}/no.csv", f"file://{tmp_path}/there.csv").endswith("there.csv")
    assert spark.createDataFrame([("E-mail: a@b.c\n x",)], "t string").select(fetched.labelled(F.col("t"), "E-mail").alias("x")).first().x == "a@b.c"


def test_resume(spark, tmp_path):
    src, schema = tmp_path / "in", "k long, v string"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], schema).write.parquet(str(src))
    for _ in range(2):
        resume.run_new(spark, str(src), schema, "k", str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
    spark.createDataFrame([(2, "d"), (3, "e")], schema).write.mode("append").parquet(str(src))
    resume.run_new(spark, str(src), schema, "k", str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 200 and set(e.oracle_sql()) <= set(e.queries())


def test_rows_of_one_file_are_worked_on_by_many_tasks(spark, sf):
    from harrow.plans import job_queries, lead_queries, queries

    assert queries.t(spark, sf, "customer").rdd.getNumPartitions() > 1
    assert job_queries._made(spark, sf, x="n").rdd.getNumPartitions() > 1
    assert lead_queries.clean_variants(spark, sf).count() > 0


def test_pages_reach_workers_in_small_batches(spark, sf):
    from harrow.plans import queries

    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    queries.t(spark, sf, "pages")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 500
