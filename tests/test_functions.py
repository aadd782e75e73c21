"""Cell-level rules on hand-made cases."""

import pytest
from harrow.functions import documents, emails, places, text, web
from pyspark.sql import functions as F


def one(spark, make, *cells):
    df = spark.createDataFrame([cells], ", ".join(f"c{i} string" for i in range(len(cells))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(cells))]).alias("x")).first().x


@pytest.mark.parametrize(
    "cell, want",
    [
        ("jane@gmail.com, info@acme.nz", "info@acme.nz"), ("ab@x.nz cd@y.nz", "ab@x.nz"), ("noreply@acme.nz joe@gmail.com", "joe@gmail.com"),
        ("no address here", ""), ("", ""), (None, ""),
    ],
)
def test_best_email(spark, cell, want):
    assert one(spark, emails.best, cell) == want


@pytest.mark.parametrize(
    "cell, registry, broker",
    [("info@chamber.gr;bob@otenet.gr", "bob@otenet.gr", "bob@otenet.gr"), ("info@chamber.gr", "", ""), ("gemi@acme.gr", "", "gemi@acme.gr")],
)
def test_discarding_rules(spark, cell, registry, broker):
    pre = ("info", "office")
    assert one(spark, lambda c: emails.best(c, emails.Rules.registry(pre)), cell) == registry
    assert one(spark, lambda c: emails.best(c, emails.Rules.broker(pre)), cell) == broker


def test_extract(spark):
    assert one(spark, emails.extract, "Mail INFO@Ex.COM or logo@2x.png") == ["info@ex.com"]
    assert one(spark, emails.extract, "λinfo@x.gr") == []
    assert one(spark, emails.extract, None) == []
    assert one(spark, lambda c: emails.mailto(F.transform(web.anchors(c), lambda a: a["href"])), '<a href="mailto:A@b.cd?subject=x">') == ["a@b.cd"]


@pytest.mark.parametrize(
    "cell, rule, want",
    [
        ("+64 9 123 4567", "nz", "091234567"), ("+61 2 9999 0000", "au", "0299990000"), ("+61 2 9999 0000", "au_bare", "299990000"),
        ("+30 210 1234567", "gr", "2101234567"), ("3012345678", "gr", "3012345678"), ("0030 210 1234567", "gr", "2101234567"), ("+371 2012", "lv", "2012"),
        ("+351 21", "pt", "21"), ("+421 9", "sk", "09"), ("+886 2", "tw", "02"), (None, "nz", ""),
    ],
)
def test_phone_keys(spark, cell, rule, want):
    assert one(spark, lambda c: text.phone_key(c, rule), cell) == want


def test_phone_cells(spark):
    assert [one(spark, text.phone_quoted, c) for c in ("''021", "021", " ", None)] == ["'021", "'021", "", ""]
    assert [one(spark, text.phone_prefixed, c) for c in ("'021", "021", "")] == ["'021", "'021", ""]
    assert [one(spark, text.phone_hidden, c) for c in ("不顯示", "8.8E+11", "02", "")] == [True, True, False, True]


@pytest.mark.parametrize("cell, want", [("HTTPS://www.Acme.com/", "acme.com"), ("http://https://a.b", "https://a.b"), ("a.com//", "a.com/"), (None, "")])
def test_website_key(spark, cell, want):
    assert one(spark, text.website_key, cell) == want


def test_names(spark):
    assert one(spark, text.name_key, "Bella  Nails & Spa!") == "bella nails spa"
    assert one(spark, text.name_key, "美甲店") == ""
    assert one(spark, lambda c: text.name_key(c, "compact"), "大同(股)-公司") == "大同股公司"
    assert one(spark, lambda c: text.name_key(c, "greek"), "Αθήνα Α.Ε. 1") == "αθήνα αε 1"
    assert one(spark, text.company_key, 'SIA "Alfa Fish"') == "alfafish"
    assert one(spark, text.title_case, "o'connor-SMITH bay") == "O'Connor-Smith Bay"
    assert one(spark, text.search_query, ' „Alfa”  SIA ') == "Alfa SIA, Latvia"


@pytest.mark.parametrize("cell, want", [("Αθήνα", "Athina"), ("ουι", "oui"), ("Ψ", "PS"), ("Αίγινα", "Aigina"), ("ΆΓΓΕΛΟΣ x", "ANGELOS x"), ("Ού", "Ou"), (None, "")])
def test_to_latin(spark, cell, want):
    assert one(spark, text.to_latin, cell) == want


def test_numbers(spark):
    assert [one(spark, text.number, c) for c in ("4.5", "5,0", "abc", "", None, "1d", "-2e1")] == [4.5, 0.0, 0.0, 0.0, 0.0, 0.0, -20.0]
    assert [one(spark, text.first_integer, c) for c in ("1,234 reviews", "none", None)] == [1234, 0, 0]
    assert one(spark, text.first_filled, " ", None, " x ") == "x"


def test_links(spark):
    url = "https://M/p/1s0xAB:0xCD!8m2!3d-33.8!4d151.2?hl=en"
    assert one(spark, places.place_key, url) == "0xab:0xcd" and tuple(one(spark, places.link_coordinates, url)) == (-33.8, 151.2)
    assert one(spark, places.place_key, "https://M/p?x=1") == "https://m/p" and one(spark, places.link_coordinates, "https://M/p?x=1") is None
    assert tuple(one(spark, places.link_coordinates, "x@1.5,2.5,9z")) == (1.5, 2.5)


@pytest.mark.parametrize(
    "address, country, inside, want",
    [
        ("1 King St, Newtown NSW 2042, Australia", "au", True, ("Newtown", "NSW", "2042")),
        ("1 King St, Newtown NSW 2042, Australia", "au_loose", True, ("1 King St", "", "")),
        ("1 King St, Newtown, nsw 2042", "au_loose", True, ("Newtown", "NSW", "2042")),
        ("Brīvības 1, Rīga, LV-1010", "lv", True, ("Rīga", "LV", "LV-1010")), ("Brīvības 1, Rīga 1010", "lv", True, ("Rīga", "LV", "LV-1010")),
        ("5 Queen St, Auckland 1010, New Zealand", "nz", True, ("Auckland", "NZ", "1010")), ("somewhere", "nz", False, ("somewhere", "NZ", "")),
        ("Ερμού 1, Αθήνα 104 31, Ελλάδα", "gr", True, ("Αθήνα", "GR", "104 31")), ("Rua A, Lisboa, 1000-001, Portugal", "pt", True, ("Lisboa", "PT", "1000-001")),
        ("Hlavná 1, 811 07 Bratislava", "sk", True, ("Bratislava", "Bratislava", "811 07")), ("台北市中正區 100", "tw", True, ("台北市中正區", "台北市", "100")),
        ("", "au", False, (None, None, None)), (None, "gr", False, (None, None, None)), ("Main Rd 7", "au", False, (None, None, None)),
    ],
)
def test_addresses(spark, address, country, inside, want):
    assert bool(one(spark, lambda c: places.in_country(c, country), address)) is inside
    got = tuple(one(spark, lambda c: places.parse_address(c, country), address))
    assert got == want or (country == "tw" and got[1:] == want[1:])


def test_house_number_of_five_digits_is_no_postcode(spark):
    for address, post in (("Ulica 10003, 811 04 Bratislava, Slovakia", "811 04"), ("Ulica 10003, 81104 Bratislava", "81104"), ("Hlavná 5, Bratislava", "")):
        assert one(spark, lambda c: places.parse_address(c, "sk"), address).postcode == post


def test_key_search(spark):
    doc = '{"contact":{"email":"a@b.c"},"emails":["x@y.z",{"mail":"q@r.s"}],"mailbox":{"email":"n@o.p"}}'
    assert one(spark, lambda c: documents.values_by_key(c, ("email", "mail")), doc) == ["a@b.c", "q@r.s", "x@y.z"]
    assert one(spark, lambda c: documents.values_by_key(c, ("k",)), "not json") == []


def test_html(spark):
    page = '<title>T</title><p>a <b>b</b></p><a href="/contact">Us</a><a href="https://m.facebook.com/x">f</a><a href="https://www.facebook.com/sharer?x">s</a>'
    assert one(spark, web.title, page) == "T" and one(spark, web.strip_tags, page).startswith("T a b Us")
    links = one(spark, web.anchors, page)
    assert [x.href for x in links] == ["/contact", "https://m.facebook.com/x", "https://www.facebook.com/sharer?x"]
    assert [one(spark, web.is_facebook, x.href) for x in links] == [False, True, False]
    assert one(spark, web.social_url, "m.facebook.com/x") == "https://www.facebook.com/x"
    assert [one(spark, web.link_priority, a, b) for a, b in (("/contact", ""), ("/x", "Book now"), ("/x", "y"))] == [2, 1, 0]
    assert one(spark, web.resolve, "https://a.b/c/d", "../e#f") == "https://a.b/e"
    cards = '<ul><li itemscope itemtype="http://schema.org/Organization"><b itemprop="name"><a href="/en/members/member-database/7">Acme </a></b><i itemprop="telephone"> 1 </i></li></ul>'
    (card,) = one(spark, web.member_cards, cards)
    assert (card.name, card.member_id, card.phone, card.email) == ("Acme", "7", "1", "")


def test_html_tables(spark):
    page = (
        '<div class="flextable__row"><a class="public_list__link" href="/c/2"> Acme </a><div data-column-header-name="UR vai mītnes valsts reģistrācijas numurs">'
        '<span class="flextable__value"><span class="screen-reader-only">no</span> 400 </span></div></div><div class="flextable__row">nothing</div>'
    )
    spark.udtf.register("listed", web.ListedCompanies)
    spark.udtf.register("labelled", web.LabelledValues)
    spark.udtf.register("table_rows", web.TableRows)
    df = spark.createDataFrame([(page,)], "html string")
    df.createOrReplaceTempView("p")
    assert [tuple(r) for r in spark.sql("SELECT l.* FROM p, LATERAL listed(html) l").collect()] == [("Acme", "/c/2", "400", "Aktīvs")]
    row = '<div class="wizardform__preview_row"><div class="wizardform__preview_label">Tālruņa numurs</div><div class="wizardform__preview_value"> 1 </div></div>'
    spark.createDataFrame([(row,)], "html string").createOrReplaceTempView("d")
    assert [tuple(r) for r in spark.sql("SELECT l.label, l.value FROM d, LATERAL labelled(html) l").collect()] == [("tālruņa numurs", "1")]
    spark.createDataFrame([("<table><tr><td> a </td><td><a href='/x'>b</a></td></tr></table>",)], "html string").createOrReplaceTempView("w")
    assert [tuple(r) for r in spark.sql("SELECT r.* FROM w, LATERAL table_rows(html) r").collect()] == [(["a", "b"], "/x")]


def _seen_by_parser(page):
    """(title, text without blanks, [(href, label without blanks)]) by the standard library's parser, for well-formed pages."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__()
            self.title, self.text, self.links, self.dead, self.name = "", "", [], 0, None

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            self.name = tag
            self.dead += tag in ("script", "style", "title", "template")
            if tag == "a" and "href" in a:
                self.links.append([a["href"] or "", "", True])

        def handle_endtag(self, tag):
            self.dead -= tag in ("script", "style", "title", "template")
            if tag == "a" and self.links:
                self.links[-1][2] = False
            self.name = None

        def handle_data(self, data):
            if self.name == "title" and self.dead:
                self.title += data
            if not self.dead:
                self.text += data
                if self.links and self.links[-1][2]:
                    self.links[-1][1] += data

    p = P()
    p.feed(page)
    p.close()
    bare = lambda x: "".join(x.split())
    return " ".join(p.title.split()), bare(p.text), [(h, bare(x)) for h, x, _ in p.links]


def test_pages_as_the_parser_sees_them(spark, sf):
    import random

    from harrow.functions import markup

    rng = random.Random(3)
    bits = ["<p>", "</p>", "<b>", "</b>", "<br/>", "x y", "&amp;", "&#64;", "&eacute;", "<!-- <a href='n'> -->", "<script>if (a<b) '</p>'</script>", "<style>p{}</style>", "a@b.nz",
            "<a href='q?a=1&amp;b=2'>l</a>", '<a class="k" href="/r">m <i>n</i></a>', "<a href=s/t title='>'>o</a>", "<a>none</a>", "<A HREF = 'u'>U</A>", "<template>t</template>", "<img alt='>' src=x>"]
    pages = ["<title> A  &lt; b</title>" + "".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(300)]
    pages += [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    for page in pages:
        title, text, links = markup.scan(page)
        assert (title, "".join(text.split()), [(h, "".join(x.split())) for h, x in links]) == _seen_by_parser(page)


def test_odd_pages_take_linear_time():
    import time

    from harrow.functions import markup

    began = time.time()
    for bit in ('<a href="x', "<", "<script>", "<!--", "<a x='", "<a href=x>", "<svg>", "</svg>", "<svg></b>", "<a " + "b" * 9, "&", "< ", "<a ="):
        markup.scan(bit * 100_000)
    assert time.time() - began < 20
    assert markup.scan("a<b c='>") == ("", "a", []) and markup.scan("1 < 2 <3") == ("", "1 < 2 <3", []) and markup.scan(None) == ("", "", [])
    assert markup.scan("<a href=x>one<a href=y>two") == ("", "onetwo", [("x", "one"), ("y", "two")])
    assert markup.scan("<svg><svg>a</svg>b</svg>c<title>t</title>") == ("t", "c", [])


def test_links_resolve_as_urljoin_does(spark):
    from urllib.parse import urljoin

    bases = ("http://a.b/c/d;p?q", "https://x.y", "https://x.y/", "http://a/b/c.html#f", "http://a/b/../c/")
    hrefs = ("g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", ";x", "", "..", "../", "../g", "../..", "../../g", "../../../g", "./..", "/./g", "/../g", "g.", "..g", "./g/.", "g/./h", "g/../h",
             "http://h/i", "mailto:x@y", "a/b/../../c", "/a/b/..", "/.", " g ", "?a=/../b", "g?y/../x")
    rows = [(b, h, urljoin(b, h.strip()).split("#")[0]) for b in bases for h in hrefs]
    df = spark.createDataFrame(rows, "b string, h string, e string")
    assert [tuple(r) for r in df.withColumn("g", web.resolve(F.col("b"), F.col("h"))).where("g <> e").collect()] == []
