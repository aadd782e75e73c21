"""HTML fragments and links, as column expressions; two table functions where markup has to be parsed."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup

# Fixed values.
CONTACT_WORDS = ("contact", "about", "support", "reach", "info", "location", "salon", "find", "store")
SERVICE_WORDS = ("services", "book", "us")
FACEBOOK_REFUSED = ("share.php", "sharer.php", "facebook.com/sharer", "facebook.com/dialog", "facebook.com/plugins")
INSTAGRAM_REFUSED = ("developer", "about", "press", "directory")


def strip_tags(html: Column) -> Column:
    """Text without tags, a blank for each, blanks squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", " "), r"\s+", " "))


def title(html: Column) -> Column:
    return F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title>(.*?)</title>", 1)


def anchors(html: Column) -> Column:
    """array of struct(href, label) in page order, whatever the quoting; see markup.scan()."""
    return markup.linked(html)


def is_page_link(href: Column) -> Column:
    return (href != "") & ~F.lower(href).rlike("^(mailto:|tel:|javascript:|#)")


def link_priority(href: Column, label: Column) -> Column:
    """2 for contact-like words in the label or the address, 1 for service-like ones, else 0."""
    a, b = F.lower(F.coalesce(href, F.lit(""))), F.lower(F.coalesce(label, F.lit("")))
    hit = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(a, w) | F.contains(b, w))
    return F.when(hit(CONTACT_WORDS), 2).when(hit(SERVICE_WORDS), 1).otherwise(0)


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def _without_dots(path: Column) -> Column:
    """A path that starts with a slash less its . and .. parts; the parts are walked only where there are any."""
    parts = F.slice(F.split(path, "/"), 2, 1_000_000_000)
    up = lambda acc: F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == "..", up(acc)).when(x == ".", acc).otherwise(F.array_append(acc, x)))
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(walked, "")).otherwise(walked)
    return F.when(path.rlike(r"/\.\.?(/|\z)"), F.concat(F.lit("/"), F.array_join(open_end, "/"))).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """Absolute address of a link on a page, without fragment: relative references as RFC 3986 resolves them, by built-ins alone."""
    clean = lambda c: F.substring_index(F.btrim(F.translate(F.coalesce(c, F.lit("")), "\t\r\n", "")), "#", 1)
    b, h = clean(base), clean(href)
    root = F.regexp_extract(b, _SCHEME + r"//[^/?]*", 0)
    path = F.substring_index(F.substr(b, F.length(root) + 1), "?", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    own = F.substring_index(h, "?", 1)
    query = F.substr(h, F.length(own) + 1)
    return (
        F.when(h == "", b).when(h.rlike(_SCHEME), h).when(h.startswith("//"), F.concat(F.regexp_extract(b, _SCHEME, 0), h))
        .when(h.startswith("/"), F.concat(root, _without_dots(own), query)).when(h.startswith("?"), F.concat(root, path, h))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, own)), query))
    )


def host(url: Column) -> Column:
    """Network location of an absolute address, empty without one."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def _social(href: Column, site: str, refused: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(href, F.lit("")))
    bad = F.exists(F.array(*map(F.lit, refused)), lambda w: F.contains(low, w))
    return low.contains(site) & ~bad


def is_facebook(href: Column) -> Column:
    return _social(href, "facebook.com", FACEBOOK_REFUSED)


def is_instagram(href: Column) -> Column:
    return _social(href, "instagram.com", INSTAGRAM_REFUSED)


def with_scheme(url: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def social_url(url: Column) -> Column:
    """The address at which a social page is fetched: mobile and bare hosts of one network become its main one, a scheme is added."""
    main = lambda c, host: F.replace(c, F.lit(host), F.lit("www.facebook.com"))
    bare = url.contains("facebook.com") & ~url.contains("www.facebook.com")
    return with_scheme(F.when(url.contains("m.facebook.com"), main(url, "m.facebook.com")).when(bare, main(url, "facebook.com")).otherwise(url))


def website_kind(url: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(url, F.lit(""))))
    return F.when(low == "", "none").when(low.contains("facebook.com"), "facebook").when(low.contains("instagram.com"), "instagram").otherwise("regular")


def member_cards(html: Column) -> Column:
    """array of struct(name, member_id, website, phone, email, address) of an organisation list; nameless cards are left out."""
    cards = F.slice(F.split(F.coalesce(html, F.lit("")), r'<li\s+itemscope\s+itemtype="http://schema\.org/Organization">'), 2, 1_000_000)
    field = lambda card, prop, link=False: F.trim(
        F.regexp_extract(card, f'itemprop="{prop}"[^>]*>' + ("<a[^>]*>([^<]+)</a>" if link else "([^<]+)<"), 1)
    )
    rows = F.transform(
        cards,
        lambda c: F.struct(
            field(c, "name", True).alias("name"), F.regexp_extract(c, r'href="[^"]*/member-database/(\d+)"', 1).alias("member_id"),
            field(c, "url", True).alias("website"), field(c, "telephone").alias("phone"), field(c, "email").alias("email"), field(c, "address").alias("address"),
        ),
    )
    return F.filter(rows, lambda r: r["name"] != "")


def envelope_html(body: Column) -> Column:
    """The html member of a JSON answer, slashes unescaped."""
    return F.replace(F.get_json_object(body, "$.html"), F.lit("\\/"), F.lit("/"))


class _Cells(HTMLParser):
    """Text of elements by class, inside rows of a given class; nested rows aren't expected."""

    def __init__(self, row: str, wanted: tuple[str, ...], hidden: str = "") -> None:
        super().__init__()
        self.row, self.wanted, self.hidden = row, wanted, hidden
        self.rows: list[list[dict]] = []
        self.stack: list[tuple[str, dict | None, bool]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("br", "img", "input", "meta", "link", "hr"):
            return
        a = {k: v or "" for k, v in attrs}
        classes = a.get("class", "").split()
        if self.row in classes:
            self.rows.append([])
        cell = None
        if self.rows and any(w in classes for w in self.wanted) or "data-column-header-name" in a and self.rows:
            cell = {"class": " ".join(classes), "text": "", "href": a.get("href", ""), "column": a.get("data-column-header-name", "")}
            self.rows[-1].append(cell)
        self.stack.append((tag, cell, bool(self.hidden) and self.hidden in classes))

    def handle_endtag(self, tag: str) -> None:
        while self.stack and self.stack.pop()[0] != tag:
            pass

    def handle_data(self, data: str) -> None:
        if not any(h for _, _, h in self.stack):
            for _, cell, _ in self.stack:
                if cell is not None:
                    cell["text"] += data


@F.udtf(returnType="name string, href string, reg_no string, status string")
class ListedCompanies:
    """Rows of a register's list page: a link with the name, registration number and status (active if not shown)."""

    def eval(self, html: str) -> Iterator[tuple]:
        p = _Cells("flextable__row", ("public_list__link", "flextable__value"), "screen-reader-only")
        p.feed(html or "")
        for row in p.rows:
            link = next((c for c in row if "public_list__link" in c["class"]), None)
            if link is None:
                continue
            by, column = {}, ""
            for c in row:
                column = c["column"] or column
                if "flextable__value" in c["class"]:
                    by.setdefault(column, c["text"].strip())
            yield link["text"].strip(), link["href"], by.get("UR vai mītnes valsts reģistrācijas numurs", ""), by.get("Statuss", "Aktīvs")


@F.udtf(returnType="label string, value string, at int")
class LabelledValues:
    """Label and value of each preview row of a detail page, and the row's place."""

    def eval(self, html: str) -> Iterator[tuple]:
        p = _Cells("wizardform__preview_row", ("wizardform__preview_label", "wizardform__preview_value"))
        p.feed(html or "")
        for at, row in enumerate(p.rows):
            label = next((c["text"] for c in row if "preview_label" in c["class"]), None)
            value = next((c["text"] for c in row if "preview_value" in c["class"]), None)
            if label is not None and value is not None:
                yield label.strip().lower(), value.strip(), at


#: Field of a detail page and the words its label holds (fixed values); of several rows for one field the last counts.
DETAIL_LABELS = {
    "phone": ("tālruņa numurs",), "email": ("elektroniskā pasta adrese",), "legal_address": ("juridiskā adrese",), "actual_address": ("faktiskā", "korespondences"),
}


@F.udtf(returnType="cells array<string>, link string")
class TableRows:
    """Rows of an HTML table: trimmed cell texts and the first link."""

    def eval(self, html: str) -> Iterator[tuple]:
        class Rows(HTMLParser):
            def __init__(self) -> None:
                super().__init__()
                self.rows, self.open = [], False

            def handle_starttag(self, tag: str, attrs: list) -> None:
                if tag == "tr":
                    self.rows.append([[], ""])
                elif tag in ("td", "th") and self.rows:
                    self.rows[-1][0].append("")
                    self.open = True
                elif tag == "a" and self.rows and not self.rows[-1][1]:
                    self.rows[-1][1] = dict(attrs).get("href") or ""

            def handle_endtag(self, tag: str) -> None:
                if tag in ("td", "th"):
                    self.open = False

            def handle_data(self, data: str) -> None:
                if self.open:
                    self.rows[-1][0][-1] += data

        p = Rows()
        p.feed(html or "")
        for cells, link in p.rows:
            yield [c.strip() for c in cells], link
