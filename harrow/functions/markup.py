"""Pages as a reader sees them: title, visible text and links of raw HTML, in one pass over each page.

The scanner knows tags, quoted, unquoted and missing attribute values, comments, raw text (script, style) and character
references. It moves forward only: a tag or quote that never closes ends the page there, as it does in a browser. Pages come and go in Arrow
batches; everything after the scan (addresses, hosts, priorities) is column expressions.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose text nobody sees, elements whose text isn't markup, and elements that don't break a line.
UNSEEN = frozenset(("script", "style", "template", "noscript", "title", "iframe", "object", "textarea", "select", "svg"))
RAW = frozenset(("script", "style", "title", "textarea", "iframe", "noscript"))
INLINE = frozenset(
    ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "s", "samp", "small",
     "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr")
)

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_SPACE = re.compile(r"[\s/]*")
_KEY = re.compile(r"=?[^\s/>=]*")
_IS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_BREAKS = re.compile(r" ?\n[ \n]*")

PAGE = "title string, text string, links array<struct<href:string,label:string>>"


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """(attributes, where the tag ends) from after a tag's name; -1 if it never does. The first of equal names counts."""
    found: dict[str, str] = {}
    while True:
        at = _SPACE.match(page, at).end()
        if at >= len(page):
            return found, -1
        if page[at] == ">":
            return found, at + 1
        key = _KEY.match(page, at)
        at, value = key.end(), ""
        if has := _IS.match(page, at):
            at = has.end()
            if page[at : at + 1] in ("'", '"') and at < len(page):
                end = page.find(page[at], at + 1)
                if end < 0:
                    return found, -1
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare.group(), bare.end()
        found.setdefault(key.group().lower(), unescape(value))


def _squeezed(parts: list[str]) -> str:
    return _BREAKS.sub("\n", _BLANKS.sub(" ", "".join(parts))).strip()


def scan(page: str | None) -> tuple[str, str, list[tuple[str, str]]]:
    """(title, visible text, [(href, label)]) of a page; a missing page is an empty one.

    Links are anchors with an href, in page order, their label the visible text up to the anchor's end or the next anchor. Blanks are
    squeezed; blocks and line breaks give a line break, inline elements nothing.
    """
    page = page or ""
    title, seen, links = "", [], []
    hidden, depth = "", 0  # the outermost element whose text nobody sees, and how many of its kind are open
    opened: tuple[int, str] | None = None  # where the open anchor's text starts in seen, and its href
    at = 0

    def close() -> None:
        nonlocal opened
        if opened:
            links.append((opened[1], " ".join(_squeezed(seen[opened[0] :]).split())))
            opened = None

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            lt = len(page)
        if lt > at and not hidden:
            seen.append(unescape(page[at:lt]).replace("\n", " "))
        if lt == len(page):
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = len(page) if end < 0 else end + 3
            continue
        closing = page.startswith("/", lt + 1)
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            if page[lt + 1 : lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                at = len(page) if end < 0 else end + 1
            else:  # a lone "<" is text
                if not hidden:
                    seen.append("<")
                at = lt + 1
            continue
        tag = name.group().lower()
        own, at = _attributes(page, name.end())
        if at < 0:
            break
        if closing:
            if tag == hidden:
                depth -= 1
                hidden = hidden if depth else ""
            elif tag == "a" and not hidden:
                close()
            if not hidden and tag not in INLINE:
                seen.append("\n")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            stop = end.start() if end else len(page)
            if tag == "title" and not title:
                title = " ".join(unescape(page[at:stop]).split())
            at = stop
        if tag == hidden or (not hidden and tag in UNSEEN):
            hidden, depth = tag, depth + 1
        elif not hidden:
            if tag == "a" and "href" in own:
                close()
                opened = (len(seen), own["href"])
            if tag not in INLINE:
                seen.append("\n")
    close()
    return title, _squeezed(seen), links


def _scanned(pages: pd.Series) -> pd.DataFrame:
    rows = [scan(p) for p in pages]
    return pd.DataFrame(
        {"title": [r[0] for r in rows], "text": [r[1] for r in rows], "links": [[{"href": h, "label": x} for h, x in r[2]] for r in rows]}, columns=["title", "text", "links"]
    )


def parsed(html: Column) -> Column:
    """struct(title, text, links array of struct(href, label)) of a page; see scan()."""
    return F.pandas_udf(_scanned, PAGE)(html)


def _linked(pages: pd.Series) -> pd.Series:
    return pd.Series([[{"href": h, "label": x} for h, x in scan(p)[2]] for p in pages], dtype=object)


def linked(html: Column) -> Column:
    """The links of a page alone; see scan()."""
    return F.pandas_udf(_linked, "array<struct<href:string,label:string>>")(html)
