"""Row predicates that jobs share."""

from __future__ import annotations

from harrow.functions.text import blank
from pyspark.sql import Column
from pyspark.sql import functions as F

# Address classes that aren't places, and administrative feature codes.
NOT_PLACES = ("post office", "po box", "lvr", "large volume")
ADMIN_CODES = ("ADM2", "ADM3")


def is_place(category: Column) -> Column:
    """Not a post box or a large-volume receiver."""
    low = F.lower(blank(category))
    out = F.lit(True)
    for w in NOT_PLACES:
        out = out & ~low.contains(w)
    return out


def is_admin_area(code: Column) -> Column:
    return blank(code).isin(*ADMIN_CODES)


def needs_category(category: Column, url: Column) -> Column:
    """A row to repair: no category, but a link to look it up at."""
    return (F.trim(blank(category)) == "") & (F.trim(blank(url)) != "")


def same_name(a: Column, b: Column) -> Column:
    """One name contains the other, whatever the case."""
    x, y = F.lower(blank(a)), F.lower(blank(b))
    return F.contains(x, y) | F.contains(y, x)


def has_cells(cells: Column, least: int = 11) -> Column:
    return F.size(cells) >= least


def still_open(flag: Column) -> Column:
    """Not marked as permanently closed."""
    return F.lower(F.trim(blank(flag))) != "yes"
