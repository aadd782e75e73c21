"""Joins: grids without finished work, last-wins sync, lookups, ranges, and containment."""

from __future__ import annotations

from harrow.functions.text import stripped
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def open_grid(locations: DataFrame, keywords: DataFrame, done: DataFrame, keys: list[str], parts: int = 64) -> DataFrame:
    """Every location with every keyword, less the finished ones, compared in lower case.

    The grid of the two dimensions is a product by nature. Locations are dealt to `parts` keys, each of which has all keywords,
    so that it is a hash join without a key that holds everything; Spark broadcasts a side where its size allows it.
    """
    part = F.pmod(F.xxhash64(*locations.columns), F.lit(parts))
    every = keywords.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
    grid = locations.withColumn("_part", part).join(every, "_part").drop("_part")
    low = [F.lower(F.trim(F.col(k))).alias(f"_{k}") for k in keys]
    finished = done.select(*low).distinct()
    return grid.select("*", *low).join(finished, [f"_{k}" for k in keys], "left_anti").drop(*[f"_{k}" for k in keys])


def finished_from_output(rows: DataFrame, keywords: list[str], query: str = "Search_Query") -> DataFrame:
    """Finished (location, state, keyword) triples read off an output table: the first keyword inside the query, else the first."""
    low = F.lower(F.col(query))
    word = F.coalesce(*[F.when(low.contains(k.lower()), F.lit(k)) for k in keywords], F.lit(keywords[0]))
    return rows.select(*[F.lower(F.trim(c)).alias(n) for c, n in ((F.col("Location_Name"), "location"), (F.col("State"), "state"), (word, "keyword"))]).distinct()


def sync_last(base: DataFrame, updates: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """base with `value` taken from the last update of its key, where there is one that isn't blank."""
    last = updates.groupBy(key).agg(F.max(F.struct(order, value)).alias("_u")).select(key, F.col(f"_u.{value}").alias("_v"))
    kept = F.coalesce(F.nullif(F.col("_v"), F.lit("")), F.col(value)) if value in base.columns else F.col("_v")
    return base.join(last, key, "left").withColumn(value, kept).drop("_v")


def still_to_do(base: DataFrame, processed: DataFrame, key: str, retry: Column | None = None) -> DataFrame:
    """Rows whose key isn't processed; `retry` marks processed rows that count as open all the same."""
    done = processed.where(~retry) if retry is not None else processed
    return base.join(done.select(key).distinct(), key, "left_anti")


def translate(
    df: DataFrame, column: str, table: dict[str, str], out: str, *, lower: bool = False, default: str | None = None, suffix: str = "", as_is: bool = False
) -> DataFrame:
    """Exact lookup of a cell, blanks at its ends aside, in a small fixed table; without a hit the cell itself, without that the default.

    as_is: a cell that isn't found keeps the blanks at its ends. The suffix goes to whatever isn't empty.
    """
    key = stripped(F.col(column))
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    hit = F.try_element_at(pairs, F.lower(key) if lower else key)
    text = F.coalesce(hit, F.nullif(F.col(column) if as_is else key, F.lit("")), F.lit(default if default is not None else ""))
    return df.withColumn(out, F.when(text != "", F.concat(text, F.lit(suffix))).otherwise(text))


def translate_first(column: Column, table: dict[str, str], default: str) -> Column:
    """The translation of the first entry, in table order, that the cell contains."""
    low = F.lower(F.coalesce(column, F.lit("")))
    return F.coalesce(*[F.when(low.contains(k), F.lit(v)) for k, v in table.items()], F.lit(default))


def allowed(column: Column, values: tuple[str, ...], *, contains: bool = False, lower: bool = True, blank: bool = True) -> Column:
    """Category predicate: equal to or containing a listed value; whether a blank cell passes."""
    cell = stripped(column)
    cell = F.lower(cell) if lower else cell
    hit = F.exists(F.array(*map(F.lit, values)), lambda v: F.contains(cell, v)) if contains else cell.isin(*values)
    return ((cell == "") | hit) if blank else ((cell != "") & hit)


def in_ranges(df: DataFrame, value: Column, ranges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows whose value lies in some range lo..hi of the table, of the same `by` columns if given.

    An equi-join on `by` and on stretches of the average range's width, to which a range is dealt, then the exact test.
    """
    width = ranges.agg(F.ceil(F.avg(F.col("hi") - F.col("lo") + 1)).cast("long")).first()[0] or 1
    cell = lambda c: F.floor(c / F.lit(max(1, width))).cast("long")
    dealt = ranges.where("lo <= hi").withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    x = df.withColumn("_v", value)
    x = x.withColumn("_cell", cell(F.col("_v")))
    on = (x["_cell"] == dealt["_cell"]) & (x["_v"] >= dealt["lo"]) & (x["_v"] <= dealt["hi"])
    for c in by or []:
        on = on & (x[c] == dealt[c])
    return x.join(dealt, on, "left_semi").drop("_v", "_cell")


def without_contained(names: DataFrame, known: DataFrame, key: str, pieces: tuple[int, ...] = (1, 2, 3, 6, 12)) -> DataFrame:
    """Names that no known name contains, equals or is contained in; a blank name counts as found if anything is known.

    Containment implies that all pieces of the shorter name stand in the longer one. So each name is blocked by one piece of its own, of
    the longest length of `pieces` (from 1 on) that it has, and of those by the one that is rarest on the other side; only such candidates are
    compared. A short piece is many names' key only where many names are that short.
    """
    a, b = names.select(F.col(key).alias("a")).where("a <> ''").distinct(), known.select(F.col(key).alias("b")).where("b <> ''").distinct()

    def grams(df: DataFrame, c: str, n: int) -> DataFrame:
        at = F.sequence(F.lit(1), F.length(c) - (n - 1))
        return df.where(F.length(c) >= n).select(c, F.explode(F.array_distinct(F.transform(at, lambda i: F.substring(F.col(c), i, n)))).alias("g"))

    def inside(short: DataFrame, s: str, long: DataFrame, t: str) -> DataFrame:
        """short names that stand inside some long one."""
        found = None
        for n, longer in zip(pieces, (*pieces[1:], None), strict=True):
            own = short.where((F.length(s) >= n) & (F.length(s) < longer if longer else F.lit(True)))
            lg = grams(long, t, n)
            freq = lg.groupBy("g").count()
            one = grams(own, s, n).join(freq, "g", "left").groupBy(s).agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "g")).alias("m"))
            hits = one.where("m.n > 0").select(s, F.col("m.g").alias("g")).join(lg, "g").where(F.contains(F.col(t), F.col(s))).select(s, t)
            found = hits if found is None else found.unionByName(hits)
        return found

    hit = inside(a, "a", b, "b").select("a").union(inside(b, "b", a, "a").select("a")).distinct()
    some = b.limit(1).select(F.lit("").alias("a"))
    return names.join(hit.union(some), names[key] == F.col("a"), "left_anti")


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key by `order`, kept by partial aggregation, so no key is sorted as a whole."""
    rest = [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(F.min(F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), F.struct(*rest).alias("v"))).alias("_m"))
    return one.select(*[F.col(key) if c == key else F.col(f"_m.v.{c}").alias(c) for c in df.columns])


def repair_blanks(rows: DataFrame, found: DataFrame, key: str, column: str, mark: str = "·") -> DataFrame:
    """rows whose blank `column` is taken from found(key, column) where they have a key: the first value, by text, that isn't blank.

    Values lose `mark` and blanks around them; cells that are filled stay as they are, so do rows without a value.
    """
    value = F.trim(F.replace(F.trim(F.coalesce(F.col(column), F.lit(""))), F.lit(mark), F.lit("")))
    got = found.select(key, value.alias("_v")).where(f"_v <> '' and trim({key}) <> ''").groupBy(key).agg(F.min("_v").alias("_v"))
    blank = F.trim(F.coalesce(F.col(column), F.lit(""))) == ""
    out = rows.join(got, key, "left").withColumn(column, F.when(blank & F.col("_v").isNotNull(), F.col("_v")).otherwise(F.col(column)))
    return out.select(*rows.columns)


def dependents(left: DataFrame, right: DataFrame, key: str, value: str, *, missing: bool = False) -> DataFrame:
    """left with right's value by key (inner, null values out), or what is still missing of it."""
    known = right.where(F.col(value).isNotNull())
    return left.join(known.select(key), key, "left_anti") if missing else left.join(known, key)
