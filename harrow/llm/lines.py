"""Line dedup: lines that many documents share go everywhere; the others are put together again by position.

Normalised lines are exploded and hashed, distinct documents are counted for each hash, and the lines of hashes over the
threshold are dropped. All of it is DataFrame functions: counts are pre-aggregated before the shuffle, so a line of a third
of all documents is one row a task, and only places of dropped lines, never lines, travel back to the texts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, unused

BLANKS = "\t\n\x0b\x0c\r "


def split_lines(text: Column) -> Column:
    """The lines of a text, split at line feeds alone; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """A line without blanks (tab to carriage return, space) at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _hashes(c: Column) -> list[Column]:
    """128 bits of hash as two numbers with different seeds: at any corpus size two lines share both by no real chance."""
    return [F.xxhash64(c), F.xxhash64(F.lit(11), c)]


def _keys_of(docs: DataFrame, doc_id: str, text: str, least_chars: int) -> DataFrame:
    """(id, h1, h2): a row for each distinct key of each row's text. Strings are made distinct in linear time."""
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col(text)), line_key), lambda k: F.length(k) >= max(least_chars, 1)))
    one, two = _hashes(F.col("k"))
    return docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.explode(keys).alias("k")).select("id", one.alias("h1"), two.alias("h2"))


def common_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, documents: int = 10, least_chars: int = 1) -> DataFrame:
    """(h1, h2, n): hashes of the line keys that stand in at least `documents` different documents, and in how many.

    Rows are counted, with partial sums before the shuffle. Where doc_ids repeat, which one aggregation over the ids tells, what
    their rows count too much is taken off again, so the count is always one of distinct documents. Rows without doc_id count for none.
    """
    counted = _keys_of(docs, doc_id, text, least_chars).groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= documents)
    again = materialize(docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).count().where("count > 1").select("id"), "lines-repeated")
    if not again.isEmpty():
        twice = docs.join(again, docs[doc_id] == again["id"], "left_semi")
        surplus = _keys_of(twice, doc_id, text, least_chars).groupBy("id", "h1", "h2").count().groupBy("h1", "h2").agg(F.sum(F.col("count") - 1).alias("less"))
        counted = counted.join(surplus.where("less > 0"), ["h1", "h2"], "left").select("h1", "h2", (F.col("n") - F.coalesce("less", F.lit(0))).alias("n"))
    out = materialize(counted.where(F.col("n") >= documents), "lines-common")
    discard(again)
    return out


def without_common_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, documents: int = 10, least_chars: int = 1, count: str = "n_lines", dropped: str = "n_dropped"
) -> DataFrame:
    """docs with `text` less its common lines, and two more columns: the lines before and how many of them went.

    A row keeps its other columns whatever their names, but for one named like the two new ones, which is replaced. Empty keys (fewer than least_chars code points) are never dropped. A null
    text is one empty line and comes back as empty text; a text all of whose lines go is empty too. Rows with equal doc_id and text
    share their fate; each is returned. Rows without doc_id are cleaned but count for no line. An empty table gives an empty one.
    """
    heavy = common_lines(docs, doc_id, text, documents=documents, least_chars=least_chars)
    t1, t2, at = unused([*docs.columns, count, dropped], "t1", "t2", "gone")
    one, two = _hashes(F.coalesce(F.col(text), F.lit("")))
    marked = docs.withColumns({t1: one, t2: two})
    # places of common lines, by text: (id, t1, t2) names all rows that are cut alike, and copies of a text stay apart by their ids
    places = marked.select(F.col(doc_id).alias("id"), t1, t2, F.posexplode(F.transform(split_lines(F.col(text)), line_key)).alias("p", "k"))
    places = places.where(F.length("k") >= max(least_chars, 1)).select("id", t1, t2, "p", *[h.alias(n) for h, n in zip(_hashes(F.col("k")), ("h1", "h2"), strict=True)])
    gone = places.join(heavy, ["h1", "h2"], "left_semi").groupBy("id", t1, t2).agg(F.array_sort(F.collect_set("p")).alias("ps"))
    # one flag a line up to the last that goes: between two of them as many false ones as lines stay
    before = lambda i: F.coalesce(F.get("ps", i - 1), F.lit(-1))
    flags = F.flatten(F.transform("ps", lambda p, i: F.concat(F.array_repeat(F.lit(False), p - before(i) - 1), F.array(F.lit(True)))))
    gone = materialize(gone.select("id", t1, t2, F.size("ps").alias("n"), flags.alias("flags")), "lines-gone")
    b = gone.select(F.col("id").alias(f"{at}_id"), F.col(t1).alias(f"{at}_1"), F.col(t2).alias(f"{at}_2"), F.col("n").alias(f"{at}_n"), F.col("flags").alias(f"{at}_f"))
    out = marked.join(b, F.col(doc_id).eqNullSafe(F.col(f"{at}_id")) & (F.col(t1) == F.col(f"{at}_1")) & (F.col(t2) == F.col(f"{at}_2")), "left")
    kept = F.filter(split_lines(F.col(text)), lambda x, i: ~F.coalesce(F.get(f"{at}_f", i), F.lit(False)))
    clean = F.when(F.col(f"{at}_n").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(kept, "\n"))
    own = [clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c.lower() not in (count.lower(), dropped.lower())]
    return out.select(
        *own, F.size(split_lines(F.col(text))).cast("long").alias(count), F.coalesce(F.col(f"{at}_n"), F.lit(0)).cast("long").alias(dropped)
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, documents: int = 10, least_chars: int = 1) -> DataFrame:
    """One row for each row of docs: doc_id, n_lines, n_dropped and the SHA-256 of the text that is left."""
    out = without_common_lines(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), documents=documents, least_chars=least_chars)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
