"""Operator 5: n-gram Jaccard join by prefix filters under several global token orders."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Settings:
    """Words a shingle; threshold num / den; orders' seeds; sizes that steer the work but never the result."""

    n: int = 3
    num: int = 90
    den: int = 100
    heavy: int = 65_536  # tokens that the first orders put last: a bounded table
    local: int = 4  # texts of one stretch that a token needs to be counted for that table
    group: int = 16  # a larger (token, size zone) group isn't paired directly: about where a tenth of n tokens times half a group costs n


def _need(s: Settings, x: Column | str, y: Column | str) -> Column:
    """Least intersection of two sets of sizes x and y that reaches the threshold."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return F.ceil((x + y) * F.lit(s.num) / F.lit(s.num + s.den) - F.lit(1e-9)).cast("long")


def _zone(s: Settings, n: Column) -> Column:
    """Size zones: sets that reach the threshold are in the same or in neighbouring zones."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(s.den / s.num)) + F.lit(1e-9)).cast("int")


def shingles(texts: list[str | None], n: int, owner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, other, document): the distinct n-word shingles of each document, sorted by document and token.

    A text of fewer words has its whole word sequence as its one shingle, a text without words none; owner names the document
    of each text, its number where there is none. token and other are two independent 64-bit hashes of a shingle.
    """
    one, two, first = common.word_table(texts, lower=True)
    counts = np.diff(first)
    doc_end = np.repeat(first[1:], counts)
    starts = np.arange(max(0, len(one) - n + 1))
    starts = starts[starts + n <= doc_end[starts]]
    token, other = [common.window_hashes(one, n)[starts]], [common.window_hashes(two, n, 0, 1)[starts]]
    doc = [np.searchsorted(first, starts, side="right") - 1]
    for k in range(1, n):
        own = np.flatnonzero(counts == k)
        if len(own):
            token.append(common.window_hashes(one, k, 100 + k)[first[own]])
            other.append(common.window_hashes(two, k, 100 + k, 1)[first[own]])
            doc.append(own)
    g, o, d = np.concatenate(token), np.concatenate(other), np.concatenate(doc)
    if owner is not None:
        d = owner[d]
    order = np.lexsort((g, d))
    g, o, d = g[order], o[order], d[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    return g[fresh], o[fresh], d[fresh]


def _lists(values: np.ndarray, doc: np.ndarray, texts: int) -> pa.ListArray:
    offsets = np.searchsorted(doc, np.arange(texts + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def documents(docs: DataFrame) -> DataFrame:
    """doc_id, texts: one row a doc_id, with its different texts in an array; rows without doc_id are left out.

    Only the few doc_ids of several rows are gathered; the table of them is mostly empty and then broadcast by its size.
    """
    rows = docs.where("doc_id is not null").select("doc_id", "text")
    more = common.materialize(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    single = rows.join(more, "doc_id", "left_anti").select("doc_id", F.array("text").alias("texts"))
    several = rows.join(more, "doc_id", "left_semi").groupBy("doc_id").agg(F.sort_array(F.collect_set("text")).alias("texts"))
    return single.union(several)


def _parts(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """The batches (doc_id, texts) in slices of bounded text, with the shingles of each."""
    for b in batches:
        lists = b.column(1).to_pylist()
        for lo, hi in common.slices([sum(len(t or "") for t in x) for x in lists], 400_000):
            owner = np.repeat(np.arange(hi - lo), [len(x) for x in lists[lo:hi]])
            yield b.slice(lo, hi - lo), *shingles([t for x in lists[lo:hi] for t in x], n, owner)


def heavy_tokens(docs: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(tokens sorted, their places by rising count) of the tokens found most often: at most s.heavy of them.

    Every text is counted; a stretch of texts passes on only tokens in s.local or more of its texts. Counts thus may be
    low for rare tokens, which changes the order of tokens and with it the work, never which pairs are found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            t, c = np.unique(np.concatenate(held), return_counts=True)
            own = c >= s.local
            return pa.RecordBatch.from_arrays([pa.array(t[own].view(np.int64)), pa.array(c[own].astype(np.int64))], ["t", "c"])

        for _, token, _, _ in _parts(batches, s.n):
            held.append(token)
            size += len(token)
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = docs.select("doc_id", "texts").mapInArrow(common.tidied(run), "t long, c long").groupBy("t").agg(F.sum("c").alias("c"))
    rows = counts.orderBy(F.desc("c"), "t").limit(s.heavy).toPandas()
    tokens, places = rows["t"].to_numpy(np.int64).view(np.uint64), len(rows) - np.arange(len(rows))
    order = np.argsort(tokens)
    return tokens[order], places[order]


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n, f1, f2 (128 bits of the whole set, each of hashes of its own), pa and pb (prefixes under two orders), ka (place of pa's last).

    Both orders put heavy tokens last, by rising count; the rest, and ties, go by two different hashes. A pair that
    reaches the threshold shares a token of its prefixes under any order.
    """
    heavy, place = heavy_tokens(docs, s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, g, o, d in _parts(batches, s.n):
            m = b.num_rows
            counts = np.bincount(d, minlength=m)
            first = np.concatenate([[0], np.cumsum(counts)])
            rank = np.zeros(len(g), np.int64)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, g), len(heavy) - 1)
                rank = np.where(heavy[at] == g, place[at], 0)
            size = counts - -(-counts * s.num // s.den) + 1
            inside = np.arange(len(g)) - first[d] < size[d]
            out = []
            for salt in (11, 12):
                key = common.mix(g, salt)
                order = np.lexsort((key, rank, d))[inside]
                out.append((g[order], d[order]))
                if salt == 11:
                    wide = (rank[order] << np.int64(46)) | (key[order] >> np.uint64(18)).view(np.int64)
                    last = np.zeros(m, np.int64)
                    last[d[order]] = wide  # the last one of each text stays
            sums = []
            for tokens, salt in ((g, 21), (o, 22)):
                total = np.concatenate([[np.uint64(0)], np.cumsum(common.mix(tokens, salt), dtype=np.uint64)])
                with np.errstate(over="ignore"):
                    sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            (ga, da), (gb, db) = out
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array(counts.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                    _lists(ga.view(np.int64), da, m), _lists((gb >> np.uint64(32)).astype(np.uint32).view(np.int32), db, m), pa.array(last),
                ],
                ["doc_id", "n", "f1", "f2", "pa", "pb", "ka"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "texts").mapInArrow(
        common.tidied(run), f"doc_id {kind}, n long, f1 long, f2 long, pa array<long>, pb array<int>, ka long"
    )


def _sets(docs: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """doc_id, tokens (all distinct shingles, hashed) of the documents in ids(doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, g, _, d in _parts(batches, s.n):
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(g.view(np.int64), d, b.num_rows)], ["doc_id", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # sorted and merged at any size of ids, so that the plan of a large corpus is the one that was tried on a small one
    rows = docs.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", "texts")
    return rows.mapInArrow(common.tidied(run), f"doc_id {kind}, tokens array<long>")


def _grouped(rows: DataFrame, s: Settings) -> DataFrame:
    """rows(t, doc_id, n, ...) of tokens in two documents or more, with their group (t, z) and its size m.

    Counts are written before they are joined back: both sides are then plain shuffles, and a crowded group can be split.

    Every document stands in its own size zone (own = true) and in the next one, so a group meets only sizes that can
    reach the threshold. z is the zone of the larger document of a pair.
    """
    some = rows.groupBy("t").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("t")
    some = common.materialize(some, "shared")
    zone = _zone(s, F.col("n"))
    zoned = rows.join(some, "t", "left_semi").withColumn("z", F.explode(F.array(zone, zone + 1))).withColumn("own", F.col("z") == zone)
    zoned = common.materialize(zoned, "zoned")
    per = zoned.groupBy("t", "z").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("any")).where("m > 1 and any").drop("any")
    per = common.materialize(per, "per-group")
    both = common.materialize(zoned.join(per, ["t", "z"]), "groups")
    common.discard(zoned, some, per)
    return both


def _side(df: DataFrame, side: str, *also: str) -> DataFrame:
    return df.select("t", "z", *[F.col(c).alias(c + side) for c in ("doc_id", "n", "own", *also)])


def _pairs(left: DataFrame, right: DataFrame, s: Settings, *also: str) -> DataFrame:
    """Pairs of documents of a group: x the larger one, in its own zone; y of the same or the next lower zone."""
    x, y = _side(left, "x", *also), _side(right, "y", *also)
    larger = (F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("doc_idx") < F.col("doc_idy")))
    fits = F.col("ownx") & larger & (F.col("ny") * s.den >= F.col("nx") * s.num)
    return x.join(y, (x.t == y.t) & (x.z == y.z) & fits).drop(y.t, y.z)


def _rare_first(sets: DataFrame, s: Settings) -> DataFrame:
    """Prefix rows (t, doc_id, n, u, i, before) of the crowded documents under a third order, by document frequency among them.

    u is how many tokens a document shares with no other crowded one; these come first, so a text with more of them than
    the threshold allows has no row at all. i is the token's rank in its document and before the shared ones ahead of it:
    a pair needs to be looked at only at its first common token, and whatever stands before that is in one of the two alone.
    """
    tokens = sets.select("doc_id", F.explode("tokens").alias("t"))
    df = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    df = common.materialize(df, "frequencies")
    shared = tokens.join(df, "t").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("ts"))
    n = F.size("tokens").cast("long")
    allowed = n - F.ceil(n * s.num / F.lit(s.den) - F.lit(1e-9)).cast("long") + 1
    per = sets.select("doc_id", n.alias("n"), allowed.alias("p")).join(shared, "doc_id").withColumn("u", F.col("n") - F.size("ts"))
    per = per.where("u < p").select("doc_id", "n", "u", "ts", F.posexplode(F.expr("slice(ts, 1, int(p - u))")).alias("at", "k"))
    before = F.expr("transform(slice(ts, 1, at), x -> x.t)")
    out = common.materialize(per.select(F.col("k.t").alias("t"), "doc_id", "n", "u", (F.col("u") + F.col("at")).alias("i"), before.alias("before")), "rare")
    common.discard(df)
    return out


def _verify(pairs: DataFrame, sets: DataFrame, sig: DataFrame, s: Settings) -> DataFrame:
    """pairs(x, y) that share a prefix token under the second order as well and reach the threshold: rows (u, v)."""
    pre = sig.select("doc_id", "pb")
    pairs = pairs.join(pre.withColumnsRenamed({"doc_id": "x", "pb": "bx"}), "x").join(pre.withColumnsRenamed({"doc_id": "y", "pb": "by"}), "y")
    pairs = pairs.where(F.arrays_overlap("bx", "by")).select("x", "y")
    a = sets.withColumnsRenamed({"doc_id": "x", "tokens": "tx"})
    b = sets.withColumnsRenamed({"doc_id": "y", "tokens": "ty"})
    both = F.size(F.array_intersect("tx", "ty")).cast("long")
    joined = pairs.join(a, "x").join(b, "y").withColumn("i", both)
    union = F.size("tx") + F.size("ty") - F.col("i")
    return joined.where(F.col("i") * s.den >= union * s.num).select(F.col("x").alias("u"), F.col("y").alias("v"))


def set_sizes(rows: DataFrame, n: int) -> DataFrame:
    """rows(doc_id, texts) as doc_id and n_shingles, the size of the set of all their texts' shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, _, d in _parts(batches, n):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.bincount(d, minlength=b.num_rows).astype(np.int64))], ["doc_id", "n_shingles"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long")


def join(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Jaccard components of all documents: doc_id, n_shingles, component_id.

    Rows without doc_id give a row of their own, with the size of their set and no component; all else as in classes().
    """
    bare = set_sizes(docs.where("doc_id is null").select("doc_id", F.array("text").alias("texts")), s.n)
    return classes(docs, s).unionByName(bare.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def classes(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Jaccard components of all documents that have a doc_id: doc_id, n_shingles, component_id.

    Null and empty texts have no shingles and stand alone; equal sets are one class from the start, represented by the
    smallest doc_id. Rows of one doc_id are one document and give one row: its set is the union of its different texts'
    shingles. Extra columns are left out; an empty table gives an empty result. Shingles are compared by 64 bits of hash, whole sets by 128.

    1. Prefixes under two hash orders that put frequent tokens last. Groups of one token and size zone are paired if
       small; a pair must share so many prefix tokens that what it lacks up to the shorter prefix's end still allows the
       threshold, and share a token of the second order.
    2. Documents of larger groups get a third order, rarest token first, from counts among all of them. In its groups
       everybody is first held against the member with the fewest own tokens, then only members of different components
       meet, once a pair, if what stands before their first common token leaves room for the threshold.
    3. Pairs are verified on whole sets, first one neighbour a document, then those that still connect two components.
    """
    every = documents(docs)
    sig_all = common.materialize(signatures(every, s), "signatures")
    firsts = sig_all.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    member = common.materialize(
        sig_all.select("doc_id", "n", "f1", "f2").join(firsts, ["n", "f1", "f2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")),
        "member",
    )
    reps = member.where("n > 0 and doc_id = rep").select("doc_id")
    sig = common.materialize(sig_all.join(reps, "doc_id", "left_semi"), "representatives")
    common.discard(sig_all)

    p = F.size("pa").cast("long")
    groups = _grouped(sig.select(F.explode("pa").alias("t"), "doc_id", "n", p.alias("p"), "ka"), s)
    small, big = groups.where(F.col("m") <= s.group), groups.where(F.col("m") > s.group)
    crowd = common.materialize(big.select("doc_id", "t").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("q")), "crowd-ids")
    found = _pairs(small, small, s, "p", "ka").groupBy("doc_idx", "doc_idy").agg(
        F.count(F.lit(1)).alias("c"), *[F.first(c).alias(c) for c in ("nx", "ny", "px", "py", "kax", "kay")]
    )
    found = common.materialize(found, "found")
    qx, qy = crowd.withColumnsRenamed({"doc_id": "doc_idx", "q": "qx"}), crowd.withColumnsRenamed({"doc_id": "doc_idy", "q": "qy"})
    found = found.join(qx, "doc_idx", "left").join(qy, "doc_idy", "left")
    most = F.col("c") + F.least(F.coalesce("qx", F.lit(0)), F.coalesce("qy", F.lit(0)))
    need = _need(s, "nx", "ny")
    lacks = F.when(F.col("kax") < F.col("kay"), F.col("px") - most <= F.col("nx") - need)
    lacks = lacks.when(F.col("kay") < F.col("kax"), F.col("py") - most <= F.col("ny") - need).otherwise(F.lit(True))
    near = lambda df: df.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    pairs = found.where(lacks).select(F.col("doc_idx").alias("x"), F.col("doc_idy").alias("y"))
    pairs = common.materialize(near(pairs), "pairs")
    common.discard(groups)

    ids = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).union(crowd.select("doc_id")).distinct()
    sets = common.materialize(_sets(every, ids, s), "sets")
    rare = _rare_first(sets.join(crowd.select("doc_id"), "doc_id", "left_semi"), s)
    crowded = _grouped(rare, s)
    centre = common.materialize(crowded.groupBy("t", "z").agg(F.min(F.struct("u", "doc_id")).alias("k")), "centres")
    star = crowded.join(centre, ["t", "z"]).where("doc_id <> k.doc_id").select(F.col("k.doc_id").alias("x"), F.col("doc_id").alias("y"))
    star = common.materialize(near(star), "star")
    once = near(pairs.groupBy("y").agg(F.min("x").alias("x")).select("x", "y").union(star))
    links = common.materialize(_verify(once, sets, sig, s), "links")
    comp = common.materialize(common.components(links), "component")

    def between(df: DataFrame) -> DataFrame:
        a, b = comp.withColumnsRenamed({"id": "x", "component_id": "cx"}), comp.withColumnsRenamed({"id": "y", "component_id": "cy"})
        df = df.join(a, "x", "left").join(b, "y", "left")
        return df.where(F.coalesce("cx", "x") != F.coalesce("cy", "y")).select("x", "y")

    # what crowded groups still have to compare: members outside the group's main component, with all of other components
    own = (F.col("ix") <= F.col("nx") - need) & (F.col("iy") <= F.col("ny") - need) & ~F.arrays_overlap("beforex", "beforey")
    known = crowded.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component_id", "doc_id"))
    known = common.materialize(known.select("t", "z", "doc_id", "n", "own", "i", "before", "comp"), "known")
    sizes = known.groupBy("t", "z", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("t", "z").agg(F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    main = common.materialize(main.select("t", "z", F.col("top.comp").alias("top")), "main")
    open_ = common.materialize(known.join(main, ["t", "z"]), "open")
    outside = open_.where("comp <> top")
    cross = [_pairs(a, b, s, "i", "before", "comp").where((F.col("compx") != F.col("compy")) & own) for a, b in ((outside, open_), (open_, outside))]
    cross = near(cross[0].union(cross[1]).select(F.col("doc_idx").alias("x"), F.col("doc_idy").alias("y")))
    rest = common.materialize(between(near(pairs.union(cross))).join(once, ["x", "y"], "left_anti"), "rest")
    more = common.materialize(_verify(rest, sets, sig, s), "more-links")
    comp2 = common.materialize(common.components(links.union(more)), "component")
    common.discard(sets, rest, known, open_, main, centre, pairs, star, rare, crowded, crowd, comp, sig)
    out = member.join(comp2.withColumnRenamed("id", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "rep").alias("component_id"))


def keep_first(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """docs without the rows whose doc_id belongs to a component of a smaller doc_id.

    Rows without doc_id, null and empty texts stay; all rows of a doc_id that stays are kept; other columns pass through
    whatever their names; an empty table stays empty.
    """
    (gone,) = common.unused(docs.columns, "gone")
    ids = classes(docs, s).where("doc_id <> component_id").select(F.col("doc_id").alias(gone))
    return docs.join(ids, F.col("doc_id") == F.col(gone), "left_anti")
