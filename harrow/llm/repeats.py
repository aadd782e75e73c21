"""Operator 3: substring dedup by a de Bruijn graph of word windows, compacted into spans with source coordinates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import common

WINDOW, SEED = 20, 6
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def seed_positions(words: np.ndarray, first: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of all windows, seed position of each window, seed hashes by position) for the texts of one word table.

    The seed of a window is its leftmost run of `seed` words with the least hash, so equal windows have equal seeds at
    equal distances, and neighbouring windows mostly share theirs.
    """
    grams = common.window_hashes(words, seed)
    span = window - seed + 1
    if len(grams) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    text_end = np.repeat(first[1:], np.diff(first))
    starts = np.arange(len(words) - window + 1)
    starts = starts[starts + window <= text_end[starts]]
    least = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)
    return starts, starts + least[starts], grams


def _texts(b: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list]]:
    texts = b.column(b.schema.get_field_index(column)).to_pylist()
    for lo, hi in common.slices([len(t or "") for t in texts]):
        yield lo, hi, texts[lo:hi]


#: A position is the word number plus this much for each other text of the same doc_id that sorts before.
_TWIN = 32


def _at(twins: np.ndarray, docs: np.ndarray, words: np.ndarray) -> pa.Array:
    return pa.array((twins[docs] << _TWIN) + words)


def _texts_of(docs: DataFrame, twins: DataFrame) -> DataFrame:
    """doc_id, text, twin, s of rows with both doc_id and text; s is the text's SHA-256."""
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text", F.sha2("text", 256).alias("s"))
    return rows.join(twins, ["doc_id", "s"], "left").select("doc_id", "text", F.coalesce("twin", F.lit(0)).cast("long").alias("twin"), "s")


def twins_of(docs: DataFrame) -> DataFrame:
    """twin (from 0, by s) of the texts of each doc_id that has several texts; mostly empty and then broadcast by its size."""
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", F.sha2("text", 256).alias("s"))
    more = rows.groupBy("doc_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).where("lo <> hi").select("doc_id")
    more = common.materialize(more, "several-texts")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("s")) - 1
    out = common.materialize(rows.join(more, "doc_id", "left_semi").distinct().withColumn("twin", number), "twins")
    common.discard(more)
    return out


def _seeds(texts: DataFrame, window: int, seed: int, salt: int) -> DataFrame:
    """a (seed hash), doc_id, pos, h (hash of the text), twice (the text has the seed more than once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, twins, hashes = b.column(0), np.asarray(b.column(2)), np.asarray(b.column(3))
            for lo, hi, part in _texts(b, "text"):
                words, _, first = common.word_table(part, salt=salt)
                _, at, grams = seed_positions(words, first, window, seed)
                at = np.unique(at)
                doc = np.searchsorted(first, at, side="right") - 1
                a = grams[at].view(np.int64)
                order = np.lexsort((a, doc))
                same = (doc[order][1:] == doc[order][:-1]) & (a[order][1:] == a[order][:-1])
                twice = np.zeros(len(at), bool)
                twice[order[1:][same]] = twice[order[:-1][same]] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), ids.take(pa.array(doc + lo)), _at(twins[lo:hi], doc, at - first[doc]), pa.array(hashes[doc + lo]), pa.array(twice)],
                    ["a", "doc_id", "pos", "h", "twice"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text", "twin", F.xxhash64("text").alias("h")).mapInArrow(run, f"a long, doc_id {kind}, pos long, h long, twice boolean")


def _listed(docs: DataFrame, positions: DataFrame, *also: str) -> DataFrame:
    """doc_id, text, twin, at of the texts in positions(doc_id, pos, *also); at lists their positions, or structs of pos and `also`."""
    twin = F.shiftright("pos", _TWIN).alias("twin")
    per = positions.groupBy("doc_id", twin).agg(F.collect_list(F.struct("pos", *also) if also else F.col("pos")).alias("at"))
    return docs.select("doc_id", "text", "twin").join(per, ["doc_id", "twin"]).select("doc_id", "text", "twin", "at")


def _windows(texts: DataFrame, wanted: DataFrame, window: int, seed: int, salt: int, bits: int) -> DataFrame:
    """The windows (k1, k2: 128 bits of hash; doc_id, start) whose seed position is in wanted(doc_id, pos)."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, twins, wants = b.column(0), np.asarray(b.column(2)), b.column(3)
            for lo, hi, part in _texts(b, "text"):
                one, two, first = common.word_table(part, salt=salt)
                starts, at, _ = seed_positions(one, first, window, seed)
                want = wants.slice(lo, hi - lo)
                flat = np.asarray(want.flatten()) & ((1 << _TWIN) - 1)
                sizes = np.asarray(want.value_lengths())
                keep = np.zeros(len(one) + 1, bool)
                keep[flat + np.repeat(first[:-1], sizes)] = True
                s = starts[keep[at]]
                doc = np.searchsorted(first, s, side="right") - 1
                keys = [(common.window_hashes(w, window, 9, k)[s] & mask).view(np.int64) if len(s) else np.zeros(0, np.int64) for k, w in enumerate((one, two))]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, keys), ids.take(pa.array(doc + lo)), _at(twins[lo:hi], doc, s - first[doc])], ["k1", "k2", "doc_id", "start"]
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return _listed(texts, wanted).mapInArrow(run, f"k1 long, k2 long, doc_id {kind}, start long")


def _nodes(texts: DataFrame, edges: DataFrame, window: int, salt: int) -> DataFrame:
    """edges(doc_id, pos, k1, k2) as doc_id, start, k1, k2, node_in and node_out: hashes of the first and last window - 1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, twins, ats = b.column(0), np.asarray(b.column(2)), b.column(3)
            for lo, hi, part in _texts(b, "text"):
                one, _, first = common.word_table(part, salt=salt)
                at = ats.slice(lo, hi - lo)
                flat = at.flatten()
                word = np.asarray(flat.field(0)) & ((1 << _TWIN) - 1)
                doc = np.repeat(np.arange(hi - lo), np.asarray(at.value_lengths()))
                grams = common.window_hashes(one, window - 1, 3).view(np.int64)
                s = word + first[doc]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc + lo)), _at(twins[lo:hi], doc, word), flat.field(1), flat.field(2), pa.array(grams[s]), pa.array(grams[s + 1])],
                    ["doc_id", "start", "k1", "k2", "node_in", "node_out"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return _listed(texts, edges, "k1", "k2").mapInArrow(run, f"doc_id {kind}, start long, k1 long, k2 long, node_in long, node_out long")


def compacted(edges: DataFrame, piece: int = 6) -> DataFrame:
    """edges(doc_id, start, node_in, node_out, ...) with `head`, the path an edge lies on, instead of its nodes.

    Every distinct edge stands there once, at its source coordinate. Two edges are joined into one path where the node between
    them doesn't branch (one edge in, one out) and the source coordinate goes on by one word; head is the start of the
    path's first edge. Runs inside 2**piece words are joined first, then pieces are tied to the piece before, and pointers
    are doubled by self-joins until all point to their path's first piece.
    """
    rest = [c for c in edges.columns if c not in ("node_in", "node_out")]
    first, last = F.min(F.struct("doc_id", "start")).alias("first"), F.max(F.struct("doc_id", "start")).alias("last")
    one = edges.groupBy(F.col("node_in").alias("node")).agg(first, last).where("first <> last").select("node")
    two = edges.groupBy(F.col("node_out").alias("node")).agg(first, last).where("first <> last").select("node")
    branching = common.materialize(one.union(two).distinct(), "branching")
    cut = edges.join(branching.withColumn("cut", F.lit(True)), F.col("node_in") == F.col("node"), "left").withColumn("cut", F.coalesce("cut", F.lit(False)))
    w = Window.partitionBy("doc_id", F.shiftright("start", piece)).orderBy("start")
    opens = F.col("cut") | F.coalesce(F.lag("start").over(w) + 1 < F.col("start"), F.lit(True))
    local = cut.withColumn("opens", opens).withColumn("local", F.max(F.when(F.col("opens"), F.col("start"))).over(w))
    local = common.materialize(local.select(*rest, "local", "cut"), "local-paths")
    pieces = local.groupBy("doc_id", "local").agg(F.max("start").alias("last"), F.max(F.when(F.col("start") == F.col("local"), F.col("cut"))).alias("cut"))
    pieces = common.materialize(pieces, "path-pieces")
    before = pieces.select("doc_id", (F.col("last") + 1).alias("local"), F.col("local").alias("prev")).where(F.pmod("local", F.lit(1 << piece)) == 0)
    to = pieces.join(before, ["doc_id", "local"], "left")
    to = common.materialize(to.select("doc_id", "local", F.coalesce(F.when(~F.col("cut"), F.col("prev")), "local").alias("head")), "pointers")
    while True:
        far = to.select("doc_id", F.col("local").alias("head"), F.col("head").alias("next"))
        nxt = to.join(far, ["doc_id", "head"]).select("doc_id", "local", F.col("next").alias("head"), (F.col("next") != F.col("head")).alias("moved"))
        nxt = common.materialize(nxt, "pointers")
        common.discard(to)
        to = nxt
        if nxt.where("moved").isEmpty():
            break
    out = common.materialize(local.join(to.drop("moved"), ["doc_id", "local"]).select(*rest, "head"), "paths")
    common.discard(branching, local, pieces, to)
    return out


def _digests(texts: DataFrame, places: DataFrame, most: int = 5000) -> DataFrame:
    """src_doc, src_start, length, d: SHA-256 of the words at each of places(doc_id, start, length, src_doc, src_start), equal ones of a batch once.

    A text with more than `most` places is read once for each part of so many.
    """
    places = places.withColumn("twin", F.shiftright("start", _TWIN))
    crowd = places.groupBy("doc_id", "twin").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    crowd = common.materialize(crowd, "crowded-texts")
    part = F.pmod(F.xxhash64("start", "length"), F.ceil(F.coalesce("n", F.lit(1)) / F.lit(most)).cast("long"))
    at = F.collect_list(F.struct("start", "length", "src_doc", "src_start"))
    per = places.join(crowd, ["doc_id", "twin"], "left").groupBy("doc_id", "twin", part.alias("part")).agg(at.alias("at"))
    names = ["src_doc", "src_start", "length", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, None] = {}
        for b in batches:
            at = b.column(1)
            kinds = (at.type.value_type.field(2).type, pa.int64(), pa.int32(), pa.binary())
            for i in range(b.num_rows):
                words = b.column(0)[i].as_py().encode("utf-8", "surrogatepass").split()  # bytes split at just the separators
                for w, n, d, s in zip(*(at[i].values.field(k).to_pylist() for k in range(4)), strict=True):
                    w &= (1 << _TWIN) - 1
                    seen[d, s, n, hashlib.sha256(b" ".join(words[w : w + n])).digest()] = None
                if len(seen) > 50_000 or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*seen, strict=True), kinds, strict=True)], names)
                    seen.clear()

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text", "twin").join(per, ["doc_id", "twin"]).select("text", "at").mapInArrow(
        run, f"src_doc {kind}, src_start long, length int, d binary"
    )


def unlike(texts: DataFrame, found: DataFrame) -> bool:
    """Whether the words of any span differ from those at its source: all digests of one source have to be one."""
    own = found.select("doc_id", "start", "length", "src_doc", "src_start")
    source = found.select(F.col("src_doc").alias("doc_id"), F.col("src_start").alias("start"), "length", "src_doc", "src_start").distinct()
    ends = _digests(texts, own.unionByName(source)).groupBy("src_doc", "src_start", "length").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return not ends.where("lo <> hi").isEmpty()


def spans(docs: DataFrame, twins: DataFrame, window: int = WINDOW, seed: int = SEED, bits: int = 64, attempts: int = 8) -> tuple[DataFrame, DataFrame]:
    """(spans, copies): spans(doc_id, start, length, src_doc, src_start) of repeated words; copies(doc_id, twin) of whole texts.

    Edges of the graph are windows of `window` words, nodes its runs of `window` - 1. Only windows around a seed that
    occurs in two different texts (or twice in one) can repeat, so the seeds, one to some eight words, are counted first.
    Texts equal to an earlier one are left out of the graph and returned as copies.

    1. Each edge that occurs more than once gets its earliest coordinate as source (min() with partial aggregation).
    2. compacted() joins edges over nonbranching nodes into paths.
    3. Later occurrences meet their edge's path; what runs along one path becomes one span.
    4. The words of every span are compared with those at its source. Windows are matched by `bits` (at most 64) of each of
       two hashes; if a span shows that two different windows had one hash, all is done again with other hashes, at most
       `attempts` times, then RuntimeError. No repeat can be missed, as equal words have equal hashes.
    """
    texts = _texts_of(docs, twins)
    row = F.struct("doc_id", "twin")
    groups = texts.select("doc_id", "twin", "s")
    firsts = groups.groupBy("s").agg(F.min(row).alias("first"), F.max(row).alias("last")).where("first <> last").select("s", "first")
    firsts = common.materialize(firsts, "firsts")
    copies = common.materialize(groups.join(firsts, "s").where(row != F.col("first")).select("doc_id", "twin").distinct(), "copies")
    common.discard(firsts)
    for salt in range(attempts):
        found = _spans(texts, copies, window, seed, bits, salt)
        if not unlike(texts, found):
            return found, copies
        common.discard(found)
    raise RuntimeError(f"different windows had equal hashes {attempts} times")


def _spans(texts: DataFrame, copies: DataFrame, window: int, seed: int, bits: int, salt: int) -> DataFrame:
    seeds = common.materialize(_seeds(texts, window, seed, salt), "seeds")
    repeated = seeds.groupBy("a").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.max("twice").alias("t")).where("lo <> hi or t")
    repeated = common.materialize(repeated.select("a"), "repeated")  # written first: the join can then split a seed that very many texts have
    wanted = seeds.select("a", "doc_id", "pos", F.shiftright("pos", _TWIN).alias("twin")).join(repeated, "a", "left_semi").join(copies, ["doc_id", "twin"], "left_anti")
    wanted = common.materialize(wanted.select("doc_id", "pos"), "wanted")
    common.discard(seeds, repeated)
    edges = common.materialize(_windows(texts, wanted, window, seed, salt, bits), "edges")
    common.discard(wanted)
    source = edges.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "start")).alias("src"), F.max(F.struct("doc_id", "start")).alias("end")).where("src <> end")
    source = source.select(F.col("src.doc_id").alias("doc_id"), F.col("src.start").alias("pos"), "k1", "k2")
    nodes = common.materialize(_nodes(texts, source, window, salt), "nodes")
    named = compacted(nodes).withColumnsRenamed({"doc_id": "src_doc", "start": "src_start"})
    common.discard(nodes)
    later = edges.join(named, ["k1", "k2"]).where("doc_id <> src_doc or start <> src_start").select("doc_id", "start", "src_doc", "src_start", "head")
    later = later.repartition("doc_id").groupBy("doc_id", "start").agg(*[F.first(c).alias(c) for c in ("src_doc", "src_start", "head")])  # a row read twice
    w = Window.partitionBy("doc_id").orderBy("start")
    goes_on = (F.lag("start").over(w) + 1 == F.col("start")) & (F.lag("src_doc").over(w) == F.col("src_doc")) & (
        (F.lag("src_start").over(w) + 1 == F.col("src_start")) & (F.lag("head").over(w) == F.col("head"))
    )
    path = F.sum(F.when(goes_on, 0).otherwise(1)).over(w)
    out = later.withColumn("path", path).groupBy("doc_id", "path").agg(
        F.min("start").alias("start"), (F.count(F.lit(1)) + (window - 1)).cast("int").alias("length"),
        F.min(F.struct("start", "src_doc", "src_start")).alias("x"),
    )
    out = common.materialize(out.select("doc_id", "start", "length", "x.src_doc", "x.src_start"), "spans")
    common.discard(edges)
    return out


def _marked(docs: DataFrame, names: list[str], window: int, seed: int) -> DataFrame:
    """docs with the columns `names` more: word numbers and lengths of its spans, and whether it is a copy."""
    starts, lengths, copy, s, twin = names
    twins = twins_of(docs)
    found, copies = spans(docs, twins, window, seed)
    word = (F.col("start") % F.lit(1 << _TWIN)).cast("int")
    per = found.groupBy(F.col("doc_id").alias(s), F.shiftright("start", _TWIN).alias(twin)).agg(
        F.collect_list(word).alias(starts), F.collect_list("length").alias(lengths), F.lit(False).alias(copy)
    )
    none = F.array().cast("array<int>")
    per = per.unionByName(copies.select(F.col("doc_id").alias(s), F.col("twin").cast("long").alias(twin), none.alias(starts), none.alias(lengths), F.lit(True).alias(copy)))
    numbered = docs.join(
        twins.select(F.col("doc_id").alias(s), F.col("s").alias(copy), F.col("twin").alias(starts)),
        (F.col("doc_id") == F.col(s)) & (F.sha2("text", 256) == F.col(copy)), "left",
    ).select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(starts), F.lit(0)).cast("long").alias(lengths))
    on = (numbered["doc_id"] == per[s]) & (numbered[lengths] == per[twin])
    return numbered.join(per, on, "left").select(*[numbered[f"`{c}`"] for c in docs.columns], per[starts], per[lengths], per[copy])


def _kept(text: str | None, s: list[int] | None, n: list[int] | None, copy: bool | None, window: int) -> tuple[list[str], int]:
    """Words that stay, and how many there were."""
    words = _WORDS.findall(text or "")
    if copy and len(words) >= window:
        return [], len(words)
    if not s:
        return words, len(words)
    gone = np.zeros(len(words) + 1, np.int32)
    at, size = np.asarray(s), np.asarray(n)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + size, -1)
    stay = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, stay.tolist(), strict=True) if k], len(words)


def digests(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row.

    A null or empty text has no words; a text shorter than a window loses none; of equal windows the one with the smallest
    (doc_id, start) stays. Different texts of one doc_id are ordered by their SHA-256, no window reaches over two of them;
    wholly equal rows are one document read twice and get one result each. A row without doc_id is compared with nothing.
    Extra columns are left out, an empty table gives an empty result.
    """
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], []]
            for row in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                kept, n = _kept(*row, window)
                for c, v in zip(cols, (n, n - len(kept), hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()), strict=True))], names)

    kinds = [docs.schema["doc_id"].dataType, LongType(), LongType(), StringType()]
    rows = _marked(docs.select("doc_id", "text"), common.unused(["doc_id", "text"], *_HELPERS), window, seed)
    return rows.mapInArrow(run, StructType([StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


#: What the marks of a row are called, made unlike any column there is.
_HELPERS = ("starts", "lengths", "copy", "key", "twin")


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """docs whose texts have lost their repeated words; a text that loses none stays as it is, else words are joined by spaces.

    Null and empty texts and rows without doc_id stay as they are; several texts of one doc_id and equal rows as in digests();
    other columns pass through whatever their names; an empty table stays empty.
    """
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols, texts = list(b.columns[: len(names)]), []
            marks = [b.column(len(names) + k).to_pylist() for k in range(3)]
            for t, *mark in zip(cols[at].to_pylist(), *marks, strict=True):
                kept, n = _kept(t, *mark, window)
                texts.append(t if len(kept) == n else " ".join(kept))
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    return _marked(docs, common.unused(names, *_HELPERS), window, seed).mapInArrow(run, docs.schema)
