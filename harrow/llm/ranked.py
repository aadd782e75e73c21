"""Ranked lexical search: Block-Max WAND over an index of segments.

Documents are indexed where they are read, without a shuffle: a task cuts its documents into segments of a bounded number of postings,
one row each. A term's postings in a segment are blocks of 128 in document order, bit-packed, each with its first and last document and
the largest impact in it. A search moves over the documents of a segment in order; the blocks' ranges and largest impacts alone (the
shallow pointers) tell how much each stretch of documents can score, and stretches below the threshold are passed over without a block
of them being unpacked. The threshold is the k-th best score of the task so far, and never below that of a first pass over a part of the segments.
"""

from __future__ import annotations

import math
import re
import string
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Fixed values of the contract: what a term is made of (in bytes of UTF-8 the same, as all of a letter beyond ASCII lie above 0x7F).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(TERM.encode())
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())

BLOCK = 128
#: Postings of a segment: its size in memory, whatever the documents are.
SEGMENT = 1 << 19
#: Query terms or items that travel to the tasks at once, in bytes; more are taken in several rounds.
TOGETHER = 16 << 20
#: Documents that are scored at once.
_STRETCH = 8192

INDEX = (
    "doc_ids array<bigint>, terms array<string>, df array<int>, opens array<int>, first array<int>, last array<int>, most array<bigint>, "
    "least array<bigint>, n array<int>, gap_bits array<int>, impact_bits array<int>, at array<bigint>, data binary"
)
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_ARROW = pa.schema(
    [("doc_ids", _LONGS), ("terms", pa.list_(pa.string())), *[(c, _INTS) for c in ("df", "opens", "first", "last")], ("most", _LONGS), ("least", _LONGS),
     *[(c, _INTS) for c in ("n", "gap_bits", "impact_bits")], ("at", _LONGS), ("data", pa.binary())]
)


def packed(values: np.ndarray, bits: int) -> bytes:
    """Non-negative whole numbers, `bits` bits each."""
    return np.packbits((values[:, None] >> np.arange(bits) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpacked(data: bytes | pa.Buffer, start: int, n: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, (n * bits + 7) // 8, start)
    return np.unpackbits(raw, count=n * bits, bitorder="little").reshape(n, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


_IN_TERM = np.array([bool(_TERM_BYTES.match(bytes([b]))) for b in range(256)])


def term_counts(texts: pa.Array) -> np.ndarray:
    """How many terms each text of an Arrow array has: bytes that are of a term and follow none that is, or open a text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    inside = _IN_TERM[np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]] if bounds[-1] > bounds[0] else np.zeros(0, bool)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    starts = (bounds - bounds[0])[:-1]
    starts = starts[starts < len(inside)]
    opens[starts] = inside[starts]
    return np.diff(np.concatenate([[0], np.cumsum(opens)])[bounds - bounds[0]])


def corpus_totals(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with a term, terms with repeats) of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = every = 0
        for batch in batches:
            n = term_counts(batch.column(0))
            some, every = some + int((n > 0).sum()), every + int(n.sum())
        yield pa.RecordBatch.from_pydict({"some": [some], "every": [every]})

    got = docs.select(text).mapInArrow(count, "some bigint, every bigint").agg(F.sum("some"), F.sum("every")).first()
    return got[0] or 0, got[1] or 0


def segment(ids: list, lengths: list[int], codes: dict[bytes, int], of: array, doc: array, tf: array, total: tuple[int, int]) -> pa.RecordBatch:
    """One index row: posting i is term of[i] in the document doc[i], tf[i] times. total is (documents with a term, terms) of the corpus."""
    n_docs, n_terms = total
    rank = np.empty(len(ids), np.int64)
    rank[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(len(ids))
    m = np.array([50 + 50 * n * n_docs // n_terms for n in lengths], np.int64)
    at, times = np.array(doc, np.int64), np.array(tf, np.int64)
    impact = 1_000_000_000 * times // (1000 * times + 20 * m[at])
    terms = sorted(codes)
    place = np.empty(len(terms), np.int64)
    place[[codes[t] for t in terms]] = np.arange(len(terms))
    term, where = place[np.array(of, np.int64)], rank[at]
    order = np.lexsort((where, term))
    term, where, impact = term[order], where[order], impact[order]
    opens = np.searchsorted(term, np.arange(len(terms) + 1))
    col: dict[str, list] = {c: [] for c in ("first", "last", "most", "least", "n", "gap_bits", "impact_bits", "at")}
    data, block_of = bytearray(), [0]
    for a, b in zip(opens[:-1], opens[1:], strict=True):
        for s in range(a, b, BLOCK):
            docs, imp = where[s : min(s + BLOCK, b)], impact[s : min(s + BLOCK, b)]
            gaps, low = np.diff(docs, prepend=docs[0]), int(imp.min())
            bits = int(gaps.max()).bit_length(), (int(imp.max()) - low).bit_length()
            for c, v in zip(col, (int(docs[0]), int(docs[-1]), int(imp.max()), low, len(docs), *bits, len(data)), strict=True):
                col[c].append(v)
            data += packed(gaps, bits[0]) + packed(imp - low, bits[1])
        block_of.append(len(col["n"]))
    by_rank = [None] * len(ids)
    for i, r in enumerate(rank):
        by_rank[r] = ids[i]
    row = {"doc_ids": by_rank, "terms": [t.decode("utf-8", "replace") for t in terms], "df": np.diff(opens).tolist(), "opens": block_of, **col, "data": bytes(data)}
    return pa.RecordBatch.from_pydict({c: [row[c]] for c in _ARROW.names}, _ARROW)


def build_index(docs: DataFrame, total: tuple[int, int], wanted: list[str] | None = None, *, most: int = SEGMENT) -> DataFrame:
    """Index rows (INDEX) of docs(doc_id, text) by terms of all texts, or by `wanted` ones alone. doc_id is a whole number."""
    sent = docs.sparkSession.sparkContext.broadcast(None if wanted is None else {w.encode() for w in wanted})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = sent.value
        ids, lengths, codes, of, doc, tf = [], [], {}, array("q"), array("q"), array("q")
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = _TERM_BYTES.findall((text.as_py() or "").encode("utf-8", "surrogatepass").translate(_LOWER))
                times = Counter(found)
                own = times.keys() if only is None else times.keys() & only
                if own:
                    of.extend(codes.setdefault(t, len(codes)) for t in own)
                    tf.extend(times[t] for t in own)
                    doc.extend([len(ids)] * len(own))
                    ids.append(i)
                    lengths.append(len(found))
                if len(of) >= most:
                    yield segment(ids, lengths, codes, of, doc, tf, total)
                    ids, lengths, codes, of, doc, tf = [], [], {}, array("q"), array("q"), array("q")
        if of:
            yield segment(ids, lengths, codes, of, doc, tf, total)

    return docs.mapInArrow(cut, INDEX)


class Segment:
    """A segment as its search sees it: block bounds as arrays, blocks unpacked when first needed."""

    def __init__(self, batch: pa.RecordBatch, i: int = 0) -> None:
        of = lambda c: batch.column(_ARROW.get_field_index(c))[i]
        self.ids, self.data = of("doc_ids").values, of("data").as_buffer()
        self.place = {t: k for k, t in enumerate(of("terms").as_py())}
        self.opens, self.first, self.last, self.most, self.least, self.n, self.gap_bits, self.impact_bits, self.at = (
            of(c).values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("opens", "first", "last", "most", "least", "n", "gap_bits", "impact_bits", "at")
        )
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a block."""
        if b not in self.open:
            n, gaps, at = int(self.n[b]), int(self.gap_bits[b]), int(self.at[b])
            docs = self.first[b] + np.cumsum(unpacked(self.data, at, n, gaps))
            self.open[b] = docs, self.least[b] + unpacked(self.data, at + (n * gaps + 7) // 8, n, int(self.impact_bits[b]))
        return self.open[b]

    def best(self, terms: list[tuple[str, int]], k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) pairs, among them all of the k best of weighted terms that score `floor` at least; a tie at the k-th may add some."""
        of = [(self.place[t], w) for t, w in terms if t in self.place and w > 0]
        if not of:
            return []
        blocks = np.concatenate([np.arange(self.opens[i], self.opens[i + 1]) for i, _ in of])
        weight = np.concatenate([np.full(self.opens[i + 1] - self.opens[i], w, np.int64) for i, w in of])
        first, end, bound = self.first[blocks], self.last[blocks] + 1, self.most[blocks] * weight
        # between two edges the same blocks hold all documents, so their largest impacts bound every score there
        edges = np.unique(np.concatenate([first, end]))
        step = np.zeros(len(edges), np.int64)
        np.add.at(step, np.searchsorted(edges, first), bound)
        np.add.at(step, np.searchsorted(edges, end), -bound)
        reach = np.cumsum(step)
        found: list[tuple[int, int]] = []
        floor, j = max(floor, 1), 0
        while True:
            ahead = np.flatnonzero(reach[j:-1] >= floor)
            if not len(ahead):
                return found
            j += int(ahead[0])  # all before it is passed over, its blocks stay packed
            stop = int(np.searchsorted(edges, edges[j] + _STRETCH))
            low = np.flatnonzero(reach[j : max(stop, j + 1)] < floor)
            end_j = j + int(low[0]) if len(low) else max(stop, j + 1)
            lo, hi = int(edges[j]), int(edges[min(end_j, len(edges) - 1)])
            score = np.zeros(hi - lo, np.int64)
            for x in np.flatnonzero((first < hi) & (end > lo)):
                docs, impacts = self.block(int(blocks[x]))
                a, b = np.searchsorted(docs, (lo, hi))
                score[docs[a:b] - lo] += impacts[a:b] * weight[x]
            good = np.flatnonzero(score >= floor)
            if len(good):
                found += zip(score[good].tolist(), (good + lo).tolist(), strict=True)
                if len(found) >= k:
                    found.sort(key=lambda x: (-x[0], x[1]))
                    found = found[:k]
                    floor = max(floor, found[-1][0])
            j = end_j
            if j >= len(edges) - 1:
                return found


def _searched(index: DataFrame, items: list[tuple], k: int, floors: dict) -> DataFrame:
    """(item_id, doc_id, score): of each task the k best documents of each item (item_id, [(term, weight)]); ties beyond the k-th go by doc_id."""
    sent = index.sparkSession.sparkContext.broadcast((items, floors))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = sent.value
        kept: list[list[tuple]] = [[] for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                part = Segment(batch, i)
                for q, (item, terms) in enumerate(asked):
                    have = kept[q]
                    floor = max(least.get(item, 0), have[k - 1][0] if len(have) >= k else 0)
                    new = part.best(terms, k, floor)
                    if new:
                        have += [(s, part.ids[d].as_py()) for s, d in new]
                        have.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
                        del have[k:]
        rows = [(item, d, s) for (item, _), have in zip(asked, kept, strict=True) for s, d in have]
        for a in range(0, len(rows), 10_000):
            part = list(zip(*rows[a : a + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], ["item_id", "doc_id", "score"])

    return index.mapInArrow(look, "item_id bigint, doc_id bigint, score bigint")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", first_of: int = 16) -> DataFrame:
    """The k best documents of every item with a score above 0: item_id, rank, doc_id, score; ids are whole numbers.

    Every row of docs is a document (repeated rows are documents of equal score, and rows of one doc_id may all be ranked); rows without
    doc_id come last among equal scores. Rows of one item_id, a missing one too, are one item with the terms of all of them. Null or empty texts have no terms;
    without documents or items the result is empty. Terms of the items restrict the index where they fit TOGETHER bytes; else it holds all
    terms. Items are searched in rounds of about TOGETHER bytes. One part in `first_of` of the segments is searched first: an item's k-th score
    there is a floor for the rest, which loses nothing.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = corpus_totals(docs)
    lower = F.translate(F.col(item_text), string.ascii_uppercase, string.ascii_lowercase)
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(f"({TERM})"), F.lit(1)))).alias("term")).distinct()
    asked = materialize(asked, "ranked-items")
    size = lambda df: df.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    terms = asked.select("term").distinct()
    out = None
    if counts[0] and not asked.isEmpty():
        wanted = [r.term for r in terms.collect()] if size(terms) <= TOGETHER else None
        index = materialize(build_index(docs, counts, wanted), "ranked-index")
        df = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))
        known = materialize(asked.join(df, "term"), "ranked-weights")
        rounds = 1 + size(known) // TOGETHER
        early = F.pmod(F.xxhash64("doc_ids"), F.lit(first_of)) == 0
        for r in range(rounds):
            rows = known.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r).groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("ts")).collect()
            # doubles of the C library, as the contract's whole numbers need no more than their floor
            batch = [(x.item_id, [(t.term, math.floor(1000 * math.log((2 * counts[0] + 2) / (2 * t.df + 1)))) for t in x.ts]) for x in rows]
            begun = materialize(_ranked(_searched(index.where(early), batch, k, {}), k).select("item_id", "doc_id", "score"), "ranked-early")
            floors = {x.item_id: x.s for x in begun.groupBy("item_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") >= k).collect()}
            rest = materialize(_searched(index.where(~early), batch, k, floors), "ranked-rest")
            out = begun.union(rest) if out is None else out.union(begun).union(rest)
        discard(index, known)
    discard(asked)
    if out is None:
        out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    return _ranked(out, k).select("item_id", "rank", "doc_id", "score")
