"""Operator 8: bulk-synchronous best-fit packing of token sequences."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from . import common
from .chunks import ChunkCache

CAPACITY = 1024
EOT = "<|endoftext|>"
_ENCODERS: dict[str, ByteBpe] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteBpe:
    """Ids of whole texts by a byte-level BPE file of `tokenizers`, as little-endian 32-bit bytes.

    A distinct piece between single spaces is encoded once. Pieces that follow a space are encoded many in one text: there every
    piece opens with the one token of its own that starts with a space, so the ids are cut at those; if their number isn't that
    of the pieces, each is encoded by itself. Every `sampled`th text, the first one included, is encoded whole as well, and
    RuntimeError raised if the ids differ.
    """

    def __init__(self, path: str, sampled: int = 64) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.sampled, self.seen = Tokenizer.from_file(path), sampled, 0
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True  # how byte-level files write a space
        self.later, self.first = ChunkCache(self._after_space), ChunkCache(self._each)

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _after_space(self, pieces: list[str], together: int = 500) -> list[bytes]:
        runs = [pieces[i : i + together] for i in range(0, len(pieces), together)]
        out: list[bytes] = []
        for run, ids in zip(runs, self._each([" " + " ".join(r) for r in runs]), strict=True):
            cuts = (4 * np.flatnonzero(self.opens[np.frombuffer(ids, "<u4")])).tolist()
            if len(cuts) != len(run):
                out += self._each([" " + p for p in run])
            else:
                out += [ids[i:j] for i, j in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [t.split(" ") for t in texts]
        plain = [EOT not in t for t in texts]
        heads = self.first.look_up([p[:1] if ok else [] for p, ok in zip(parts, plain, strict=True)])
        tails = self.later.look_up([p[1:] if ok else [] for p, ok in zip(parts, plain, strict=True)])
        out = [b"".join(h + t) if ok and h is not None and t is not None else None for h, t, ok in zip(heads, tails, plain, strict=True)]
        whole = [i for i, x in enumerate(out) if x is None]
        if whole:
            done = self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
            for i, e in zip(whole, done, strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
        held = [i for i in range(len(texts)) if (self.seen + i) % self.sampled == 0]
        self.seen += len(texts)
        for i, e in zip(held, self.tokenizer.encode_batch_fast([texts[i] for i in held], add_special_tokens=False), strict=True):
            if np.array(e.ids, "<u4").tobytes() != out[i]:
                raise RuntimeError("pieces and whole text have different ids")
        return out


def encoder(path: str) -> ByteBpe:
    """One encoder a Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """Token pieces of every whole text: doc_id, piece, start, length, ids_crc32.

    A document is its ids and end_id (null text: end_id alone). One that is longer than capacity is cut into pieces of
    capacity, of which the first is the shorter one.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                rows: list[list] = [[], [], [], [], []]
                coded = bpe.encode([t or "" for t in b.column(1).to_pylist()])
                for doc, ids in zip(b.column(0).to_pylist(), coded, strict=True):
                    ids += tail
                    n, start, k = len(ids) // 4, 0, 0
                    while start < n:
                        size = (n - start) % capacity or capacity
                        for c, v in zip(rows, (doc, k, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])), strict=True):
                            c.append(v)
                        start, k = start + size, k + 1
                kinds = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = docs.schema["doc_id"].dataType
    longs = [StructField(x, LongType()) for x in names[2:]]
    return docs.select("doc_id", "text").mapInArrow(run, StructType([StructField("doc_id", kind), StructField("piece", IntegerType()), *longs]))


def sweep(pieces: np.ndarray, gaps: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One successor sweep over range-sorted sizes and gaps: (runs, bins, bins opened).

    pieces[s] have size s, gaps[g] bins a gap of g. From the largest size down, pieces go by rank to the bins of the smallest gap
    that fits, by rank too and as many equal pieces a bin as it holds; what finds no gap opens bins. Everything is done in
    ranges of ranks, so this works on two lists of at most `capacity` numbers, whatever they count. A run (size, first rank,
    end rank, gap before the sweep, first bin's rank, pieces a bin, offset) gives consecutive ranks to consecutive bins; bins
    (gap before, first rank, end rank, gap afterwards) covers all, opened ones with 0 as the gap before.
    """
    held: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    for g in np.flatnonzero(gaps):
        held[g].append((int(g), 0, int(gaps[g])))
    runs, opened = [], 0
    for s in np.flatnonzero(pieces)[::-1].tolist():
        left, rank = int(pieces[s]), 0
        while left:
            g = next((g for g in range(s, capacity + 1) if held[g]), 0)
            if not g:
                need = -(-left // (capacity // s))
                held[capacity].append((0, opened, opened + need))
                opened, g = opened + need, capacity
            was, lo, hi = held[g].pop()
            each = g // s
            bins = min(hi - lo, -(-left // each))
            put = min(left, bins * each)
            runs.append((s, rank, rank + put, was, lo, each, capacity - g))
            whole, rest = divmod(put, each)
            for at, end, now in ((lo, lo + whole, g - each * s), (lo + whole, lo + bins, g - rest * s), (lo + bins, hi, g)):
                if at < end:
                    held[now].append((was, at, end))
            rank, left = rank + put, left - put
    bins = [(was, lo, hi, g) for g in range(capacity + 1) for was, lo, hi in held[g]]
    return np.array(runs, dtype=np.int64).reshape(-1, 7), np.array(bins, dtype=np.int64).reshape(-1, 4), opened


def counted(df: DataFrame, by: str, capacity: int) -> np.ndarray:
    """Rows of each whole number up to capacity in column `by`."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        counts[r[by]] = r["n"]
    return counts


def ranked(df: DataFrame, size: str, order: list[str], counts: np.ndarray, rows_per_bucket: int = 1000) -> DataFrame:
    """df with `rank`, from 0 inside each size.

    A size of n rows is dealt by hash to n / max(rows_per_bucket, sqrt(n)) buckets, which are numbered one by one from their
    offset, so a common size fills no single task, neither in its buckets nor in their list.
    """
    shares = [(int(s), int(-(-n // max(rows_per_bucket, n**0.5)))) for s, n in enumerate(counts) if n]
    shares = df.sparkSession.createDataFrame(shares, f"{size} long, _buckets long")
    put = df.join(F.broadcast(shares), size).withColumn("_b", F.pmod(F.xxhash64(*order), F.col("_buckets"))).drop("_buckets")  # a row a size
    per = put.groupBy(size, "_b").agg(F.count(F.lit(1)).alias("_n"))
    per = per.select(size, "_b", (F.sum("_n").over(Window.partitionBy(size).orderBy("_b")) - F.col("_n")).alias("_off"))
    rank = F.row_number().over(Window.partitionBy(size, "_b").orderBy(*order)) - 1
    return put.withColumn("_k", rank).join(per, [size, "_b"]).withColumn("rank", F.col("_k") + F.col("_off")).drop("_b", "_k", "_off")


_STRIDE = 1 << 50


def _with_runs(df: DataFrame, runs: np.ndarray, key: int, first: int, size: str, add: dict) -> DataFrame:
    """df(size, rank, ...) with the columns of `add`, each made of (ranks from the run's first one, the run's row).

    runs[:, key] is the size and runs[:, first] the first rank of a run; every row has one.
    """
    runs = runs[np.lexsort((runs[:, first], runs[:, key]))]
    keys = runs[:, key] * _STRIDE + runs[:, first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank, value = np.asarray(b.column("rank")), np.asarray(b.column(size))
            own = runs[np.searchsorted(keys, value * _STRIDE + rank, side="right") - 1]
            new = [pa.array(f(rank - own[:, first], own)) for f in add.values()]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *add])

    return df.mapInArrow(run, StructType([*df.schema.fields, *(StructField(n, LongType()) for n in add)]))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset: as few sequences of at most `capacity` tokens as best fit decreasing gives.

    Bulk-synchronous: pieces are sorted by size and ranked once; supersteps then go down the sizes by halves, the smallest
    sixteenth in one. In a superstep open bins are sorted by gap and ranked, sweep() matches ranks of sizes with ranks of gaps,
    pieces join the bins they are matched to, and the bins' gaps are updated and written for the next superstep. Equal rows get
    separate places; an empty table gives an empty result; pieces have 1 to capacity tokens; extra columns pass through but for
    ones named sequence_id or offset, which are replaced.
    """
    spark = cut.sparkSession
    cut = cut.drop("sequence_id", "offset")
    counts = counted(cut, "length", capacity)
    order = [c for c in ("doc_id", "piece", "ids_crc32", "start", "length") if c in cut.columns]
    rows = cut.select(F.col("length").cast("long").alias("length"), F.struct(*order).alias("key"), F.struct("*").alias("row"))
    placed = common.materialize(ranked(rows, "length", ["key"], counts).drop("key"), "ranked")
    bins = spark.createDataFrame([], "bin long, gap long")
    total, parts, hi = 0, [], capacity
    while hi > 0:
        lo = hi // 2 if hi > capacity // 16 else 0
        now = np.where((np.arange(capacity + 1) > lo) & (np.arange(capacity + 1) <= hi), counts, 0)
        if now.any():
            gaps = counted(bins, "gap", capacity)
            runs, after, opened = sweep(now, gaps, capacity)
            to = _with_runs(placed.where(F.col("length").between(lo + 1, hi)), runs, 0, 1, "length", {
                "gap": lambda j, r: r[:, 3], "at": lambda j, r: r[:, 4] + j // r[:, 5], "offset": lambda j, r: r[:, 6] + j % r[:, 5] * r[:, 0],
            })
            base = F.lit(total)
            fresh = spark.range(opened).select((F.col("id") + base).alias("bin"), F.lit(0).cast("long").alias("gap"), F.col("id").alias("rank"))
            open_ = common.materialize(ranked(bins, "gap", ["bin"], gaps).select("bin", "gap", "rank").union(fresh), "bins-ranked")
            hit = to.where("gap > 0").join(open_.where("gap > 0").select("gap", F.col("rank").alias("at"), "bin"), ["gap", "at"])
            out = to.where("gap = 0").select("row.*", (F.col("at") + base).alias("sequence_id"), "offset")
            parts.append(common.materialize(out.union(hit.select("row.*", F.col("bin").alias("sequence_id"), "offset")), "placed"))
            nxt = _with_runs(open_, after, 0, 1, "gap", {"left": lambda j, r: r[:, 3]}).select("bin", F.col("left").alias("gap")).where("gap > 0")
            nxt = common.materialize(nxt, "bins")
            common.discard(bins, open_)
            bins, total = nxt, total + opened
        hi = lo
    common.discard(placed, bins)
    if not parts:
        return cut.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """Tokenize, cut and pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is end_id alone; repeated rows and equal doc_ids are packed row by row; columns besides doc_id and
    text are left out; an empty table gives an empty result.
    """
    cut = common.materialize(pieces(docs, vocabulary or default_vocabulary(), capacity, end_id), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(cut, capacity).select(*names)
