"""What the operators of this subpackage share: the shared folder, written intermediates, word hashing, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode without it.

    Raises RuntimeError on a cluster whose session names none, as a machine's own folder would lose rows there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        found = _OWN.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="harrow-shared-")
        _OWN[app] = found
    return found.rstrip("/")


@contextlib.contextmanager
def shuffle_files_go(spark: SparkSession):
    """While it holds, shuffle files of a finished write are removed at once instead of at some later collection."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    with shuffle_files_go(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._harrow_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what materialize() wrote, once nothing reads it any more."""
    for df in frames:
        path = getattr(df, "_harrow_path", None)
        if path:
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system path is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def bounded_batches(spark: SparkSession, rows: int = 500) -> None:
    """Python workers of this session get at most so many rows at once: whole texts of 10,000 rows are too much for one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run(batches) for mapInArrow that gives back what allocators keep when a task is done: workers wait beside the JVM for the next one."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- word hashing -----------------------------------------------------------------------------------------------------

_B = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept between calls and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = max(1 << 12, 1 << int(n).bit_length())
        steps = np.full(size + 1, base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[: n + 1]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); another salt gives another order of the same values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * salt + 1)) & _MASK)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a word that are looked up; those of longer words are computed.
_SHORT = 64
_TABLES: dict[int, np.ndarray] = {}


def _table(salt: int) -> np.ndarray:
    """A 64-bit number of its own for every place in a word (below _SHORT) and byte there."""
    if salt not in _TABLES:
        _TABLES[salt] = mix(np.arange(_SHORT * 256, dtype=np.uint64), salt)
    return _TABLES[salt]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends (exclusive) of the words in UTF-8 bytes; separators are ASCII, so bytes suffice."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SEP[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salts: tuple[int, ...], block: int = 1 << 18) -> list[np.ndarray]:
    """One 64-bit hash a word and salt: the sum of a random number for each (place, byte), then mix() with its length.

    Unlike a polynomial, such sums collide for no family of words: two different words have one hash by chance alone, 1 in
    2**64. Done in blocks of bytes.
    """
    out = [np.empty(len(starts), dtype=np.uint64) for _ in salts]
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, side="right")))
            s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
            part = data[starts[i] : ends[j - 1]]
            opens = np.zeros(len(part), dtype=np.int64)
            opens[s] = s
            key = np.minimum(np.arange(len(part)) - np.maximum.accumulate(opens), _SHORT - 1) * 256 + part
            long = np.flatnonzero(e - s > _SHORT)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            for h, salt in zip(out, salts, strict=True):
                np.cumsum(_table(salt)[key], out=sums[1:])
                own = sums[e] - sums[s]
                for w in long:
                    own[w] = mix(np.arange(e[w] - s[w], dtype=np.uint64) * np.uint64(256) + part[s[w] : e[w]], salt).sum()
                h[i:j] = mix(own + (e - s).astype(np.uint64), salt)
            i = j
    return out


def word_table(texts: list[str | None], lower: bool = False, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one, two, first): two independent 64-bit hashes of every word of all texts in turn, and where each text's words start.

    first has one entry more than texts; another salt gives other hashes; lower maps A-Z alone.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw), dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    starts, ends = word_bounds(data)
    at = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=at[1:])
    one, two = word_hashes(data, starts, ends, (2 * salt + 1000, 2 * salt + 1001))
    return one, two, np.searchsorted(starts, at)


def slices(n_bytes: list[int], most: int = 1_000_000):
    """(from, to) of runs of texts with about `most` bytes each, one text at least."""
    at = total = 0
    for i, n in enumerate(n_bytes):
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(n_bytes):
        yield at, len(n_bytes)


def window_hashes(words: np.ndarray, k: int, salt: int = 0, base: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive words: a polynomial over word hashes (base 0 or 1), then mix()."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    b = _B[base]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * _powers(b, len(words))[:-1], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * _powers(pow(b, -1, 1 << 64), n)[:n], salt)


def unused(taken: list[str], *names: str) -> list[str]:
    """Helper column names that no column of `taken` has (whatever the case)."""
    low = {t.lower() for t in taken}
    tail = next(t for t in map(str, range(len(low) + 1)) if not any(f"_{n}_{t}" in low for n in names))
    return [f"_{n}_{tail}" for n in names]


# --- connected components ---------------------------------------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges(u, v): rows (id, component_id), component_id the smallest id reachable.

    Alternating large-star and small-star joins; every round is written to the shared folder and the previous one
    deleted. A vertex with very many neighbours is grouped by min() with partial aggregation, and the minima are written
    before they are joined back, so that both sides of the join are plain shuffles whose large partitions can be split.
    """
    spark = edges.sparkSession
    e = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name
    )
    last = None
    while True:
        # large star: every neighbour above the vertex is tied to the vertex's smallest neighbour
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = materialize(low, name)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, name)
        discard(low)
        # small star: the vertex and its smaller neighbours are tied to the smallest of them
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        nxt = materialize(small, name)
        total = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e, large, low)
        e = nxt
        if (total[0], total[1]) == last:
            break
        last = (total[0], total[1])
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
