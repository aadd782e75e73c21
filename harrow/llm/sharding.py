"""Operator 4: reproducible sharding by a Feistel permutation over global row numbers (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 4
ROWS_PER_BUCKET = 200_000
#: Copies of one row that a task numbers at once.
STRETCH = 1_000_000


#: Primes and multipliers of the round function, all below 2**31, so that no product leaves 64 bits.
STEPS = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_664_525_011), (2_147_483_587, 1_220_703_125))


def offset(seed: int, k: int) -> int:
    return (seed * 7_919 + k * 104_729) % STEPS[0][0]


def _long(x: int) -> Column:
    """A 64-bit literal: so deep an expression would otherwise have each of its levels cast in a pass of its own."""
    return F.lit(x).cast("long")


def _round(value: Column, seed: int, k: int, modulus: int) -> Column:
    """A number below modulus made of value by multiplying modulo one prime after the other.

    value stands in it once, so the expression of all rounds stays small.
    """
    x = value
    for prime, times in STEPS:
        x = (x % _long(prime) * _long(times) + _long(offset(seed, k))) % _long(prime)
    return x % _long(modulus)


def halves(n: int) -> tuple[int, int, int]:
    """(k, a, b): the sizes a = 2**k and b of the two halves, a * a >= n and a * b >= n > a * (b - 1)."""
    k = 0
    while 4**k < n:
        k += 1
    return k, 1 << k, -(-n >> k)


def permute_once(x: Column, n: int, seed: int, rounds: int = ROUNDS) -> tuple[Column, int]:
    """One pass of an alternating Feistel network on [0, a*b); gives it and a*b, see halves().

    Each half is added to modulo its own size, so the pass is a bijection whatever the round function, and at most
    a - 1 of its values lie outside [0, n). All arithmetic is on whole numbers.
    """
    bits, a, b = halves(n)
    left, right = x.bitwiseAND(_long(a - 1)), F.shiftright(x, bits)
    for k in range(rounds):
        if k % 2 == 0:
            left = (left + _round(right, seed, k, a)) % _long(a)
        else:
            right = (right + _round(left, seed, k, b)) % _long(b)
    return left + right * _long(a), a * b


def feistel(x: Column, n: int, seed: int) -> Column:
    """The permutation of [0, n): passes repeat (cycle walking) until the value falls inside.

    A walk can't be longer than the number of values outside, size - n < a < 2 sqrt(n); the first 16 steps are tried first so
    that the long sequence is built for next to no row.
    """
    first, size = permute_once(x, n, seed)
    out = size - n
    if out <= 0:
        return first
    walk = lambda start, steps: F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), start, lambda acc, _: F.when(acc < _long(n), acc).otherwise(permute_once(acc, n, seed)[0])
    )
    near = F.when(first < _long(n), first).otherwise(walk(first, min(16, out)))
    return near if out <= 16 else F.when(near < _long(n), near).otherwise(walk(near, out))


def row_numbers(df: DataFrame, by: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """Number all rows 0..n-1 without one global sort; gives (df + row_no, n).

    Equal rows are first counted (partial aggregation), so a row repeated without bound stays one row; distinct rows are
    dealt by hash into n / rows_per_bucket buckets, counted, and numbered inside a bucket from that bucket's offset. Only
    the bucket counts meet in one window (one row a bucket). The numbers depend on the rows alone, not on partitioning.
    """
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_m"))
    n = df.count()
    buckets = max(1, -(-n // rows_per_bucket))
    counted = counted.withColumn("_b", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    per = counted.groupBy("_b").agg(F.sum("_m").alias("_c"))
    per = per.select("_b", (F.sum("_c").over(Window.orderBy("_b")) - F.col("_c")).alias("_off"))
    w = Window.partitionBy("_b").orderBy(*[F.col(c).asc_nulls_first() for c in by])
    placed = counted.withColumn("_before", F.sum("_m").over(w) - F.col("_m")).join(per, "_b")
    first = F.col("_off") + F.col("_before")
    placed = placed.select(*by, "_m", first.alias("_first"))
    few = placed.where(F.col("_m") <= STRETCH).select(*by, F.explode(F.sequence("_first", F.col("_first") + F.col("_m") - 1)).alias("row_no"))
    # a row repeated very often is dealt to tasks in stretches, so that neither an array nor a task holds all of it
    starts = placed.where(F.col("_m") > STRETCH).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1, F.lit(STRETCH).cast("long"))).alias("_at"))
    starts = starts.repartition(F.col("_first") + F.col("_at"))
    end = F.col("_first") + F.least(F.col("_at") + STRETCH, F.col("_m")) - 1
    return few.union(starts.select(*by, F.explode(F.sequence(F.col("_first") + F.col("_at"), end)).alias("row_no"))), n


def shard_rows(df: DataFrame, by: list[str], shards: int = 8, seed: int = 20) -> DataFrame:
    """Deal the rows of df (columns `by`, which order them) into shards by a seeded permutation of their row numbers.

    Adds row_no, position (permuted row number), shard = position mod shards and slot = position div shards: shard sizes
    differ by one at most and slots are gapless from 0. Reader of shard s finds slot t at position t * shards + s.
    Nulls order first; equal rows get adjacent numbers and so any of them any of those places; an empty table gives an
    empty result. Columns outside `by` take no part.
    """
    numbered, n = row_numbers(df.select(*by), by)
    at = numbered.withColumn("position", feistel(F.col("row_no"), n, seed) if n else F.col("row_no"))
    return at.withColumn("shard", F.pmod("position", F.lit(shards)).cast("int")).withColumn(
        "slot", F.expr(f"position div {shards}")
    )


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 20) -> DataFrame:
    """Sizes, checksums and places of all documents under the `rows` law (counts at most one apart).

    A null text has no bytes; null doc_ids order first; repeated rows get a place each; other columns are left out; an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    base = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(base, ["doc_id", "size", "text_crc32"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
