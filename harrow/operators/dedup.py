"""Duplicates and representatives: exact rows, groups by key, and the order-dependent two-key rule."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode without it a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (root or "file://" + tempfile.gettempdir()).rstrip("/")


def _written(df: DataFrame) -> DataFrame:
    """df written to the folder that driver and executors share, and read again."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/rounds/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def gone(*frames: DataFrame) -> None:
    """Delete what _written() wrote, once nothing reads it."""
    for df in frames:
        if path := getattr(df, "_written_to", None):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that is dealt to tasks whatever its size: small sides of many rounds would all pass through the driver."""
    return df.hint("merge")


def unused_name(taken: list[str], name: str) -> str:
    """A column name like `name` that none of `taken` is."""
    low = {t.lower() for t in taken}
    return next(n for n in (f"_{name}{k}" for k in range(len(low) + 1)) if n.lower() not in low)


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every vertex of edges(u, v), component_id the smallest vertex that is reachable.

    Every vertex hangs on the smallest one it knows; each round ties all neighbours of a vertex to the smallest of them and then follows
    the tie of that one, so known distances double. Rounds are written; minima are partial aggregates, so no vertex's neighbours meet in one task.
    """
    both = edges.where("u <> v").select("u", "v")
    both = _written(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    at = _written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("component_id")))
    while True:
        # the smallest label among the neighbours goes to the vertex and to the vertex that its own label names
        seen = both.join(shuffled(at.select(F.col("id").alias("v"), F.col("component_id").alias("c"))), "v").groupBy("u").agg(F.min("c").alias("c"))
        own = at.join(shuffled(seen), at["id"] == seen["u"]).select("id", "component_id", F.least("component_id", "c").alias("low"))
        own = _written(own)
        hooks = own.groupBy(F.col("component_id").alias("id")).agg(F.min("low").alias("hook"))
        low = _written(own.join(shuffled(hooks), "id", "left").select("id", "component_id", F.least("low", F.coalesce("hook", "low")).alias("low")))
        gone(own)
        ahead = low.select(F.col("id").alias("low"), F.col("low").alias("far"))
        nxt = _written(low.join(shuffled(ahead), "low", "left").select("id", "component_id", F.least("low", F.coalesce("far", "low")).alias("new")))
        gone(low)
        moved = not nxt.where("new <> component_id").isEmpty()
        gone(at)
        at = nxt.select("id", F.col("new").alias("component_id"))
        at._written_to = nxt._written_to
        if not moved:
            gone(both)
            return at


def first_of_equal_rows(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """One row of each set equal in `columns`, with the smallest row_id: one aggregation, combined before the shuffle."""
    return df.groupBy(*columns).agg(F.min(row_id).alias(row_id))


def best_of_group(df: DataFrame, key: str, rank: list[Column], row_id: str) -> DataFrame:
    """The best row of each non-blank key by `rank` (larger is better), ties to the smallest row_id.

    The survivor takes its group's place: group_pos is the smallest row_id of the group. max_by() style aggregation keeps
    one row a group and task, so a group of any size is no large window.
    """
    order = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], (-F.col(row_id)).alias("last"))
    packed = df.where(F.col(key) != "").groupBy(key).agg(
        F.max(F.struct(order.alias("o"), F.struct(*[F.col(c) for c in df.columns if c != key]).alias("v"))).alias("b"), F.min(row_id).alias("group_pos")
    )
    return packed.select(*[F.col(key) if c == key else F.col(f"b.v.{c}").alias(c) for c in df.columns], "group_pos")


def _without_kept(live: DataFrame, kept: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """Live rows that share no key with a kept one."""
    for k in keys:
        live = live.join(shuffled(kept.where(F.col(k) != "").select(k).distinct()), k, "left_anti")
    return live


def _one_round(live: DataFrame, keys: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """(kept, still live): rows that come first in both their groups are kept, rows that share a key with them go."""
    seen = live
    for i, k in enumerate(keys):
        seen = seen.join(shuffled(live.where(F.col(k) != "").groupBy(k).agg(F.min("_o").alias(f"_m{i}"))), k, "left")
    wins = (F.col("_m0").isNull() | (F.col("_m0") == F.col("_o"))) & (F.col("_m1").isNull() | (F.col("_m1") == F.col("_o")))
    marked = _written(seen.withColumn("_wins", wins).select(*live.columns, "_wins"))
    kept = _written(marked.where("_wins").drop("_wins"))
    left = _written(_without_kept(marked.where("not _wins").drop("_wins"), kept, keys).select(*live.columns))
    gone(marked)
    return kept, left


def _in_order(rows: DataFrame, keys: tuple[str, str], by: str | None) -> DataFrame:
    """Rows kept when each partition is read in order: partitions are whole components (by), or there is one (None). What is kept is all that is remembered."""

    def first_come(batches):
        seen = set(), set()
        for batch in batches:
            keep = []
            for row in zip(*[batch.column(k).to_pylist() for k in keys], strict=True):
                clash = any(v and v in s for v, s in zip(row, seen, strict=True))
                keep.append(not clash)
                if not clash:
                    for v, s in zip(row, seen, strict=True):
                        s.add(v)
            yield batch.filter(pa.array(keep, pa.bool_()))

    dealt = rows.repartition(by) if by else rows.repartition(1)
    return _written(dealt.sortWithinPartitions("_o").mapInArrow(first_come, rows.schema))


def greedy_two_key(df: DataFrame, first: str, second: str, position: str, *, most: int = 1_000_000, rounds: int = 3) -> DataFrame:
    """Rows kept when read in order and dropped if their e-mail or phone belongs to a kept one.

    Rows with the first key come before those without; among equals `position`, a whole number of its own for each row, decides; blank and
    missing keys clash with nothing. A row beaten only by rows that are dropped themselves stays.

    Up to `most` rows are read in order by one task. Of more, a few rounds settle the groups of hot keys: rows that come first in both their groups are
    kept, rows sharing a key with them go. What is left falls into components of rows linked by keys; components of up to `most` rows are read
    in order side by side, many in a task. Of larger ones the first part in order, about `most` rows, is read; what it keeps beats later
    rows, and the rest goes on. So the number of steps doesn't follow the length of chains of rows that beat each other.
    """
    keys = (first, second)
    clean = df.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys})
    live = _written(clean.withColumn("_o", F.struct((F.col(first) == "").cast("int").alias("late"), F.col(position).cast("long").alias("at"))))
    parts: list[DataFrame] = []

    def step(kept: DataFrame, left: DataFrame | None) -> None:
        nonlocal live
        parts.append(kept)
        gone(live)
        live = left

    for _ in range(rounds):
        if live.count() <= most:
            break
        step(*_one_round(live, keys))
    while live is not None and live.count() > most:
        label = unused_name(live.columns, "component")
        links = [live.where(F.col(k) != "").select(F.col("_o.at").alias("u"), F.xxhash64(F.lit(i), F.col(k)).alias("k")) for i, k in enumerate(keys)]
        firsts = [shuffled(x.groupBy("k").agg(F.min("u").alias("v"))) for x in links]
        known = components(links[0].join(firsts[0], "k").union(links[1].join(firsts[1], "k")).select("u", "v"))
        labelled = live.join(shuffled(known.select(F.col("id").alias("_id"), F.col("component_id").alias("_c"))), F.col("_o.at") == F.col("_id"), "left")
        labelled = _written(labelled.withColumn(label, F.coalesce("_c", "_o.at")).drop("_id", "_c"))
        gone(known)
        halves = [2.0**-k for k in range(1, 41)]
        sizes = labelled.groupBy(label, F.col("_o.late").alias("late")).agg(F.count("*").alias("n"), F.percentile_approx("_o.at", halves).alias("cuts"))
        sizes = sizes.groupBy(label).agg(F.sum("n").alias("all"), F.min(F.struct("late", "n", "cuts")).alias("f"))
        # a component within bounds is read whole, of another only rows up to a quantile of its first rows
        j = F.greatest(F.lit(0), F.ceil(F.log2(F.col("f.n") / most))).cast("int")
        cut = F.when(F.col("all") > most, F.struct(F.col("f.late").alias("late"), F.when(j > 0, F.get("f.cuts", j - 1)).otherwise(F.lit((1 << 63) - 1)).alias("at")))
        marked = labelled.join(shuffled(sizes.select(label, cut.alias("_cut"))), label)
        marked = _written(marked.withColumn("_now", F.col("_cut").isNull() | (F.col("_o") <= F.col("_cut"))).drop("_cut"))
        gone(labelled)
        kept = _in_order(marked.where("_now").select(*live.columns, label), keys, label)
        left = _written(_without_kept(marked.where("not _now").select(*live.columns), kept, keys).select(*live.columns))
        gone(marked)
        step(kept.drop(label), left)
    parts.append(_in_order(live, keys, None))
    gone(live)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*df.columns)


def numbered(df: DataFrame, order: list[Column], name: str = "No.") -> DataFrame:
    """Rows numbered 1..n by `order`, with per-range counts instead of one global window.

    The order is split at sampled quantile ranks by Spark's range partitioning; only the counts of those ranges meet.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = _written(ranged)
    counts = ranged.groupBy("_part").count()
    counts = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_off"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_k", at).join(F.broadcast(counts), "_part").withColumn(name, (F.col("_k") + F.col("_off")).cast("int")).drop("_part", "_k", "_off")
