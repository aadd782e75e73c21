"""Incremental runs: each key once, and work on a key again until it succeeds."""

from __future__ import annotations

from collections.abc import Callable

from harrow.operators.dedup import unused_name
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_new(spark: SparkSession, source: str, schema: str, key: str, target: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append to target every row of newly arrived files whose key hasn't been seen in any run, then stop.

    Available-now trigger: a run takes what is there, commits files and state together, and the next one goes on from
    there; a failed run repeats its batch. State holds the keys.
    """
    new = spark.readStream.schema(schema).format(fmt).load(source).dropDuplicates([key])
    q = new.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", target).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _attempts(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the attempts that were finished, whatever store root is in: those whose progress has its success mark."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/progress")
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(at):
        return []
    marks = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/progress/attempt=*/_SUCCESS")) or []
    return sorted(int(m.getPath().getParent().getName().removeprefix("attempt=")) for m in marks)


def run_until_done(
    spark: SparkSession, source: str, schema: str, key: str, work: Callable[[DataFrame], DataFrame], root: str, *, ok: str = "ok", most: int = 5, wait: float = 0, now: float | None = None, fmt: str = "parquet",
) -> int:
    """One run over newly arrived keys and those whose work failed before; returns the number of the attempt, 0 if nothing was due.

    New rows go to an inbox, each key once, by run_new(). `work` takes the due ones and gives rows with their key, a flag `ok` and whatever it
    found. A key is done once a row of it is ok; else, also when work gives no row for it, it comes again, up to `most` attempts and
    not before `wait` seconds, twice as many after each attempt, have passed. Rows that are ok are written under the attempt's number, and the progress of all its keys
    after them; that is what finishes the attempt, so one that breaks off is repeated under its number and adds nothing twice. results() and
    progress() read them. A missing flag counts as failed; rows without a key are left out.
    """
    run_new(spark, source, schema, key, f"{root}/inbox", f"{root}/state", fmt)
    done, inbox = progress(spark, root, key), spark.read.schema(schema).format(fmt).load(f"{root}/inbox").where(F.col(key).isNotNull())
    time = F.unix_timestamp().cast("double") if now is None else F.lit(float(now))
    last, tries, finished = (unused_name(inbox.columns, n) for n in ("last", "tries", "finished"))
    if done is not None:
        seen = done.groupBy(key).agg(F.max("at").alias(last), F.count(F.lit(1)).alias(tries), F.max("ok").alias(finished))
        inbox = inbox.join(seen, key, "left")
        again = ~F.col(finished) & (F.col(tries) < most) & (time >= F.col(last) + F.lit(float(wait)) * F.pow(F.lit(2.0), F.col(tries) - 1))
        inbox = inbox.where(F.col(tries).isNull() | again).drop(last, tries, finished)
    if inbox.isEmpty():
        return 0
    n = max(_attempts(spark, root), default=0) + 1
    path = f"{root}/worked/attempt={n}"
    work(inbox).write.mode("overwrite").parquet(path)
    worked = spark.read.parquet(path)
    good = F.coalesce(F.col(ok), F.lit(False))
    worked.where(good).write.mode("overwrite").parquet(f"{root}/results/attempt={n}")
    success = worked.groupBy(key).agg(F.max(good).alias("ok"))
    at = inbox.select(key).distinct().join(success, key, "left").select(key, F.coalesce("ok", F.lit(False)).alias("ok"), time.alias("at"))
    at.write.mode("overwrite").parquet(f"{root}/progress/attempt={n}")
    return n


def _of_attempts(spark: SparkSession, root: str, what: str) -> DataFrame | None:
    found = _attempts(spark, root)
    return spark.read.option("basePath", f"{root}/{what}").parquet(*[f"{root}/{what}/attempt={n}" for n in found]) if found else None


def results(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows of finished attempts that were ok, with their attempt; None before the first."""
    return _of_attempts(spark, root, "results")


def progress(spark: SparkSession, root: str, key: str) -> DataFrame | None:
    """(key, ok, at, attempt) of finished attempts; None before the first."""
    return _of_attempts(spark, root, "progress")
