"""Readers and writers of the tables that jobs exchange: CSV with its quirks, delimited text, JSON state."""

from __future__ import annotations

import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from harrow.functions import text
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import split_csv

LISTING = ("Name", "Website", "Phone", "Address", "Rating", "Reviews_Count", "State", "Location_Name", "Latitude", "Longitude", "Search_Query", "URL")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt by `by` to twice as many tasks as there are cores: a file of short rows is one split, however long each row is worked on."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *by)


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """CSV with a header in each file, read by splits (see split_csv); every cell a string, missing cells empty, further ones left out.

    A byte order mark is dropped, line breaks in quoted cells stay, blank lines are passed over. Names come from `columns` or the first file's
    header; of equal names the last column counts. A file without any row, or an empty one, gives none.
    """
    header = list(columns) if columns else split_csv.first_record(spark, path)
    at = {n: i for i, n in enumerate(header)}
    rows = split_csv.read_records(spark, path).where(~split_csv.is_header() & (F.size("cells") > 0))
    return rows.select(*[F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for n, i in at.items()])


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings whose rows may carry one cell more than the header: it becomes Permanently_Closed (Yes, else No)."""
    df = read_csv(spark, path, (*LISTING, "Permanently_Closed"))
    flag = F.when(F.lower(F.trim("Permanently_Closed")) == "yes", "Yes").otherwise("No")
    return df.withColumn("Permanently_Closed", flag)


def read_positional(spark: SparkSession, path: str, picks: dict[int, str]) -> DataFrame:
    """CSV columns by position whatever the header says; short rows are filled up, rows of blank cells are left out."""
    rows = split_csv.read_records(spark, path).where(~split_csv.is_header() & F.exists("cells", lambda c: text.stripped(c) != ""))
    return rows.select(*[text.stripped(F.get("cells", F.lit(i))).alias(n) for i, n in picks.items()])


def read_tsv(spark: SparkSession, path: str, least: int, picks: dict[int, str]) -> DataFrame:
    """Tab-separated lines without quoting that have at least `least` fields."""
    parts = spark.read.text(path).select(F.split("value", "\t", -1).alias("p")).where(F.size("p") >= least)
    return parts.select(*[F.col("p")[i].alias(n) for i, n in picks.items()])


def read_zipped_tsv(spark: SparkSession, path: str, least: int, picks: dict[int, str], member: str = "*") -> DataFrame:
    """read_tsv() of the members of zip archives whose names match: member and the picked fields.

    An archive is one row of Spark's binary source, so its packed size is bounded by that (2 GB); members are inflated as a stream, a batch of
    lines at a time, whatever their length. Bytes that aren't UTF-8 are replaced; folders and empty members give nothing.
    """
    names = ["member", *picks.values()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in (c for b in batches for c in b.column(0)):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                for info in z.infolist():
                    if info.is_dir() or not fnmatch.fnmatch(info.filename, member):
                        continue
                    rows, size = [], 0
                    for line in io.TextIOWrapper(z.open(info), "utf-8", "replace"):
                        parts = line.rstrip("\n").split("\t")
                        if len(parts) >= least:
                            rows.append((info.filename, *[parts[i] if i < len(parts) else None for i in picks]))
                            size += len(line)
                        if size > 4_000_000 or len(rows) >= 20_000:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"`{n}` string" for n in names))


def read_after_header(spark: SparkSession, path: str, header: str) -> DataFrame:
    """A delimited file whose header line is found by its text; lines of the file up to it are skipped.

    Lines are read as splits of files, not files as a whole; `at` orders them: file, start of the split, number inside it. The
    header's place, the first in each file, is joined to its lines.
    """
    names = tuple(re.split(r"\s*,\s*", header))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select(F.col("value").alias("text"), place.alias("at"))
    start = lines.where(F.trim("text") == header).groupBy(F.col("at.file").alias("file")).agg(F.min("at").alias("start"))
    body = lines.join(start, F.col("at.file") == F.col("file")).where((F.col("at") > F.col("start")) & (F.col("text") != ""))
    row = F.from_csv("text", strings(*names).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    return body.select("at", row.alias("r")).select("at", "r.*")


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """A location table (state, name, lat, lng, zoom) as write_dimension() leaves it, one row a centre."""
    return spark.read.parquet(path).select("state", "name", F.col("lat").cast("double"), F.col("lng").cast("double"), F.col("zoom").cast("int")).distinct()


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """(location, state, keyword) triples of a progress file, in lower case."""
    df = spark.read.option("multiLine", True).schema("completed array<array<string>>").json(path)
    t = df.select(F.explode("completed").alias("t"))
    return t.select(*[F.lower(F.trim(F.col("t")[i])).alias(n) for i, n in enumerate(("location", "state", "keyword"))]).distinct()


def read_links(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("multiLine", True).schema("completed_links array<string>").json(path)
    return df.select(F.explode("completed_links").alias("url")).distinct()


def read_registry_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(links: name, href, ur_num, status; details: href, phone, email, legal_address, actual_address) of a progress file."""
    link, detail = "struct<href:string,ur_num:string,status:string>", "struct<phone:string,email:string,legal_address:string,actual_address:string>"
    df = spark.read.option("multiLine", True).schema(f"completed_pages array<int>, company_links map<string,{link}>, scraped_details map<string,{detail}>").json(path)
    links = df.select(F.explode("company_links").alias("name", "l")).select("name", "l.*")
    return links, df.select(F.explode("scraped_details").alias("href", "d")).where("d is not null").select("href", "d.*")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header that starts with a byte order mark, for spreadsheet programs; cells keep blanks at their ends."""
    first, *rest = df.columns
    out = df.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def write_done(df: DataFrame, path: str) -> None:
    """Triples added to a progress table; readers take them distinct, so a repeated write does no harm."""
    df.select("location", "state", "keyword").distinct().write.mode("append").json(path)


def write_dimension(df: DataFrame, path: str) -> None:
    """Centres with coordinates in six decimals and a short summary of what they cover."""
    rows = df.withColumn("covers", text.summary(F.col("covered"))).drop("covered")
    rows.withColumns({c: F.round(c, 6) for c in ("lat", "lng")}).write.mode("overwrite").parquet(path)


def counters(df: DataFrame, name: str, **conditions: object) -> tuple[DataFrame, object]:
    """df that counts rows and conditions while it is written, and the observation that has them afterwards."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]), seen
