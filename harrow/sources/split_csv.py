"""Comma-separated files read by many tasks, with line breaks inside quoted cells.

A split of a file can't tell by itself whether it starts inside quotes. So the splits are read twice: first each tells where it would end
if it started outside and if it started inside; strung together in order, these give the state each split starts in. Then every
split is parsed from its first true record on, and the few records that lie across splits are put together from their pieces.
Lines come from Spark's text source, so any store and any line ending will do; endings inside cells become line feeds.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ROW = "whole boolean, file string, block bigint, seq bigint, cells array<string>, text string"
_ROW_ARROW = pa.schema([("whole", pa.bool_()), ("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("cells", pa.list_(pa.string())), ("text", pa.string())])


def ends_inside(line: str, inside: bool) -> bool:
    """Whether quotes are open after a line. They open only at the start of a cell; two in a row inside are one; others are text."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:  # at the start of a cell
            if line.startswith('"', at):
                at += 1
            else:
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
        inside = False
        while True:
            at = line.find('"', at)
            if at < 0:
                return True
            if not line.startswith('"', at + 1):
                break
            at += 2
        at = line.find(",", at + 1) + 1
        if not at:
            return False


def cells_of(records: list[str]) -> list[list[str]]:
    """The cells of whole records; an empty line has none."""
    csv.field_size_limit(2**31 - 1)
    return list(csv.reader(records))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return spark.read.text(path).select("value", file.alias("file"), block.alias("block"), F.xxhash64(file, block).alias("split"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], list[str]]]:
    """((file, block, split), lines) of stretches of the stream; a split's lines may come in several stretches."""
    for b in batches:
        lines, files, blocks, splits = (b.column(i).to_pylist() for i in range(4))
        a = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or splits[i] != splits[a]:
                yield (files[a], blocks[a], splits[a]), lines[a:i]
                a = i


def split_ends(lines: DataFrame) -> DataFrame:
    """(file, block, split, out0, out1): a row a split, with the state after it if it starts outside quotes and if inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list] = {}
        for (file, block, split), part in _by_split(batches):
            row = rows.setdefault(split, [file, block, split, False, True])
            for line in part:
                if '"' in line:
                    row[3], row[4] = ends_inside(line, row[3]), ends_inside(line, row[4])
        cols = list(zip(*rows.values(), strict=True)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["file", "block", "split", "out0", "out1"])

    return lines.mapInArrow(run, "file string, block bigint, split bigint, out0 boolean, out1 boolean")


def start_states(ends: DataFrame) -> DataFrame:
    """(split, inside): the state each split of split_ends() starts in.

    A split keeps the state, turns it, or sets it whatever it was; so the state is that of the last one that set it, turned as often as
    splits since then turn it. One row a split, so a file's rows are few.
    """
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sets, turns = F.col("out0") == F.col("out1"), F.col("out0") & ~F.col("out1")
    x = ends.withColumn("era", F.count_if(sets).over(order))
    since = Window.partitionBy("file", "era").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.first(sets & F.col("out0")).over(since).cast("int")
    after = ((base + F.count_if(turns).over(since)) % 2 == 1).alias("after")
    x = x.select("file", "block", "split", after)
    return x.select("split", F.coalesce(F.lag("after").over(Window.partitionBy("file").orderBy("block")), F.lit(False)).alias("inside"))


def _parse(inside: Callable[[int], bool], crossing: bool, fragments: bool) -> Callable:
    """mapInArrow function over lines: whole records with their cells, or (fragments) the pieces of records that lie across splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, piece, seq, first = None, False, [], 0, True

        def cut(file: str, block: int, pieces: list[tuple[int, str]]) -> pa.RecordBatch:
            cells = [None] * len(pieces) if fragments else cells_of([t for _, t in pieces])
            n = len(pieces)
            cols = [[not fragments] * n, [file] * n, [block] * n, [s for s, _ in pieces], cells, [t for _, t in pieces] if fragments else [None] * n]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ROW_ARROW, strict=True)], schema=_ROW_ARROW)

        def end() -> Iterator[pa.RecordBatch]:
            # what is open at a split's end goes on in the next one, or, where nothing crosses splits, ends with its file
            if now and piece and fragments == crossing:
                yield cut(*now, [(seq, "\n".join(piece))])

        for (file, block, split), part in _by_split(batches):
            if now != (file, block):
                yield from end()
                now, state, piece, seq, first = (file, block), inside(split), [], 0, True
                head = state  # the lines up to the first record's start belong to an earlier split
                if block == 0 and part:
                    part[0] = part[0].removeprefix("\ufeff")
            done: list[tuple[int, str]] = []
            for line in part:
                piece.append(line)
                state = ends_inside(line, state)
                if not state:
                    if head == fragments and (not fragments or first):
                        done.append((seq, "\n".join(piece)))
                    seq, piece, head, first = seq + 1, [], False, False
            if done:
                yield cut(*now, done)
        yield from end()

    return run


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, seq, cells): every record of the files under path, blank lines without cells; (block, seq) orders a file's records.

    Cells are as the standard library's reader has them. A byte order mark is dropped; quotes that never close end with the file. The states
    travel as eight bytes a split that starts inside quotes and eight for each other one, some 13 MB for 100 TB. Files have to be split alike in both readings,
    which is checked: a session whose parallelism changes meanwhile needs spark.sql.files.minPartitionNum set.
    """
    lines = _lines(spark, path)
    states = start_states(split_ends(lines)).collect()
    sent = spark.sparkContext.broadcast((frozenset(r.split for r in states if r.inside), frozenset(r.split for r in states if not r.inside)))

    def inside(split: int) -> bool:
        if split in sent.value[0]:
            return True
        if split not in sent.value[1]:
            raise RuntimeError("the files were split otherwise in the first reading; set spark.sql.files.minPartitionNum")
        return False

    crossing = any(r.inside for r in states)
    rows = lines.mapInArrow(_parse(inside, crossing, False), _ROW)
    if crossing:
        pieces = lines.mapInArrow(_parse(inside, True, True), _ROW)
        # a piece with number 0 of a split that starts inside continues the last piece before it; any other one opens a record
        starts = spark.createDataFrame([(r.split,) for r in states if r.inside], "split bigint")
        pieces = pieces.withColumn("split", F.xxhash64("file", "block")).join(starts.withColumn("cont", F.lit(True)), "split", "left")
        opens = ~((F.col("seq") == 0) & F.coalesce("cont", F.lit(False)))
        nth = F.count_if(opens).over(Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        every = pieces.withColumn("nth", nth).groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("p"))
        whole = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
        joined = every.select("file", F.element_at("p", 1)["block"].alias("block"), F.element_at("p", 1)["seq"].alias("seq"), whole.alias("text"))

        def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cells = pa.array(cells_of(b.column("text").to_pylist()), pa.list_(pa.string()))
                whole = pa.array([True] * b.num_rows)
                yield pa.RecordBatch.from_arrays([whole, b.column("file"), b.column("block"), b.column("seq"), cells, pa.nulls(b.num_rows, pa.string())], schema=_ROW_ARROW)

        rows = rows.unionByName(joined.mapInArrow(parse, _ROW))
    return rows.select("file", "block", "seq", "cells")


def first_record(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The header of the first file, read up to its end alone."""
    text = ""
    for r in spark.read.text(path).limit(1000).toLocalIterator():
        text = f"{text}\n{r.value}" if text else r.value.removeprefix("﻿")
        state = False
        for line in text.split("\n"):
            state = ends_inside(line, state)
        if text and not state:
            break
    return cells_of([text])[0] if text else []


def is_header() -> Column:
    """The first record of each file."""
    return (F.col("block") == 0) & (F.col("seq") == 0)
