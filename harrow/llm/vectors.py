"""What the two vector operators share: valid vectors, bounded pivots, cells and blocks of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, vec of rows whose vector isn't null or empty and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    vec = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).alias("id"), vec.alias("vec")).where("vec is not null and size(vec) > 0").where(~F.exists("vec", bad))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def units(df: DataFrame) -> DataFrame:
    """df(id, vec, m) with vectors of length one.

    They are divided by their largest component first, so that neither squares of very large ones nor of very small ones leave the doubles; squares
    are added component by component, so a vector's result doesn't depend on the rows beside it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column(1)
            dims, out = np.asarray(vec.value_lengths()), [None] * b.num_rows
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                x = matrix(vec.take(pa.array(own)))
                x = x / np.abs(x).max(axis=1)[:, None]
                total = np.zeros(len(x))
                for k in range(int(d)):
                    total += x[:, k] * x[:, k]
                for i, row in zip(own, x / np.sqrt(total)[:, None], strict=True):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float64())), b.column(2)], ["id", "vec", "m"])

    return df.mapInArrow(run, "id long, vec array<double>, m long")


def fitting(df: DataFrame, rows: int, most_bytes: int) -> int:
    """How many of df's vectors make a block: `rows` of them, or fewer where the longest are so long that a block would pass most_bytes."""
    longest = df.agg(F.max(F.size("vec"))).first()[0] or 1
    return max(16, min(rows, most_bytes // (8 * longest)))


def pivots(df: DataFrame, most: int, sample: int = 4096) -> dict[int, np.ndarray]:
    """By dimension, up to `most` far-apart vectors out of a bounded sample (least hashes of id): the tree's upper level.

    df(id, vec). They only steer which rows stand together; radii are taken over all rows afterwards.
    """
    rows = df.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r.vec), []).append(r.vec)
    out = {}
    for d, vecs in by.items():
        x = np.array(vecs)
        chosen, far = [0], np.full(len(x), np.inf)
        while len(chosen) < min(most, len(x)):
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
            if far.max() <= 0:
                break
            chosen.append(int(far.argmax()))
        out[d] = x[chosen]
    return out


def with_cells(df: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """df(id, vec, ...) with dim, cell (number of the nearest pivot of its dimension) and dist (to it)."""
    names = [*df.columns, "dim", "cell", "dist"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column(b.schema.get_field_index("vec"))
            dims = np.asarray(vec.value_lengths()).astype(np.int32)
            cell, dist = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                x, c = matrix(vec.take(pa.array(own))), centres.get(int(d), np.zeros((1, int(d))))
                gap = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
                cell[own] = gap.argmin(axis=1)
                dist[own] = np.sqrt(((x - c[cell[own]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims), pa.array(cell), pa.array(dist)], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", dim int, cell int, dist double"
    return df.mapInArrow(run, schema)


def blocks(df: DataFrame, size: int, fields: list[str]) -> DataFrame:
    """Rows of a cell in blocks of about `size`: block (number), dim, cell, rows (array of structs of `fields`).

    A cell of any size is split by a hash of id, so no block grows with the data.
    """
    per = df.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("_n"))
    put = df.join(per, ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / F.lit(size)).cast("long")))
    out = put.groupBy("dim", "cell", "chunk").agg(F.collect_list(F.struct(*fields)).alias("rows"))
    return out.withColumn("block", F.xxhash64("dim", "cell", "chunk"))


def per_row(df: DataFrame, make: Callable[..., list[tuple]], schema: str, arrow: list[tuple[str, pa.DataType]]) -> DataFrame:
    """mapInArrow row by row: make(**row) gives the output tuples of one (large) input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = make(**{n: b.column(k)[i] for k, n in enumerate(b.schema.names)})
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), arrow, strict=True)], [n for n, _ in arrow])

    return df.mapInArrow(run, schema)
