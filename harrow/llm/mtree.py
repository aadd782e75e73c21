"""Operator 10: exact top-k inner products by best-first search in paged M-tree nodes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of the types that hold them all, which the first byte names."""
    top = float(np.abs(x).max()) if x.size else 0.0
    kind = next((k for k in "bhil" if top <= np.iinfo(k).max), "d") if top < 2.0**53 else "d"
    return kind.encode() + x.astype(kind).tobytes()


def _unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, data[:1].decode(), offset=1).astype(np.float64).reshape(rows, -1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers as 64-bit ones.

    In doubles while every partial sum stays below 2**53, in Python's own integers beyond; OverflowError where a product
    leaves 64 bits.
    """
    top = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] if q.size and x.size else 0.0
    if top < 2.0**53:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object).reshape(m.shape)
    out = whole(q) @ whole(x).T
    if max(map(abs, out.ravel()), default=0) >= 1 << 63:
        raise OverflowError("an inner product leaves 64 bits")
    return out.astype(np.int64)


def _pages(put: DataFrame) -> DataFrame:
    """Leaf pages: block, dim, cell, n, radius (covering), longest (norm), ids, points, parent (distances to the pivot)."""
    arrow = [("block", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("n", pa.int32()), ("radius", pa.float64()), ("longest", pa.float64())]
    arrow += [(c, pa.binary()) for c in ("ids", "points", "parent")]

    def make(block, dim, cell, rows):
        v = rows.values
        x, dist, ids = vectors.matrix(v.field("vec")), np.asarray(v.field("dist")), np.asarray(v.field("id"))
        order = np.argsort(dist, kind="stable")
        x, dist, ids = x[order], dist[order], ids[order]
        norms = np.sqrt((x * x).sum(axis=1))
        one = (block.as_py(), dim.as_py(), cell.as_py(), len(x), float(dist.max()), float(norms.max()))
        return [(*one, ids.astype(np.int64).tobytes(), _packed(x), dist.tobytes())]

    schema = "block long, dim int, cell int, n int, radius double, longest double, ids binary, points binary, parent binary"
    return vectors.per_row(put.select("block", "dim", "cell", "rows"), make, schema, arrow)


#: Below every score; its negative is still a 64-bit number.
NONE = np.iinfo(np.int64).min + 1


class Best:
    """The k best (score, smallest id) of each query of a block so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None) -> None:
        self.k, self.floor = k, np.full(queries, NONE) if floor is None else floor
        self.score = np.full((queries, k), NONE)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        """The score that a further candidate must reach, by query: `floor` is one that k others are known to reach."""
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        for q in np.unique(query):
            own = query == q
            s = np.concatenate([self.score[q], score[own]])
            i = np.concatenate([self.id[q], ids[own]])
            order = np.lexsort((i, -s))[: self.k]
            self.score[q], self.id[q] = s[order], i[order]


def visit(best: Best, q: np.ndarray, qid: np.ndarray, centre: np.ndarray, x: np.ndarray, ids: np.ndarray, parent: np.ndarray) -> None:
    """One page against one block of queries.

    |q - x| >= | |q - c| - |x - c| | with the stored |x - c| bounds q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 from above
    without touching x; only entries that some query can still use are computed, in whole numbers.
    """
    nq, nx = (q * q).sum(axis=1), (x * x).sum(axis=1)
    to_centre = np.sqrt(((q[:, None, :] - centre[None, None, :]) ** 2).sum(axis=2))[:, 0]
    upper = (nq[:, None] + nx[None, :] - (to_centre[:, None] - parent[None, :]) ** 2) / 2
    limit = best.least()
    may = upper + 1e-9 * (nq[:, None] + nx[None, :]) + 1e-6 >= limit[:, None]
    use = np.flatnonzero(may.any(axis=0))
    if not len(use):
        return
    score = products(q, x[use])
    ok = may[:, use] & (score >= limit[:, None]) & (ids[use][None, :] != qid[:, None])
    if len(use) > best.k:  # what isn't among the page's own k best can't be among all (ties kept)
        masked = np.where(ok, score, NONE)
        cut = np.partition(masked, len(use) - best.k, axis=1)[:, len(use) - best.k]
        ok &= score >= cut[:, None]
    i, j = np.nonzero(ok)
    best.add(i, ids[use][j], score[i, j])


def _search(t: pa.Table, centres: dict[int, np.ndarray], k: int) -> Best | None:
    """One block of queries (the row with qids) against the pages of the table, best bound first."""
    rows = t.drop_columns(["ids", "points", "parent"]).to_pylist()
    own = next((r for r in rows if r["qids"] is not None), None)
    if own is None:
        return None
    qid = np.frombuffer(own["qids"], np.int64)
    q = _unpacked(own["qpoints"], len(qid))
    best = Best(len(qid), k, np.frombuffer(own["floors"], np.int64) if own["floors"] is not None else None)
    for i in sorted((i for i, r in enumerate(rows) if r["block"] is not None), key=lambda i: (-rows[i]["bound"], rows[i]["block"])):
        if rows[i]["bound"] < best.least().min():
            break
        ids, points, parent = (t.column(c)[i].as_py() for c in ("ids", "points", "parent"))
        ids = np.frombuffer(ids, np.int64)
        centre = centres.get(q.shape[1], np.zeros((1, q.shape[1])))[rows[i]["cell"]]
        visit(best, q, qid, centre, _unpacked(points, len(ids)), ids, np.frombuffer(parent))
    return best


def top_k(
    df: DataFrame, k: int = 20, every: int = 20, scale: int = 64, page: int = 1024, queries: int = 1024, pages_a_task: int = 16, most_cells: int = 1024
) -> DataFrame:
    """The k highest inner products of each query: query_id, rank, vec_id, score.

    Vectors become floor(scale * x) a component. Queries are the rows whose vec_id is divisible by `every`; candidates all
    rows of the same length with another vec_id. Ties go to the smaller vec_id. Null vectors and those with null or
    non-finite components take no part, nor do null vec_ids; a vec_id that stands for several rows keeps its best score
    rows as they come. Fewer candidates than k give fewer rows, an empty table none; extra columns are left out. Scores are
    exact up to 64 bits; one that leaves them raises OverflowError.

    Pivots are the tree's inner nodes, pages of bounded size its leaves with covering radius and stored distances to
    their pivot; queries that are near each other stand in one block.

    1. Each block of queries gets a bound for each inner node, from the pivots that travel with the tasks.
    2. It searches the one page of its best node with the best bound: k scores that no result can fall below.
    3. Nodes, then pages, whose bound stays below that are dropped by their summaries alone; only pages that are left travel, to
       tasks of about pages_a_task of them, together with the block once a task. There they are visited best bound first until no
       bound reaches the k-th scores, and within a page the stored distances skip single entries. A window takes the best of the
       k rows a query and task.
    """
    y = lambda x: x * F.lit(float(scale))
    floor = lambda x: F.when(F.abs(y(x)) < 2.0**53, F.floor(y(x)).cast("double")).otherwise(y(x))  # noqa: E731  beyond, doubles are whole
    whole = vectors.valid(df).where("id is not null")
    whole = common.materialize(whole.select("id", F.transform("vec", floor).alias("vec")), "whole")
    page = vectors.fitting(whole, page, 8 << 20)
    n = whole.count()
    most = max(1, min(most_cells, n // page))
    centres = vectors.pivots(whole, most, max(4096, 4 * most))
    pages = common.materialize(_pages(vectors.blocks(vectors.with_cells(whole, centres), page, ["id", "vec", "dist"])), "pages")
    asked = whole.where(F.col("id") % every == 0)
    coarse = max(1, asked.count() // queries)  # the first pivots are the farthest apart: a coarser net of the same tree
    asked = vectors.blocks(vectors.with_cells(asked, {d: c[:coarse] for d, c in centres.items()}), queries, ["id", "vec"])

    def pack(block, dim, cell, rows):
        v = rows.values
        return [(block.as_py(), dim.as_py(), np.asarray(v.field("id")).astype(np.int64).tobytes(), _packed(vectors.matrix(v.field("vec"))))]

    arrow = [("part", pa.int64()), ("dim", pa.int32()), ("qids", pa.binary()), ("qpoints", pa.binary())]
    asked = vectors.per_row(asked.select("block", "dim", "cell", "rows"), pack, "part long, dim int, qids binary, qpoints binary", arrow)
    asked = common.materialize(asked, "asked")

    def bounds(part, dim, qids, qpoints):
        q, c = _unpacked(qpoints.as_py(), len(qids.as_py()) // 8), centres.get(dim.as_py(), np.zeros((1, dim.as_py())))
        norm = np.sqrt((q * q).sum(axis=1))
        inner = q @ c.T
        gap = np.sqrt(np.maximum(0, (norm**2)[:, None] - 2 * inner + (c * c).sum(axis=1)))
        return [(dim.as_py(), part.as_py(), i, float(inner[:, i].max()), float(norm.max()), float(gap[:, i].min())) for i in range(len(c))]

    arrow = [("dim", pa.int32()), ("part", pa.int64()), ("cell", pa.int32()), ("inner", pa.float64()), ("norm", pa.float64()), ("gap", pa.float64())]
    limits = vectors.per_row(asked, bounds, "dim int, part long, cell int, inner double, norm double, gap double", arrow)
    # q.x <= q.c + |q| r, and q.x <= (|q|^2 + |x|^2 - max(0, |q - c| - r)^2) / 2
    away = F.greatest(F.lit(0.0), F.col("gap") - F.col("radius"))
    bound = F.least(F.col("inner") + F.col("norm") * F.col("radius"), (F.col("norm") ** 2 + F.col("longest") ** 2 - away**2) / 2)
    bound = bound + (F.col("norm") ** 2 + F.col("longest") ** 2) * 1e-9 + 1e-3  # what rounding may take away
    summary = pages.select("dim", "cell", "block", "radius", "longest")
    nodes = summary.groupBy("dim", "cell").agg(F.max("radius").alias("radius"), F.max("longest").alias("longest"))
    limits = limits.join(nodes, ["dim", "cell"]).select("dim", "part", "cell", "inner", "norm", "gap", bound.alias("node"))
    limits = common.materialize(limits, "node-bounds")
    top = limits.groupBy("part").agg(F.max_by("cell", F.struct("node", "cell")).alias("cell"))
    first = limits.join(top, ["part", "cell"]).join(summary, ["dim", "cell"]).groupBy("part").agg(F.max(F.struct(bound.alias("bound"), "block")).alias("b"))
    first = first.select("part", F.lit(0).cast("long").alias("share"), "b.block", "b.bound")
    cols = ["part", "share", "block", "bound", "cell", "ids", "points", "parent", "qids", "qpoints", "floors"]

    def tasks(wanted: DataFrame, ask: DataFrame) -> DataFrame:
        """Pages of wanted(part, share, block, bound), and the block of queries once for each part and share."""
        null = lambda c, kind: F.lit(None).cast(kind).alias(c)
        page = wanted.join(pages.select("block", "cell", "ids", "points", "parent"), "block")
        page = page.select(*cols[:8], *(null(c, "binary") for c in cols[8:]))
        ask = wanted.select("part", "share").distinct().join(ask, "part")
        ask = ask.select("part", "share", null("block", "long"), null("bound", "double"), null("cell", "int"), *(null(c, "binary") for c in cols[5:8]), *cols[8:])
        return page.union(ask).groupBy("part", "share")

    def least(t: pa.Table) -> pa.Table:
        best = _search(t, centres, k)
        scores = best.least()
        return pa.table({"part": t.column("part")[:1], "floors": pa.array([scores.tobytes()], pa.binary()), "floor": pa.array([float(scores.min())])})

    none = F.lit(None).cast("binary").alias("floors")
    floors = tasks(first, asked.select("part", "qids", "qpoints", none)).applyInArrow(least, "part long, floors binary, floor double")
    floors = common.materialize(floors, "floors")
    open_ = limits.join(floors.select("part", "floor"), "part").where("node >= floor")
    share = F.pmod(F.xxhash64("block", F.lit(1)), F.lit(max(1, -(-n // (page * pages_a_task))))).alias("share")
    wanted = open_.join(summary, ["dim", "cell"]).select("part", share, "block", bound.alias("bound"), "floor").where("bound >= floor").drop("floor")
    wanted = common.materialize(wanted, "open-pages")
    names = ["query_id", "vec_id", "score"]

    def found(t: pa.Table) -> pa.Table:
        best = _search(t, centres, k)
        i, j = np.nonzero(best.score > NONE)
        qid = np.frombuffer(next(x for x in t.column("qids").to_pylist() if x is not None), np.int64)
        return pa.table([pa.array(qid[i]), pa.array(best.id[i, j]), pa.array(best.score[i, j])], names)

    ask = asked.join(floors.select("part", "floors"), "part").select("part", "qids", "qpoints", "floors")
    got = common.materialize(tasks(wanted, ask).applyInArrow(found, "query_id long, vec_id long, score long"), "found")
    common.discard(whole, pages, asked, limits, floors, wanted)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
