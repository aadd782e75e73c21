"""Operator 6: embedding near-dedup, exact cosine threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

LEAF = 16
_SLACK = 1e-9
#: What single-precision dot products of unit vectors may be wrong by, generously; whatever they pass is computed again.
_SINGLE = 1e-5


#: Points of a small part whose cosine with its centre is below this are nodes of their own.
_WIDE = 0.9


@dataclass
class Tree:
    """Nodes in breadth-first order over permuted points: a node's points are order[lo:hi], its children are consecutive."""

    centre: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    count: np.ndarray


def build(x: np.ndarray, batch: int = 64) -> tuple[Tree, np.ndarray]:
    """Cover tree of unit vectors x: levels with halving radii, each a net of the one above; gives it and the point order.

    A node's children are a greedy net of its points at half its level's radius, each point going to the first centre
    that covers it; the radius kept is the exact distance of the farthest point. Points at one place end in one leaf. Centres are
    tried `batch` at a time, so memory is a row a centre of the batch, not a square matrix.
    """
    order = np.arange(len(x))
    f = x.astype(np.float32)
    nodes = [[0, 0, len(x), 0.0, 0, 0, 2.0]]
    k = 0
    while k < len(nodes):
        c, lo, hi, _, _, _, level = nodes[k]
        own = order[lo:hi]
        if hi - lo > 1:
            nodes[k][3] = float(np.sqrt(((x[own] - x[c]) ** 2).sum(axis=1).max())) + _SLACK
        reach = nodes[k][3]
        if hi - lo > LEAF and reach > 1e-6:
            while level >= reach:
                level /= 2
            at = int(np.flatnonzero(own == c)[0])
            free, parts = np.concatenate([own[at : at + 1], own[:at], own[at + 1 :]]), []
            while len(free):
                tried = min(batch, len(free))
                near = f[free[:tried]] @ f[free].T >= 1 - level * level / 2
                to = np.full(len(free), -1)
                for r in range(tried):
                    if to[r] < 0:
                        to[near[r] & (to < 0)] = r
                        to[r] = r
                parts += [free[to == r] for r in range(tried) if to[r] == r]
                free = free[to < 0]
            # a few points far from each other prune nothing together, so each is a node of its own
            wide = [1 < len(p) <= LEAF and (f[p[1:]] @ f[p[0]]).min() < _WIDE for p in parts]
            parts = [q for p, apart in zip(parts, wide, strict=True) for q in (np.split(p, len(p)) if apart else (p,))]
            nodes[k][4], nodes[k][5] = len(nodes), len(parts)
            order[lo:hi] = np.concatenate(parts)
            for p in parts:
                nodes.append([int(p[0]), lo, lo + len(p), 0.0, 0, 0, level])
                lo += len(p)
        k += 1
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    t = np.array([n[:6] for n in nodes])
    centre = place[t[:, 0].astype(np.int64)]
    return Tree(centre, t[:, 1].astype(np.int64), t[:, 2].astype(np.int64), t[:, 3], t[:, 4].astype(np.int64), t[:, 5].astype(np.int64)), order


def dual(a: Tree, xa: np.ndarray, b: Tree, xb: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Point pairs (i, j) with cosine >= least, and node pairs all of whose points are linked.

    Node pairs whose centres are farther apart than the threshold distance plus both radii are dropped with all below
    them; those closer than the threshold less both radii are taken whole; what is left at the leaves is settled by dot
    products in double precision. Single precision serves bounds alone, with a margin for its rounding.
    """
    reach = np.sqrt(2 - 2 * least)
    fa, fb = xa.astype(np.float32), xb.astype(np.float32)
    kids = lambda t, k: np.arange(t.first[k], t.first[k] + t.count[k]) if t.count[k] else np.array([k])
    none = np.zeros(0, np.int64)
    todo, points_a, points_b, leaves_a, leaves_b, whole = [(0, 0)], [none], [none], [none], [none], []
    while todo:
        p, q = todo.pop()
        ka, kb = kids(a, p), kids(b, q)
        one_a, one_b = (a.hi - a.lo)[ka] == 1, (b.hi - b.lo)[kb] == 1
        for ga, gb, single in ((ka[one_a], kb[one_b], True), (ka[one_a], kb[~one_b], False), (ka[~one_a], kb, False)):
            if not len(ga) or not len(gb):
                continue
            right = fb[b.centre[gb]].T
            for r in range(0, len(ga), 512):
                part = ga[r : r + 512]
                dots = fa[a.centre[part]] @ right
                if single:
                    hit = np.flatnonzero(dots >= least - _SINGLE)
                    if len(hit):
                        i, j = np.divmod(hit, len(gb))
                        points_a.append(a.centre[part[i]])
                        points_b.append(b.centre[gb[j]])
                    continue
                both = a.radius[part][:, None] + b.radius[gb][None, :]
                full = (both < reach) & (dots >= 1 - (reach - both) ** 2 / 2 + _SINGLE)
                whole += [(int(part[i]), int(gb[j])) for i, j in np.argwhere(full)]
                i, j = np.nonzero((dots >= 1 - (reach + both) ** 2 / 2 - _SINGLE) & ~full)
                end = (a.count[part[i]] == 0) & (b.count[gb[j]] == 0)
                leaves_a.append(part[i[end]])
                leaves_b.append(gb[j[end]])
                todo += list(zip(part[i[~end]].tolist(), gb[j[~end]].tolist()))
    la, lb = np.concatenate(leaves_a), np.concatenate(leaves_b)
    na, nb = a.hi[la] - a.lo[la], b.hi[lb] - b.lo[lb]
    out_i, out_j = [none], [none]

    def settle(i: np.ndarray, j: np.ndarray) -> None:
        for r in range(0, len(i), 200_000):
            ok = np.einsum("ij,ij->i", xa[i[r : r + 200_000]], xb[j[r : r + 200_000]]) >= least
            out_i.append(i[r : r + 200_000][ok])
            out_j.append(j[r : r + 200_000][ok])

    settle(np.concatenate(points_a), np.concatenate(points_b))
    for s in range(0, len(la), 20_000):
        m = (na * nb)[s : s + 20_000]
        at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        width = np.repeat(nb[s : s + 20_000], m)
        settle(np.repeat(a.lo[la[s : s + 20_000]], m) + at // width, np.repeat(b.lo[lb[s : s + 20_000]], m) + at % width)
    return np.concatenate(out_i), np.concatenate(out_j), whole


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest point reachable over the edges (i, j), for each of n points."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        nxt = label.copy()
        np.minimum.at(nxt, i, low)
        np.minimum.at(nxt, j, low)
        nxt = nxt[nxt]
        if (nxt == label).all():
            return label
        label = nxt


_TREE = "block long, dim int, cell int, far double, root array<double>, radius double, n int, ids binary, weights binary, points binary, nodes binary"


def _trees(put: DataFrame) -> DataFrame:
    """One tree a block: its summary (far: distance of the farthest point to the pivot; root and its radius), points and nodes."""
    arrow = [("block", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("far", pa.float64()), ("root", pa.list_(pa.float64())), ("radius", pa.float64())]
    arrow += [("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "weights", "points", "nodes"))]

    def make(block, dim, cell, rows):
        v = rows.values
        x = vectors.matrix(v.field("vec"))
        t, order = build(x)
        ids, w = np.asarray(v.field("id"))[order], np.asarray(v.field("m"))[order]
        nodes = np.stack([t.centre, t.lo, t.hi, t.radius, t.first, t.count]).astype(np.float64)
        far = float(np.asarray(v.field("dist")).max())
        one = [block.as_py(), dim.as_py(), cell.as_py(), far, x[order][t.centre[0]], float(t.radius[0]), len(x)]
        return [(*one, ids.astype(np.int64).tobytes(), w.astype(np.int64).tobytes(), np.ascontiguousarray(x[order]).tobytes(), nodes.tobytes())]

    return vectors.per_row(put.select("block", "dim", "cell", "rows"), make, _TREE, arrow)


def _near_cells(trees: DataFrame, centres: dict[int, np.ndarray], reach: float) -> DataFrame:
    """dim, i, j of the cells (i <= j) that may hold a linked pair, by their pivots' distance and covering radii.

    The radii, one number a cell, travel with the pivots; the pairs are found in the tasks, a row of cells at a time.
    """
    far: dict[int, dict[int, float]] = {}
    for r in trees.groupBy("dim", "cell").agg(F.max("far").alias("far")).collect():
        far.setdefault(r.dim, {})[r.cell] = r.far
    radii = {d: np.array([c[1] for c in sorted(x.items())]) for d, x in far.items()}
    cells = {d: np.array(sorted(x), np.int32) for d, x in far.items()}
    pivots = {d: centres.get(d, np.zeros((1, d)))[cells[d]] for d in cells}

    def make(dim, i):
        d, k = dim.as_py(), i.as_py()
        gap = np.sqrt(((pivots[d][k:] - pivots[d][k]) ** 2).sum(axis=1))
        j = k + np.flatnonzero(gap <= radii[d][k:] + radii[d][k] + reach + 1e-6)
        return [(d, int(cells[d][k]), int(cells[d][m])) for m in j]

    spark = trees.sparkSession
    rows = spark.createDataFrame([(d, k) for d in cells for k in range(len(cells[d]))], "dim int, i int")
    return vectors.per_row(rows, make, "dim int, i int, j int", [("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32())])


def _load(n: int, points: bytes, nodes: bytes) -> tuple[Tree, np.ndarray]:
    t = np.frombuffer(nodes).reshape(6, -1)
    whole = lambda k: t[k].astype(np.int64)
    return Tree(whole(0), whole(1), whole(2), t[3], whole(4), whole(5)), np.frombuffer(points).reshape(n, -1)


def _links(get: dict[int, tuple], pairs: list[tuple[int, int]], least: float) -> list[tuple[int, int, int]]:
    """(id, links, tie) of the points that are linked over the block pairs; a tie is an id of the same component."""
    out = []
    for p, q in pairs:
        same = p == q
        (ia, wa, ta, xa), (ib, wb, tb, xb) = get[p], get[q]
        i, j, whole = dual(ta, xa, tb, xb, least)
        if same:
            i, j = i[i != j], j[i != j]
        links_a, links_b = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
        np.add.at(links_a, i, wb[j])
        np.add.at(links_b, j, wa[i])
        shift = 0 if same else len(ia)
        tie_i, tie_j = [i], [j + shift]
        for u, v in whole:
            ra, rb = np.arange(ta.lo[u], ta.hi[u]), np.arange(tb.lo[v], tb.hi[v])
            links_a[ra] += wb[rb].sum()
            links_b[rb] += wa[ra].sum()
            if same:  # a point isn't linked with itself
                own = np.intersect1d(ra, rb)
                links_a[own] -= wb[own]
                links_b[own] -= wa[own]
            tie_i += [ra, np.full(len(rb), ra[0])]
            tie_j += [np.full(len(ra), rb[0] + shift), rb + shift]
        label = forest(shift + len(ib), np.concatenate(tie_i), np.concatenate(tie_j))
        ids = ia if same else np.concatenate([ia, ib])
        links = links_a if same else np.concatenate([links_a, links_b])
        on = np.flatnonzero(links > 0)
        out += zip(ids[on].tolist(), links[on].tolist(), ids[label[on]].tolist())
    return out


def near_duplicates(df: DataFrame, least: float = 0.95, block: int = 4096, most_cells: int = 4096, sample: int = 4096, together: int = 8) -> DataFrame:
    """Cosine near-duplicates of all vectors: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and stand alone; vectors of
    different lengths don't link; equal vectors are compared once and counted by number. A repeated vec_id counts as
    several vectors of that id; a missing one is named by none, and stands alone in a component without other ids. Extra columns are left out, an empty table gives an empty result.

    The upper levels are cells of far-apart pivots, one for every `block` vectors up to most_cells; below, blocks of bounded
    size (`block` vectors, fewer of very long ones), each under its own cover tree. Pairs of cells are pruned by their covering radii, then pairs of blocks by their
    roots, both from summaries alone; only then do the trees of the pairs left over travel, to one task for every pair of groups of
    up to `together` blocks, which traverses them by twos. Pivots come out of `sample` vectors or four a pivot; those of a
    length that the sample lacks stand in one cell about zero. A task returns link counts and a spanning forest, not the
    pairs, so a dense group makes no more rows than it has members a block.
    """
    every = df.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    ok = vectors.valid(df).where(F.exists("vec", lambda x: x != 0))
    # each distinct vector has a number of its own, as ids may be missing or stand on several vectors; it is written, so it stays the same
    same = ok.groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
    same = common.materialize(same.withColumn("id", F.monotonically_increasing_id()), "vectors")
    reps = common.materialize(vectors.units(same.select("id", "vec", "m")), "units")
    block = vectors.fitting(reps, block, 16 << 20)
    most = max(1, min(most_cells, reps.count() // block))
    centres = vectors.pivots(reps, most, max(sample, 4 * most))
    trees = common.materialize(_trees(vectors.blocks(vectors.with_cells(reps, centres), block, ["id", "vec", "m", "dist"])), "trees")
    reach = float(np.sqrt(2 - 2 * least))
    each = max(1, min(together, -(-trees.count() // 8)))
    number = F.row_number().over(Window.orderBy("dim", "cell", "block")) - 1  # one row a block
    keys = common.materialize(trees.select("dim", "cell", "block", "root", "radius").withColumn("g", F.floor(number / F.lit(each)).cast("int")), "tree-roots")
    side = lambda cell, x: keys.select("dim", F.col("cell").alias(cell), *[F.col(c).alias(f"{c}_{x}") for c in ("block", "root", "radius", "g")])
    pairs = _near_cells(trees, centres, reach).join(side("i", "a"), ["dim", "i"]).join(side("j", "b"), ["dim", "j"])
    gap = F.sqrt(F.aggregate(F.zip_with("root_a", "root_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    pairs = pairs.where((F.col("i") < F.col("j")) | (F.col("block_a") <= F.col("block_b"))).where(gap <= F.col("radius_a") + F.col("radius_b") + F.lit(reach + 1e-6))
    pairs = pairs.select(F.least("g_a", "g_b").alias("g"), F.greatest("g_a", "g_b").alias("h"), F.col("block_a").alias("a"), F.col("block_b").alias("b"))
    pairs = common.materialize(pairs, "tree-pairs")
    wanted = pairs.select("g", "h", F.col("a").alias("block"), "b").union(pairs.select("g", "h", F.col("b").alias("block"), F.lit(None).cast("long").alias("b")))
    wanted = wanted.groupBy("g", "h", "block").agg(F.collect_list("b").alias("partners"))
    shipped = wanted.join(trees.select("block", "n", "ids", "weights", "points", "nodes"), "block")
    # a number of parts of its own, as the work follows pairs of blocks and not the bytes by which small parts are put together
    shipped = shipped.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "g", "h")

    def work(t: pa.Table) -> pa.Table:
        get = {}
        for r in t.select(["block", "n", "ids", "weights", "points", "nodes"]).to_pylist():
            get[r["block"]] = (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["weights"], np.int64), *_load(r["n"], r["points"], r["nodes"]))
        found = _links(get, [(r["block"], b) for r in t.select(["block", "partners"]).to_pylist() for b in r["partners"]], least)
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["id", "links", "tie"])

    found = common.materialize(shipped.groupBy("g", "h").applyInArrow(work, "id long, links long, tie long"), "vector-links")
    comp = common.components(found.select(F.col("id").alias("u"), F.col("tie").alias("v")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    least_id = comp.join(same.select("id", "rep"), "id").groupBy("component_id").agg(F.min("rep").alias("c"))
    named = comp.join(least_id, "component_id").select("id", "c")
    classes = same.join(links, "id", "left").join(named, "id", "left").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("c", "rep").alias("c")
    )
    classes = common.materialize(classes, "vector-classes")
    common.discard(same, reps, trees, keys, pairs, found)
    bad = F.col("n").isNull()
    return every.join(classes, "vec", "left").select(
        F.col("id").alias("vec_id"), F.when(bad, F.lit(0)).otherwise(F.col("n")).cast("long").alias("n_links"),
        F.when(bad, F.col("id")).otherwise(F.col("c")).alias("component_id"),
        (bad | F.col("id").eqNullSafe(F.col("c"))).alias("kept"),
    )
