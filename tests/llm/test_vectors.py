"""The vector operators against brute force."""

import numpy as np
import pytest
from harrow.llm import cover, mtree, vectors
from pyspark.sql import functions as F


def odd_rows():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 8))
    rows = [(100 + i, [float(x) for x in v]) for i, v in enumerate(base[rng.integers(0, 12, 260)] + rng.normal(size=(260, 8)) * rng.choice([0.02, 0.15, 0.4], 260)[:, None])]
    same = [float(x) for x in base[0]]
    rows += [(1000 + i, same) for i in range(30)]
    rows += [(1, None), (2, []), (3, [0.0] * 8), (4, [float("nan")] * 8), (5, [None] + [1.0] * 7), (6, [float("inf")] * 8), (7, [1.0, 2.0, 3.0]), (8, [1.0, 2.0, 3.0])]
    rows += [(9, [2 * x for x in same]), (40, [1.0, 2.0])]
    return rows


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def brute_links(rows, least=0.95):
    n = len(rows)
    ok = [usable(v) and any(v) for _, v in rows]
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), 10**9), rows[i][0])
    return {rows[i][0]: (links[i], low[find(i)], rows[i][0] == low[find(i)]) for i in range(n)}


@pytest.mark.parametrize("block", [16, 64, 2048])
def test_cover_tree(spark, block):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rep string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover.near_duplicates(df, block=block).collect()}
    assert got == brute_links(rows)


@pytest.mark.parametrize("block", [16, 2048])
def test_cover_tree_of_a_length_beyond_the_sample(spark, block):
    rng = np.random.default_rng(6)
    late = [r.id for r in spark.range(2000, 3000).orderBy(F.xxhash64("id").desc()).limit(40).collect()]
    rare = [(i, [float(x) for x in v]) for i, v in zip(late, np.arange(1, 6) + rng.normal(size=(40, 5)) * 0.5, strict=True)]
    rows = odd_rows() + rare
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert 5 not in vectors.pivots(vectors.valid(df).groupBy("vec").agg(F.min("id").alias("id")), 4, 8)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover.near_duplicates(df, block=block, sample=8).collect()}
    assert got == brute_links(rows) and any(got[i][0] for i, _ in rare)


def test_cover_tree_covers():
    x = np.random.default_rng(1).normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t, order = cover.build(x)
    p = x[order]
    assert sorted(order) == list(range(300))
    for k in range(len(t.centre)):
        assert np.linalg.norm(p[t.lo[k] : t.hi[k]] - p[t.centre[k]], axis=1).max() <= t.radius[k] + 1e-7
        if t.count[k]:
            kids = range(t.first[k], t.first[k] + t.count[k])
            assert [t.lo[c] for c in kids][0] == t.lo[k] and [t.hi[c] for c in kids][-1] == t.hi[k]


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover.near_duplicates(df, block=100).collect()}
    assert got == brute_links(rows)


def brute_top(rows, k=20, every=20):
    ints = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if usable(v)}
    out = set()
    for q in ints:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
            out |= {(q, r + 1, i, -m) for r, (m, i) in enumerate(s[:k])}
    return out


@pytest.mark.parametrize("page", [16, 100, 1024])
def test_top_k(spark, page):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(df, page=page, queries=5, pages_a_task=3).collect()}
    assert got == brute_top(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.top_k(df).count() == 0 and cover.near_duplicates(df).count() == 0


def test_cosines_of_extreme_doubles(spark):
    """Squares of these leave the doubles at either end; only directions count."""
    rows = [(1, [1e-170, 2e-170]), (2, [1e200, 2e200]), (3, [2e200, 4e200]), (4, [5e-324, 0.0]), (5, [1e308, 0.0]), (6, [0.0, 1.0]), (7, [0.0, 0.0])]
    rows += [(1, [3.0, 6.0]), (None, [0.0, 2.0])]
    got = cover.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(((r.vec_id, r.n_links) for r in got), key=repr) == sorted([(1, 3), (2, 3), (3, 3), (1, 3), (4, 1), (5, 1), (6, 1), (None, 1), (7, 0)], key=repr)
    assert {r.component_id for r in got if r.vec_id in (1, 2, 3)} == {1} and {r.component_id for r in got if r.vec_id in (4, 5)} == {4}


def test_products_beyond_doubles_and_repeated_ids(spark):
    """Scores between 2**53 and 2**63 are exact; ids that are missing take no part, those of several rows rank each of them."""
    import math
    import random

    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 4e6 for _ in range(6)]) for i in range(60)] + [(20, [1.0] * 6), (7, [3e6] * 6), (None, [4e6] * 6)]
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None]
    got = mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5).collect()
    want = {}
    for q, qv in whole:
        if q % 20 == 0:
            want.setdefault(q, []).extend((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in whole if i != q)
    assert max(abs(s) for x in want.values() for s, _ in x) > 2**53
    assert {(r.query_id, -r.score, r.vec_id) for r in got if r.query_id != 20} == {(q, *x) for q, xs in want.items() for x in sorted(xs)[:5] if q != 20}
    assert [r.rank for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)] == [1, 2, 3, 4, 5]


def test_a_score_beyond_64_bits_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e9, 1e9]), (1, [1e9, 1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OverflowError"):
        mtree.top_k(df).collect()


def test_blocks_of_long_vectors_are_smaller(spark):
    df = spark.createDataFrame([(1, [0.0] * 50_000), (2, [1.0])], "id long, vec array<double>")
    assert vectors.fitting(df, 4096, 16 << 20) == 41 and vectors.fitting(df.where("id = 2"), 4096, 16 << 20) == 4096 and vectors.fitting(df.limit(0), 64, 1) == 16


def test_far_points_are_nodes_of_their_own():
    x = np.random.default_rng(3).standard_normal((600, 64))
    x[500:] = x[:100] + 0.1 * x[500:]
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    tree, order = cover.build(x)
    few = (tree.hi - tree.lo > 1) & (tree.hi - tree.lo <= cover.LEAF)
    assert few.any() and tree.radius[few].max() < 0.5
    i, j, whole = cover.dual(tree, x[order], tree, x[order], 0.95)
    got = set(zip(i.tolist(), j.tolist()))
    for u, v in whole:
        got |= {(p, q) for p in range(tree.lo[u], tree.hi[u]) for q in range(tree.lo[v], tree.hi[v])}
    assert got == set(zip(*(a.tolist() for a in np.nonzero(x[order] @ x[order].T >= 0.95))))
