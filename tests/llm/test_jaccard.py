"""The n-gram Jaccard join against brute force."""

import random
import re

import pytest
from harrow.llm import jaccard

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    sets = {}
    for doc, text in rows:
        w = WORDS.findall((text or "").translate(UPPER))
        sets[doc] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    by = {}
    for d, x in sets.items():
        for t in x:
            by.setdefault(t, []).append(d)
    for d, x in sets.items():
        seen = {}
        for t in x:
            for e in by[t]:
                if e < d:
                    seen[e] = seen.get(e, 0) + 1
        for e, i in seen.items():
            if 100 * i >= 90 * (len(x) + len(sets[e]) - i):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(x), find(d)) for d, x in sets.items()}


def crowded(seed):
    """A base text with many near copies, a common passage, short texts, copies and nulls."""
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 3000)}"
    base = [word() for _ in range(120)]
    rows = [None, "", "A b", "a B", "one", " ".join(base), " ".join(base).upper()]
    for _ in range(120):
        t = list(base)
        for _ in range(r.randint(0, 6)):
            k = r.randrange(len(t))
            if r.random() < 0.5:
                t[k] = word()
            else:
                del t[k]
        rows.append(" ".join(t))
    passage = [word() for _ in range(30)]
    rows += [" ".join([word() for _ in range(r.randint(5, 60))] + passage) for _ in range(80)]
    rows += [" ".join(f"s{r.randint(0, 4)}" for _ in range(r.randint(3, 14))) for _ in range(60)]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("group", [2, 8, 32])
def test_crowded_groups(spark, group):
    rows = crowded(group)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, jaccard.Settings(group=group, heavy=50)).collect()}
    assert got == brute(rows)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert got == want
    kept = {r.doc_id for r in jaccard.keep_first(df).select("doc_id").collect()}
    assert kept == {d for d, (_, c) in want.items() if d == c}


def test_empty_table_and_null_id(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, None)], "doc_id long, text string")
    assert [r.component_id for r in jaccard.join(df).collect()] == [None, None]
    assert jaccard.join(df.limit(0)).count() == 0


def test_colliding_words_repeated_ids_and_clashing_names(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    w = [f"w{i}" for i in range(100)]
    rows = [(1, a), (2, b), (3, " ".join(w)), (3, "x y z"), (3, "x y z"), (4, "x Y z"), (5, " ".join(w) + " x y z"), (6, None), (6, "x y z"), (None, "x y z")]
    df = spark.createDataFrame([(*r, "c", "d") for r in rows], "doc_id long, text string, __gone__ string, _gone_0 string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    # 3 has the shingles of both texts, 99; 5 those and two more
    assert got == {1: (1, 1), 2: (1, 2), 3: (99, 3), 4: (1, 4), 5: (101, 3), 6: (1, 4), None: (1, None)}
    kept = jaccard.keep_first(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 3, 3, 4]
