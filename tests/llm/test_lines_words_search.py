"""Line dedup, spelling variants and ranked search against brute force, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from harrow.llm import lines, ranked, spelling
from pyspark.sql import functions as F

LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string"


def lines_by_hand(rows, documents=10):
    key = lambda x: x.strip("\t\n\x0b\x0c\r ").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for k in map(key, (t or "").split("\n")):
            if k and i is not None:
                holders[k].add(i)
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(holders[key(x)]) < documents]
        out.append((i, len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_lines(spark):
    rng = random.Random(4)
    shared = ["All rights reserved", " ALL RIGHTS reserved\t", "\x0bx\x0c", "", "   ", "É", "é", "rare"]
    rows = [(i, "\n".join(rng.choice(shared) if rng.random() < 0.6 else f"own {i} {rng.random()}" for _ in range(rng.randint(1, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "a\r\nx"), (104, "x\n" * 30_000 + "end"), (105, "x\n" + "y" * 200_000)]
    rows += [(7, rows[7][1]), (7, "x\nother"), (None, "x\nrare"), (None, "x\nrare")] + [(200, "once\n twice")] * 12
    got = sorted(map(repr, (tuple(r) for r in lines.digests(spark.createDataFrame(rows, DOCS).repartition(3)).collect())))
    assert got == sorted(map(repr, lines_by_hand(rows)))


def test_lines_at_the_threshold_and_other_columns(spark):
    rows = [(i, "nine\nTEN" if i < 9 else "ten" if i == 9 else "nothing", i, "q") for i in range(11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, `h1 k` string")
    out = {r.doc_id: r for r in lines.without_common_lines(df).collect()}
    assert (out[0].text, out[0].n_dropped, out[9].text, out[10].text, out[0]["h1 k"], out[0].n_lines) == ("nine", 1, "", "nothing", "q", 2)
    assert lines.without_common_lines(df.limit(0)).count() == 0 and lines.digests(df.limit(0).select("doc_id", "text")).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def words_by_hand(rows, every=199, times=5):
    n = Counter()
    for i, t in rows:
        for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            x = x.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{x}".encode())
            if h % every == 0:
                x = x[: h % len(x)] + x[h % len(x) + 1 :]
            n[x] += len(x) >= 6
    n = {w: c for w, c in n.items() if c >= 5}

    def one_edit(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= times * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abcdé÷"])
def test_spelling(spark, letters):
    """Few letters give many repeated bigrams, chains of forms and ties."""
    rng = random.Random(len(letters))
    stock = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(60)]
    stock += [w[:k] + w[k + 1 :] for w in stock[:20] for k in (0, 3, len(w) - 1)] + ["aaaaaaaa", "aaaaaaa", "aaaaaab"]
    weight = [6 ** rng.randint(0, 3) for _ in stock]
    rows = [(i, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(stock, weight, k=300))) for i in range(40)]
    rows += [(None, stock[0] + "1" + stock[1]), (50, None), (51, ""), (52, "ÀÉabcd, àéABCD-x"), (3, rows[3][1])] + [(60 + k, "chainsx " * 6 + "chainsxx " * 40 + "chainsxxx " * 300) for k in range(2)]
    got = sorted((tuple(r) for r in spelling.variants(spark.createDataFrame(rows, DOCS).repartition(3), every=7).collect()), key=repr)
    want = words_by_hand(rows, every=7)
    assert got == want and sum(r[1] is not None for r in want) > 5
    assert any(r[1] != r[2] for r in want if r[1])


def test_spelling_long_words_and_empty_tables(spark):
    long = "ab" * 20_000
    rows = [(1, f"{long} " * 5 + f"{long}x " * 30)]
    got = {r.word[-3:]: (r.n, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {"bab": (5, 1, 30), "abx": (30, 1, None)}
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string, word string")).count() == 0
    with pytest.raises(ValueError, match="4 at least"):
        spelling.variants(spark.createDataFrame([], DOCS), least_chars=3)


def search_by_hand(rows, items, k=50):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(i, Counter(terms(t))) for i, t in rows]
    n, total = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            scored += [(s, i)] if s > 0 else []
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("postings", "together", "block"), [(1 << 20, 16 << 20, 128), (300, 16 << 20, 4), (1000, 400, 16)])
def test_search(spark, monkeypatch, postings, together, block):
    """One segment, many of them, and items and terms in many rounds without a restricted index, all give the same."""
    monkeypatch.setattr(ranked, "TOGETHER", together)
    monkeypatch.setattr(ranked, "BLOCK", block)
    monkeypatch.setattr(ranked, "SEGMENT", postings)
    monkeypatch.setattr(ranked, "_STRETCH", 16)
    build = ranked.build_index
    monkeypatch.setattr(ranked, "build_index", lambda *a: build(*a, most=postings))
    rng = random.Random(5)
    stock = [f"W{int(30 * rng.random() ** 3)}" if rng.random() < 0.8 else "Straße-é" for _ in range(200)]
    rows = [(i, " ".join(rng.choices(stock, k=rng.randint(1, 40)))) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(1000, 1080)] + [(None, "w1 w2"), (None, "w1 w2"), (9, rows[9][1]), (2000, None), (2001, ""), (2002, "!?"), (2003, "w3 " * 20_000)]
    items = [(1, "W1 w2 w2, w28"), (2, "straße é w5"), (2, "w7"), (3, None), (4, ""), (5, "nowhere"), (None, "w0 w1"), (6, rows[5][1])]
    d, b = spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in ranked.search(d, b, first_of=3).collect()), key=repr)
    assert got == search_by_hand(rows, items)
    assert ranked.search(d.limit(0), b).count() == 0 and ranked.search(d, b.limit(0)).count() == 0


def test_packed_numbers_and_passed_blocks():
    rng = np.random.default_rng(1)
    for bits in (0, 1, 7, 20, 40):
        v = rng.integers(0, 1 << bits, 100) if bits else np.zeros(100, np.int64)
        assert (ranked.unpacked(b"x" + ranked.packed(v, bits), 1, 100, bits) == v).all()
    # one document of 2000 repeats its term: with its score as the floor a single block of the sixteen is unpacked
    n = 2000
    row = ranked.segment(list(range(n)), [10] * n, {b"t": 0}, [0] * n, list(range(n)), [9 if i == 700 else 1 for i in range(n)], (n, 10 * n))
    s = ranked.Segment(row)
    (best,) = s.best([("t", 3)], 1, 0)
    assert best[1] == 700
    t = ranked.Segment(row)
    assert t.best([("t", 3)], 1, best[0]) == [best] and len(t.open) == 1


def test_term_counts():
    texts = ["", None, "a", " a b", "a", "é-x", "\x7f!", "Z9 z", "end"]
    for part in (pa.array(texts), pa.array(["pad", *texts, "pad"]).slice(1, len(texts)), pa.array([], pa.string())):
        want = [len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for t in part.to_pylist()]
        assert ranked.term_counts(part).tolist() == want


def test_search_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "w1 w2", "a", 3), (2, "w3", "b", 4), (3, "w4", "b", 4)], "doc_id long, text string, term string, score int")
    items = df.select(F.col("doc_id").alias("item_id"), "text", "term", F.lit(1).alias("doc_id"))
    assert [(r.item_id, r.doc_id) for r in ranked.search(df, items).orderBy("item_id").collect()] == [(1, 1), (2, 2), (3, 3)]
