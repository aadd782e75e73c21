"""The pipeline stage by stage against brute force."""

import re
import zlib

import corpus_pipeline
import numpy as np
from harrow.llm import packing, secrets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = {}
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        result = stage(spark, docs, sf)
        path = str(tmp_path / name)
        result.write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
        out[name] = (before, kept)
        if name != "best_fit_packing":
            assert kept.columns == docs.columns
            for r in kept.collect():
                assert r.n_chars == len(r.text)
        docs = kept
    before, kept = out["quality_classifier"]
    ids = {r.doc_id for r in kept.collect()}
    known = [d for d in before if d in labels]
    assert sum((d in ids) == labels[d] for d in known) / len(known) > 0.97

    before, kept = out["ngram_jaccard_join"]
    sets = {}
    for d, t in before.items():
        w = WORDS.findall(t.translate({i: i + 32 for i in range(65, 91)}))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = {r.doc_id for r in kept.collect()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[:k]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
                i = len(x & y)
                if 100 * i >= 80 * (len(x) + len(y) - i):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    assert ids == {d for d in sets if find(d) == d}

    before, kept = out["substring_dedup"]
    seen = set()
    texts = {r.doc_id: r.text for r in kept.collect()}
    for d in sorted(before):
        w = WORDS.findall(before[d])
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            gone[i : i + 20] |= key in seen
            seen.add(key)
        assert WORDS.findall(texts[d]) == [x for x, g in zip(w, gone) if not g]

    before, kept = out["secret_scan"]
    for r in kept.collect():
        assert not secrets.base_spans(r.text)
        assert r.text == before[r.doc_id] or "<secret>" in r.text

    before, kept = out["best_fit_packing"]
    e = packing.encoder(packing.default_vocabulary())
    rows = kept.collect()
    for d, t in before.items():
        ids = np.concatenate([np.frombuffer(e.encode([t])[0], "<u4"), [2]]).astype("<u4")
        own = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)


def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows and doc_ids, clashing names and an empty table through every stage."""
    sf = "/root/testdata/sf0.001"
    good = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(4).collect()]
    rows = [*good, good[1], (good[2][0], "another text of one id"), (None, good[0][1]), (None, None), (900, None), (901, ""), (902, "a " * 4000), (903, good[3][1])]
    names = "doc_id long, text string, n_chars long, __score__ string, _score_0 double, __gone__ int, __starts__ string, _starts_0 string, _copy_0 string, rank int, row string, gap long"
    df = spark.createDataFrame([(i, t, len(t or ""), "s", 0.0, 1, "x", "y", "z", 5, "r", 7) for i, t in rows], names)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, sf)
        none = stage(spark, df.limit(0), sf)
        assert none.count() == 0 and none.columns == out.columns
        got = out.collect()
        if name == "best_fit_packing":
            assert sum(r.piece == 0 for r in got) == len(rows)
            continue
        assert out.columns == df.columns
        assert all((r["__score__"], r["_score_0"], r["__starts__"], r["_copy_0"], r["rank"], r["gap"]) == ("s", 0.0, "x", "z", 5, 7) for r in got)
        texts = [(r.doc_id, r.text) for r in got]
        if name != "quality_classifier":
            assert (None, None) in texts and (900, None) in texts and (901, "") in texts
            assert sum(i is None for i, _ in texts) == 2
        if name == "ngram_jaccard_join":
            assert 903 not in [i for i, _ in texts] and [i for i, _ in texts].count(good[1][0]) == 2
        if name == "substring_dedup":
            assert (903, "") in texts and dict(texts)[902] == "a"
