"""Split CSV files, zipped tables, site crawls and work until it succeeds."""

import csv
import random

import pytest
from harrow.plans import crawl
from harrow.sources import split_csv, tables
from harrow.streaming import resume

BITS = ["a", '"b"', '"x\ny"', '5" pipe', '""', '"q""r"', '"a,b"', "", "é", '"\n\n\n"', 'c"d"', '"end"x', '"' + "long\n" * 50 + '"', ' "lead"']


@pytest.fixture()
def splits(spark):
    """Sets the size of splits; everything else as before afterwards."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def small(size):
        for n, v in zip(names, (size, "1b"), strict=True):
            spark.conf.set(n, v)

    yield small
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed", range(4))
def test_records_are_those_of_one_reader(spark, tmp_path, splits, seed):
    """Marks, both line endings, ragged rows, stray quotes, cells over many splits, a quote that never closes; splits of any size."""
    rng = random.Random(seed)
    body = "".join(",".join(rng.choice(BITS) for _ in range(rng.randint(1, 4))) + rng.choice(["\n", "\r\n"]) for _ in range(200))
    text = "﻿" * (seed % 2) + "h1,h2,h3\n" + body + ('"open\nto the end' if seed == 2 else "")
    path = tmp_path / "f.csv"
    path.write_bytes(text.encode())
    with open(path, encoding="utf-8-sig") as f:
        want = list(csv.reader(f))
    for size in ("97b", "1000b", "128m"):
        splits(size)
        df = split_csv.read_records(spark, str(path))
        assert [r.cells for r in sorted(df.collect(), key=lambda r: (r.block, r.seq))] == want


def test_several_files_and_empty_ones(spark, tmp_path, splits):
    for name, text in (("a", "x,y,x\n1,2,3\n\n4\n"), ("b", '﻿x,y,x\n"5\n6",7,8,9\n'), ("c", ""), ("d", "x,y,x\n")):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    for size in ("5b", "128m"):
        splits(size)
        df = tables.read_csv(spark, str(tmp_path))
        assert df.columns == ["x", "y"] and {tuple(r) for r in df.collect()} == {("3", "2"), ("", ""), ("8", "7")}
        assert {tuple(r) for r in tables.read_positional(spark, str(tmp_path), {0: "p", 3: "q"}).collect()} == {("1", ""), ("4", ""), ("5\n6", "9")}
    assert tables.read_csv(spark, str(tmp_path / "c.csv"), ("x",)).count() == 0


def test_states_of_splits_are_strung_together(spark):
    """Every string of splits that keep, set or turn the state, against walking it."""
    rng = random.Random(1)
    kinds = {"keep": (False, True), "open": (True, True), "shut": (False, False), "turn": (True, False)}
    rows, want = [], {}
    for f in range(30):
        state = False
        for k in range(rng.randint(1, 12)):
            out = kinds[rng.choice(sorted(kinds))]
            rows.append((f"f{f}", 10 * k, 100 * f + k, *out))
            want[100 * f + k] = state
            state = out[state]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, block long, split long, out0 boolean, out1 boolean").repartition(3)
    assert {r.split: r.inside for r in split_csv.start_states(df).collect()} == want


def test_work_until_it_succeeds(spark, tmp_path):
    src, root, schema = str(tmp_path / "in"), f"file://{tmp_path}/work", "k long, v string"
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (1, "a")], schema).write.parquet(src)
    asked = []

    def run(good, now, **more):
        def work(due):
            asked.append(sorted(r.k for r in due.collect()))
            rows = due.where("k <> 3")
            return rows.selectExpr("k", f"CASE WHEN k IN ({', '.join(map(str, good)) or -1}) THEN true WHEN k = 2 THEN CAST(NULL AS boolean) ELSE false END AS ok", "v")

        return resume.run_until_done(spark, src, schema, "k", work, root, most=3, now=now, **more)

    got = lambda: sorted((r.k, r.attempt) for r in resume.results(spark, root).collect())
    assert run([1], 0) == 1 and asked[-1] == [1, 2, 3] and got() == [(1, 1)]  # no row for 3 and no flag for 2 are failures
    assert run([2], 5, wait=10) == 0 and len(asked) == 1  # too early
    assert run([2], 10, wait=10) == 2 and asked[-1] == [2, 3] and got() == [(1, 1), (2, 2)]
    spark.createDataFrame([(4, "d"), (2, "again")], schema).write.mode("append").parquet(src)
    assert run([4], 20, wait=10) == 3 and asked[-1] == [4]  # 3 waits twice as long now
    assert run([], 30, wait=10) == 4 and asked[-1] == [3] and run([3], 1000) == 0  # three attempts are the most
    assert got() == [(1, 1), (2, 2), (4, 3)]


def test_an_attempt_that_breaks_off_adds_nothing_twice(spark, tmp_path, monkeypatch):
    src, root, schema = str(tmp_path / "in"), f"file://{tmp_path}/work", "k long"
    spark.createDataFrame([(1,), (2,)], schema).write.parquet(src)
    spark.createDataFrame([(1, True), (9, True)], "k long, ok boolean").write.parquet(f"{root}/results/attempt=1")  # rows written, progress not
    assert resume.results(spark, root) is None
    assert resume.run_until_done(spark, src, schema, "k", lambda due: due.selectExpr("k", "k = 2 AS ok"), root) == 1
    assert [(r.k, r.attempt) for r in resume.results(spark, root).collect()] == [(2, 1)]
    assert resume.run_until_done(spark, src, schema, "k", lambda due: due.selectExpr("k", "true AS ok"), root) == 2
    assert resume.run_until_done(spark, src, schema, "k", lambda due: due.selectExpr("k", "true AS ok"), root) == 0
    assert sorted((r.k, r.ok) for r in resume.progress(spark, root, "k").collect()) == [(1, False), (1, True), (2, True)]


def test_sites_in_the_order_they_are_searched(spark):
    sites = [(1, "a.nz"), (2, "b.nz"), (3, None), (4, "http://m.facebook.com/x"), (5, "instagram.com/y"), (6, "gone.nz"), (None, "a.nz"), (7, "c.nz")]
    links = "".join(f"<a href='/p{k}'>{w}</a>" for k, w in enumerate(["x", "us", "contact", "find", "about", "store"]))
    pages = [
        ("https://a.nz", links + "<a href='https://facebook.com/never'>"), ("https://a.nz", "me@a.nz"), ("https://facebook.com/never", "no@a.nz"), ("https://a.nz/p2", "late@a.nz"),
        ("https://b.nz", links), ("https://b.nz/p1", "fifth@b.nz"), ("https://b.nz/p5", "p5@b.nz <a href='instagram.com/b'>"), ("https://b.nz/p2", "p2@b.nz p5@b.nz"),
        ("http://www.facebook.com/x", "<a href='mailto:FB@x.nz'>"), ("https://instagram.com/y", "<a href='mailto:no@y.nz'>only@y.nz"), (None, "x@y.zz"),
        ("https://c.nz", "<a href='/contact'>"), ("https://c.nz/contact", "<a href='https://instagram.com/c2'><a href='facebook.com/c'>"), ("https://instagram.com/c2", "ig@c.nz"), ("https://www.facebook.com/c", None),
    ]
    s, p = spark.createDataFrame(sites, "site long, website string"), spark.createDataFrame(pages, "url string, html string").repartition(4)
    got = {r.site: (r.source, r.email) for r in crawl.site_contacts(s, p).collect()}
    assert got == {
        1: ("site", "me@a.nz"), 2: ("subpages", "p2@b.nz, p5@b.nz"), 3: ("none", ""), 4: ("facebook", "fb@x.nz"), 5: ("instagram", "only@y.nz"), 6: ("none", ""), 7: ("instagram", "ig@c.nz"),
    }
    assert {r.source for r in crawl.site_contacts(s, p.limit(0)).collect()} == {"none"} and crawl.site_contacts(s.limit(0), p).count() == 0


def test_zipped_tables(spark, tmp_path):
    """Several members, one of 30 MB that packs to little, other files, short lines, bytes that aren't UTF-8 and an empty member."""
    import zipfile

    big = "\n".join(f"{i}\tname {i}\t{'x' * 60}" for i in range(400_000))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.txt", big)
        z.writestr("sub/small.txt", b"1\tZo\xc3\xab\tx\r\nshort\t2\n2\tbad\xff\tx\n\n")
        z.writestr("readme.md", "1\tno\tx")
        z.writestr("empty.txt", "")
        z.mkdir("folder.txt")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("c.txt", "7\tseven\tx\tmore")
    df = tables.read_zipped_tsv(spark, str(tmp_path / "*.zip"), 3, {1: "name", 0: "id"}, "*.txt")
    assert df.columns == ["member", "name", "id"] and df.where("member = 'big.txt'").count() == 400_000
    assert {tuple(r) for r in df.where("member <> 'big.txt'").collect()} == {("sub/small.txt", "Zoë", "1"), ("sub/small.txt", "bad�", "2"), ("c.txt", "seven", "7")}


def test_long_sheets_leave_the_tree(tmp_path):
    """Rows that are read are dropped: the parser's memory doesn't follow the sheet's length."""
    import tracemalloc

    from harrow.sources import xlsx

    path = str(tmp_path / "b.xlsx")
    xlsx.write_book(path, "Raw", ["a", "b"], ((i, f"text {i}") for i in range(60_000)))
    tracemalloc.start()
    assert sum(1 for _ in xlsx.read_rows(path, "Raw", 2)) == 60_000
    assert tracemalloc.get_traced_memory()[1] < 8_000_000
    tracemalloc.stop()
