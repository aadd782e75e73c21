"""Row-level operators on hand-made and random tables."""

import random
import uuid

import pytest
from harrow.functions.places import haversine_km
from harrow.operators import clusters, dedup, joins, leads
from pyspark.sql import functions as F


def test_two_key_rule(spark):
    rows = [(1, "a", "1"), (2, "b", "1"), (3, "b", "2"), (4, "", "2"), (5, "", "")]
    df = spark.createDataFrame(rows, "id int, e string, p string")
    assert sorted(r.id for r in dedup.greedy_two_key(df, "e", "p", "id").collect()) == [1, 3, 5]


def test_two_key_rule_is_the_sequential_one(spark):
    r = random.Random(3)
    for _ in range(4):
        rows = [(i, r.choice(["", *"abcdefgh"]), r.choice(["", *"12345678"])) for i in range(40)]
        seen_e, seen_p, want = set(), set(), []
        for i, e, p in sorted(rows, key=lambda x: (x[1] == "", x[0])):
            if (e and e in seen_e) or (p and p in seen_p):
                continue
            want.append(i)
            seen_e |= {e} - {""}
            seen_p |= {p} - {""}
        df = spark.createDataFrame(rows, "id int, e string, p string")
        assert sorted(x.id for x in dedup.greedy_two_key(df, "e", "p", "id").collect()) == sorted(want)


def test_representative_takes_the_group_place(spark):
    df = spark.createDataFrame([(1, "k", 0, 90.0), (2, "k", 1, 3.0), (3, "", 1, 1.0)], "id int, k string, mail int, reviews double")
    (r,) = dedup.best_of_group(df, "k", [F.col("mail"), F.col("reviews")], "id").collect()
    assert (r.id, r.group_pos) == (2, 1)


def test_numbered(spark):
    df = spark.createDataFrame([(x,) for x in random.Random(1).sample(range(1000), 300)], "x int")
    got = [(r["No."], r.x) for r in dedup.numbered(df, [F.col("x")]).orderBy("`No.`").collect()]
    assert [n for n, _ in got] == list(range(1, 301)) and [x for _, x in got] == sorted(x for _, x in got)


def test_leaders(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 0.03), (2, 0.0, 0.06), (3, 0.0, 0.05)], "id int, lat double, lng double")
    assert {r.id: r.centre for r in clusters.leader_clusters(df, 4.5).collect()} == {0: 0, 1: 0, 2: 2, 3: 2}
    named = df.withColumn("name", F.concat(F.lit("n"), F.col("id")))
    assert {r.id: (r.covered, r.zoom) for r in clusters.centres_with_names(named, 4.5, 13).collect()} == {0: (["n0", "n1"], 13), 2: (["n2", "n3"], 13)}
    km = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d")).first().d
    assert abs(km - 111.19) < 0.01


def test_containment(spark):
    names = spark.createDataFrame([("alfafish",), ("lfa",), ("beta",), ("",), ("al",)], "k string")
    known = spark.createDataFrame([("alfa",)], "k string")
    assert {r.k for r in joins.without_contained(names, known, "k").collect()} == {"beta"}
    assert joins.without_contained(names, known.limit(0), "k").count() == 5


def test_containment_is_the_nested_loop(spark):
    """Names of every length up to 30 over few letters, so that all pieces are common."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("ab" if rng.random() < 0.5 else "abcdé") for _ in range(rng.choice([1, 2, 3, 5, 6, 7, 11, 12, 13, 30])))
    known = [word() for _ in range(60)]
    names = {word() for _ in range(150)} | {w[2:] for w in known} | {"x" + w + "y" for w in known[:30]}
    a, b = (spark.createDataFrame([(w,) for w in sorted(ws)], "k string") for ws in (names, set(known)))
    want = {n for n in names if n and not any(n in w or w in n for w in known if w)}
    long = [w for w in known if len(w) > 5]
    assert {r.k for r in joins.without_contained(a, b, "k").collect()} == want
    few = {n for n in names if n and not any(n in w or w in n for w in long)}
    assert {r.k for r in joins.without_contained(a, b.where("length(k) > 5"), "k").collect()} == few and few


def test_categories(spark):
    df = spark.createDataFrame([("Hotel de 3 estrelas ",), ("",), ("製造商",), ("小製造商",), (None,)], "c string")
    ok = lambda *a, **k: [r.x for r in df.select(joins.allowed(F.col("c"), *a, **k).alias("x")).collect()]
    assert ok(("hotel de 3 estrelas",), contains=True) == [True, True, False, False, True]
    assert ok(("hotel de 3 estrelas",), contains=True, blank=False) == [True, False, False, False, False]
    assert ok(("製造商",), lower=False) == [False, True, True, False, True]


def test_lead_scores(spark):
    rows = [("越南", "60人", "hr@a.tw", "不顯示", "製造工"), ("越南", "20", "hr@a.tw", "02-1234", "營造工"), ("無限制", "20", "", "02-1234", "營造工")]
    df = spark.createDataFrame(rows, "n string, q string, e string, p string, c string")
    s = leads.lead_score(*[F.col(x) for x in "nqepc"])
    got = df.select(s.alias("s"), leads.tier(s["score"]).alias("t")).collect()
    assert [(r.s.score, r.t.split()[0]) for r in got] == [(115, "HOT"), (55, "WARM"), (25, "COLD")]
    assert got[2].s.reasons == "Không giới hạn quốc tịch (+10), Số lượng tuyển vừa 20 người (+15)"


def test_next_pages(spark):
    html = "".join(f'<a href="{h}">{t}</a>' for h, t in (("/a", "x"), ("/b", "Book"), ("/c", "Contact"), ("/a", "find"), ("https://o.com/contact", "y"), ("#t", "z"), ("/d", "q"), ("/e", "q")))
    df = spark.createDataFrame([(1, "https://s.com/home", html)], "page_id int, url string, html string")
    got = [(r.link, r.priority) for r in leads.next_pages(df).orderBy("rank").collect()]
    assert got == [("https://s.com/c", 2), ("https://s.com/a", 2), ("https://s.com/b", 1), ("https://s.com/d", 0)]


def test_sync_and_grid(spark):
    base = spark.createDataFrame([("u1", ""), ("u2", "old")], "url string, Email string")
    new = spark.createDataFrame([("u1", "a", 1), ("u1", "b", 2), ("u2", "", 3)], "url string, Email string, n int")
    assert {tuple(r) for r in joins.sync_last(base, new, "url", "Email", "n").collect()} == {("u1", "b"), ("u2", "old")}
    loc = spark.createDataFrame([("Sydney", "NSW"), ("Perth", "WA")], "location string, state string")
    kw = spark.createDataFrame([("nail",), ("spa",)], "keyword string")
    done = spark.createDataFrame([("sydney", "nsw", "nail")], "location string, state string, keyword string")
    assert joins.open_grid(loc, kw, done, ["location", "state", "keyword"]).count() == 3
    out = spark.createDataFrame([("Sydney", "NSW", "Spa in Sydney"), ("Perth", "WA", "?")], "Location_Name string, State string, Search_Query string")
    assert {tuple(r) for r in joins.finished_from_output(out, ["nail", "spa"]).collect()} == {("sydney", "nsw", "spa"), ("perth", "wa", "nail")}


def test_places_within_reach_of_poles_and_date_line(spark):
    import math
    import random

    from harrow.operators.clusters import within

    r = random.Random(3)
    at = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(150)] + [(r.uniform(88, 90), r.uniform(-180, 180)) for _ in range(60)]
    at += [(r.uniform(-2, 2), r.choice([-180, 180]) + r.uniform(-2, 2)) for _ in range(80)] + [(60 + r.uniform(0, 3), r.uniform(10, 16)) for _ in range(80)]

    def km(a, b):
        (p, q), (s, t) = [tuple(map(math.radians, x)) for x in (a, b)]
        h = math.sin((s - p) / 2) ** 2 + math.cos(p) * math.cos(s) * math.sin((t - q) / 2) ** 2
        return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    df = spark.createDataFrame([(i, *x) for i, x in enumerate(at)], "id int, lat double, lng double")
    got = sorted((p.earlier, p.later) for p in within(df, 90.0).collect())
    assert got == sorted((i, j) for j in range(len(at)) for i in range(j) if km(at[i], at[j]) <= 90.0) and len(got) > 100


def test_crowded_place_pairs_are_spread(spark):
    from harrow.operators.clusters import within

    at = [(i, -40.0, 170.0) for i in range(60)] + [(100 + i, -40.1, 170.0) for i in range(30)] + [(500, None, 170.0), (501, 10.0, 170.0)]
    df = spark.createDataFrame(at, "id long, lat double, lng double").coalesce(1)
    pairs = within(df, 30.0, together=8)
    assert pairs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = [i for i, lat, _ in at if lat and lat < 0]
    assert sorted((p.earlier, p.later) for p in pairs.collect()) == [(i, j) for i in ids for j in ids if i < j]


def _read_in_order(rows):
    firsts, seconds, kept = set(), set(), []
    for i, e, p in sorted(rows, key=lambda r: (not r[1], r[0])):
        if not ((e and e in firsts) or (p and p in seconds)):
            kept.append(i)
            firsts |= {e} - {"", None}
            seconds |= {p} - {"", None}
    return sorted(kept)


@pytest.mark.parametrize("most", [1_000_000, 120])
def test_two_keys_with_long_chains(spark, most):
    """A chain in which each row is beaten by the one before it, a hot key, blanks and missing keys; with 120 rows a task the chain is a giant component."""
    rng = random.Random(2)
    n = 10_000 if most > 1000 else 500
    rows = [(i, f"e{(i + 1) // 2}", f"p{i // 2}") for i in range(n)]
    rows += [(n + i, rng.choice(["hot", "", None, f"x{rng.randint(0, 80)}"]), rng.choice(["", None, f"y{rng.randint(0, 80)}"])) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "i long, e string, p string")
    assert sorted(r.i for r in dedup.greedy_two_key(df, "e", "p", "i", most=most).collect()) == _read_in_order(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = dict(map(tuple, dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90} | {i: 200 for i in (200, 201, 202)}
    assert dedup.components(spark.createDataFrame([], "u long, v long")).count() == 0


def _leaders_in_order(rows, km):
    from math import asin, cos, radians, sin, sqrt

    centres, out = [], {}
    for i, lat, lng in sorted(rows):
        d = lambda c: 12742.0 * asin(min(1, sqrt(sin(radians(lat - c[1]) / 2) ** 2 + cos(radians(lat)) * cos(radians(c[1])) * sin(radians(lng - c[2]) / 2) ** 2)))
        hit = next((c[0] for c in centres if d(c) <= km), None)
        if hit is None:
            centres.append((i, lat, lng))
        out[i] = i if hit is None else hit
    return out


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_leaders_are_the_sequential_ones(spark, most):
    """A crowded city, a line of places in order, the date line, a pole, equal places and scattered ones; by one task, and by rounds and components."""
    rng = random.Random(6)
    at = [(rng.gauss(48, 0.05), rng.gauss(2, 0.08)) for _ in range(250)] + [(10 + 0.03 * k, 20.0) for k in range(90)] + [(0.0, 179.99 + 0.02 * k - 360 * (k > 0)) for k in range(5)]
    at += [(89.99, 120.0 * k) for k in range(3)] + [(-89.999, 0.0), (5.0, 5.0), (5.0, 5.0)] + [(rng.uniform(-60, 60), rng.uniform(-180, 180)) for _ in range(60)]
    if most == 60:
        rng.shuffle(at)
    rows = [(i, *p) for i, p in enumerate(at)]
    df = spark.createDataFrame([*rows, (9999, None, 1.0)], "id int, lat double, lng double")
    assert {r.id: r.centre for r in clusters.leader_clusters(df, 4.5, most=most).collect()} == _leaders_in_order(rows, 4.5)


def test_many_places_in_one_city(spark):
    """200,000 places within some ten reaches of each other: no pairs are made, so this takes seconds."""
    x = spark.range(200_000).select("id", (48 + F.rand(1) / 4).alias("lat"), (2 + F.rand(2) / 4).alias("lng"))
    x.write.mode("overwrite").parquet(path := f"{dedup.shared_root(spark)}/city-{uuid.uuid4().hex}")
    got = clusters.leader_clusters(spark.read.parquet(path), 4.5)
    assert got.count() == 200_000 and 10 < got.select("centre").distinct().count() < 100


def test_two_key_joins_pass_nothing_through_the_driver(spark):
    live = spark.createDataFrame([(1, "a", "p"), (2, "a", "q"), (3, "b", "q")], "_o int, e string, p string")
    left = dedup._without_kept(live, live.where("_o = 1"), ("e", "p"))
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()
    assert [r._o for r in left.collect()] == [3]
