"""Greedy leader clustering of places: each place joins the first earlier centre within a radius, else becomes one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from harrow.functions.places import EARTH_KM, haversine_km
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import _written, components, gone


def _cell(band: Column, lng: Column, radius_km: float) -> tuple[Column, Column]:
    """(longitude cell in a latitude band, number of cells of that band): a cell is as wide as the radius reaches there.

    The width is taken at the highest latitude that a place of the band or one in reach of it can have; near a pole
    the band is one cell.
    """
    step = radius_km / (EARTH_KM * np.pi / 180)
    high = F.radians((F.greatest(F.abs(band), F.abs(band + 1)) + 1) * F.lit(step))
    ratio = F.lit(float(np.sin(radius_km / EARTH_KM / 2))) / F.cos(high)
    wide = F.when((high < np.pi / 2) & (ratio < 1), F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0))))).otherwise(F.lit(360.0))
    n = F.greatest(F.lit(1), F.floor(F.lit(360.0) / (wide * 1.000001))).cast("long")
    return F.floor(F.pmod(lng, F.lit(360.0)) * n / 360).cast("long"), n


def _in_cells(df: DataFrame, radius_km: float) -> DataFrame:
    """df(lat, lng, ...) with the band and cell it lies in."""
    step = radius_km / (EARTH_KM * np.pi / 180)
    df = df.withColumn("band", F.floor(F.col("lat") / F.lit(step)).cast("long"))
    at, n = _cell(F.col("band"), F.col("lng"), radius_km)
    return df.withColumn("cell", F.pmod(at, n))


def _reached(df: DataFrame, radius_km: float) -> DataFrame:
    """df(lat, lng, ...) once for each band and cell that a place in its reach may lie in; cells wrap around at 360 degrees."""
    step = radius_km / (EARTH_KM * np.pi / 180)
    own = F.floor(F.col("lat") / F.lit(step)).cast("long")
    df = df.withColumn("band", F.explode(F.array(own - 1, own, own + 1)))
    at, n = _cell(F.col("band"), F.col("lng"), radius_km)
    near = F.array_distinct(F.array(*[F.pmod(at + d, n) for d in (-1, 0, 1)]))
    return df.withColumn("cell", F.explode(near))


def within(df: DataFrame, radius_km: float, row_id: str = "id", together: int = 256) -> DataFrame:
    """Pairs (earlier, later) of rows at most radius_km apart, by an equi-join of distinct places on latitude bands and longitude cells.

    A place meets those of its own and the neighbouring bands and cells, once for all rows that stand on it. Its rows are dealt to lists of about
    `together`; the lists of near places are spread over all tasks and become pairs there, so neither a crowded place nor a small table makes one long task.
    """
    rows = df.select(F.col(row_id).alias("id"), F.col("lat"), F.col("lng")).where("lat is not null and lng is not null")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sites = _written(rows.groupBy("lat", "lng").agg(F.count(F.lit(1)).alias("n")))
    a = _reached(sites.select("lat", "lng"), radius_km).repartition(parts, "band", "cell").withColumnsRenamed({"lat": "la", "lng": "ga"})
    b = _in_cells(sites.select("lat", "lng"), radius_km).withColumnsRenamed({"lat": "lb", "lng": "gb"})
    near = a.join(b, ["band", "cell"]).where("la < lb or (la = lb and ga <= gb)")
    near = near.where(haversine_km(F.col("la"), F.col("ga"), F.col("lb"), F.col("gb")) <= radius_km).select("la", "ga", "lb", "gb")
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / F.lit(together)).cast("long"))
    lists = _written(rows.join(sites, ["lat", "lng"]).groupBy("lat", "lng", chunk.alias("c")).agg(F.collect_list("id").alias("ids")))
    side = lambda x: lists.select(F.col("lat").alias(f"l{x}"), F.col("lng").alias(f"g{x}"), F.col("c").alias(f"c{x}"), F.col("ids").alias(f"ids_{x}"))
    met = near.join(side("a"), ["la", "ga"]).join(side("b"), ["lb", "gb"]).where("la < lb or ga < gb or ca <= cb")
    met = met.withColumn("own", F.expr("la = lb and ga = gb and ca = cb")).repartition(parts, "la", "ga", "ca", "lb", "gb", "cb")
    pairs = met.select("own", "ids_b", F.explode("ids_a").alias("a")).select("own", "a", F.explode("ids_b").alias("b"))
    return pairs.where("a < b or (a > b and not own)").select(F.least("a", "b").alias("earlier"), F.greatest("a", "b").alias("later"))


def _first_come(radius_km: float):
    """mapInArrow function: the centres among places that come in order. Only centres are remembered, by cells about as wide as the radius."""

    def run(batches):
        step = radius_km / (EARTH_KM * np.pi / 180)
        half = np.sin(radius_km / EARTH_KM / 2)
        centres: dict[tuple[int, int], list[tuple[float, float, float]]] = {}

        def cells_of_band(band: int) -> int:
            high = np.radians((max(abs(band), abs(band + 1)) + 1) * step)
            ratio = half / np.cos(high) if high < np.pi / 2 else 1.0
            return max(1, int(360 / (np.degrees(2 * np.arcsin(ratio)) * 1.000001))) if ratio < 1 else 1

        wide: dict[int, int] = {}
        for batch in batches:
            ids, lats, lngs = (batch.column(c) for c in range(3))
            keep = []
            for lat, lng in zip(lats.to_pylist(), lngs.to_pylist(), strict=True):
                phi, lam, band = np.radians(lat), np.radians(lng), int(np.floor(lat / step))
                hit = False
                for b in (band - 1, band, band + 1):
                    n = wide.get(b) or wide.setdefault(b, cells_of_band(b))
                    at = int(np.floor(lng % 360.0 * n / 360))
                    for cell in {(at - 1) % n, at % n, (at + 1) % n}:
                        for y, x, cos in centres.get((b, cell), ()):
                            h = np.sin((y - phi) / 2) ** 2 + cos * np.cos(phi) * np.sin((x - lam) / 2) ** 2
                            if 2 * EARTH_KM * np.arcsin(min(1.0, np.sqrt(h))) <= radius_km:
                                hit = True
                                break
                        if hit:
                            break
                    if hit:
                        break
                keep.append(not hit)
                if not hit:
                    n = wide[band]
                    centres.setdefault((band, int(np.floor(lng % 360.0 * n / 360)) % n), []).append((phi, lam, np.cos(phi)))
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(keep, pa.bool_())), lats.filter(pa.array(keep, pa.bool_())), lngs.filter(pa.array(keep, pa.bool_()))], ["id", "lat", "lng"])

    return run


def leaders(df: DataFrame, radius_km: float, *, most: int = 1_000_000, rounds: int = 3) -> DataFrame:
    """The centres among df(id, lat, lng): in order of id, a place becomes one unless an earlier centre is within reach. Written.

    Pairs of places are never made. Up to `most` places are read in order by one task that remembers centres alone, of which a cell holds a few.
    Of more, some rounds go first: a place that comes before all undecided ones of every cell in its reach is a centre, and what
    centres reach is decided. Then components of neighbouring occupied cells of up to `most` undecided places are read in order side by side,
    and larger ones go on in rounds.
    """
    sides = df.schema["id"].dataType.simpleString()
    schema = f"id {sides}, lat double, lng double"
    live = _written(df.select("id", F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng")))
    found: list[DataFrame] = []

    def undecided(left: DataFrame, centres: DataFrame) -> DataFrame:
        near = _reached(centres.select(F.col("lat").alias("lat"), F.col("lng").alias("lng")), radius_km).withColumnsRenamed({"lat": "cy", "lng": "cx"})
        hit = _in_cells(left, radius_km).join(near, ["band", "cell"]).where(haversine_km(F.col("cy"), F.col("cx"), F.col("lat"), F.col("lng")) <= radius_km)
        return _written(left.join(hit.select("id").distinct(), "id", "left_anti"))

    while live.count() > most:
        for _ in range(rounds):
            heads = _in_cells(live, radius_km).groupBy("band", "cell").agg(F.min(F.struct("id", "lat", "lng")).alias("h"))
            heads = _written(heads)
            first = heads.select("band", "cell", F.col("h.id").alias("other"))
            seen = _reached(heads.select("h.*"), radius_km).join(first, ["band", "cell"]).where("other < id").select("id").distinct()
            centres = _written(heads.select("h.*").join(seen, "id", "left_anti"))
            found.append(centres)
            last, live = live, undecided(live, centres)
            gone(heads, last)
        if live.count() <= most:
            break
        placed = _written(_in_cells(live, radius_km).withColumn("key", F.xxhash64("band", "cell")))
        near = _reached(placed.select("key", "lat", "lng"), radius_km).select("key", F.xxhash64("band", "cell").alias("v")).distinct()
        there = placed.select(F.col("key").alias("v")).distinct()
        known = components(near.join(there, "v", "left_semi").select(F.col("key").alias("u"), "v"))
        put = placed.join(known, placed["key"] == known["id"], "left").select(placed["id"], "lat", "lng", F.coalesce("component_id", "key").alias("component"))
        put = _written(put)
        small = put.groupBy("component").count().where(F.col("count") <= most).select("component")
        whole = put.join(small, "component", "left_semi").repartition("component").sortWithinPartitions("id").select("id", "lat", "lng")
        found.append(_written(whole.mapInArrow(_first_come(radius_km), schema)))
        last, live = live, _written(put.join(small, "component", "left_anti").select("id", "lat", "lng"))
        gone(last, placed, known, put)
    found.append(_written(live.repartition(1).sortWithinPartitions("id").mapInArrow(_first_come(radius_km), schema)))
    gone(live)
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    out = _written(every)
    gone(*found)
    return out


def leader_clusters(df: DataFrame, radius_km: float, row_id: str = "id", *, most: int = 1_000_000) -> DataFrame:
    """df(row_id, lat, lng, ...) with `centre`: the row_id of the first centre in reach, its own for a centre.

    row_id is unique and orders the places. Each place meets the centres in its reach, which are few as no two of them are within reach of
    each other. Places without coordinates are left out.
    """
    df = df.where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    places = df.select(F.col(row_id).alias("id"), "lat", "lng")
    centres = leaders(places, radius_km, most=most)
    near = _reached(centres.select(F.col("id").alias("c"), "lat", "lng"), radius_km).withColumnsRenamed({"lat": "cy", "lng": "cx"})
    met = _in_cells(places, radius_km).join(near, ["band", "cell"])
    # a hair more than the radius, as the two ways of measuring may differ in the last digit
    met = met.where((F.col("c") == F.col("id")) | (haversine_km(F.col("cy"), F.col("cx"), F.col("lat"), F.col("lng")) <= radius_km * (1 + 1e-12)))
    first = met.groupBy("id").agg(F.min("c").alias("c"), F.max(F.col("c") == F.col("id")).alias("own"))
    final = first.select(F.col("id").alias(row_id), F.when(F.col("own"), F.col("id")).otherwise(F.col("c")).alias("centre"))
    return df.join(final, row_id)


def centres_with_names(df: DataFrame, radius_km: float, zoom: int, name: str = "name", row_id: str = "id") -> DataFrame:
    """One row a centre with zoom and the distinct names it covers, in input order."""
    c = leader_clusters(df, radius_km, row_id)
    covered = c.groupBy("centre", name).agg(F.min(row_id).alias("_at")).groupBy("centre").agg(F.array_sort(F.collect_list(F.struct("_at", name))).alias("x"))
    covered = covered.select(F.col("centre").alias(row_id), F.transform("x", lambda x: x[name]).alias("covered"))
    return df.join(covered, row_id).withColumn("zoom", F.lit(zoom))

