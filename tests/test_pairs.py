"""Pairs of polygons and of points and polygons are decided where they meet: they are not shuffled, and large places give the same."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from terrane.operators import geometry as G
from terrane.operators import overlap as O


def stars(spark, name, n, seed, spread=3.0):
    rng, rows = random.Random(seed), []
    for k in range(n):
        cx, cy = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        for part in (1, 2):
            x, y, radii = cx + 9 * part, cy, [rng.uniform(1, 4) for _ in range(7)]
            ring = [(x + r * math.cos(math.tau * i / 7), y + r * math.sin(math.tau * i / 7)) for i, r in enumerate(radii)]
            rows += [(f"{name}{k}", part, 0, i + 1, *p) for i, p in enumerate([*ring, ring[0]])]
    return G.edges(spark.createDataFrame(rows, "place_id string, part int, ring int, seq int, x double, y double"))


def shuffled(spark, df):
    """Rows that running ``df`` writes to shuffles."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    stages = lambda: spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    total = lambda: sum(s.apply(i).shuffleWriteRecords() for s in [stages()] for i in range(s.size()))
    before = total()
    df.write.format("noop").mode("overwrite").save()
    return total() - before


def test_pairs_are_not_shuffled(spark):
    a, b = stars(spark, "a", 120, 1), stars(spark, "b", 120, 2)
    pairs = O.polygon_overlap(a, b)
    assert pairs.count() > 13_000
    assert shuffled(spark, pairs) < 40_000
    assert shuffled(spark, O.derive_intersect(a, b, 5.0, 0.5)) < 40_000
    extra = a.groupBy("place_id").agg(F.count("*").alias("n"))
    assert shuffled(spark, O.polygon_overlap(a, b, left=extra, right=extra)) < 40_000


def test_points_are_shuffled_once(spark):
    points = spark.range(2_000).selectExpr("id as point_id", "cast(id % 50 as double) / 5 + 4.013 as lon", "cast(id div 50 as double) / 10 - 2.007 as lat")
    found = O.points_in_polygons(points, stars(spark, "a", 120, 1))
    assert found.count() > 30_000
    assert shuffled(spark, found) < 20_000


@pytest.mark.parametrize("keys", [(), ("part",)])
def test_small_and_large_places_agree(spark, monkeypatch, keys):
    a, b = stars(spark, "a", 12, 3, 12), stars(spark, "b", 12, 4, 12)
    rows = lambda df: {tuple(r)[:-1]: r["area"] for r in df.collect()}
    pieces = lambda: {(r["a_id"], r["b_id"]): (r["reason"], r["fragments"], round(r["area"] or 0, 9), round(r["lost"] or 0, 9)) for r in O.derive_intersect(a, b, 5.0, 0.5).collect()}
    packed, packed_pieces = rows(O.polygon_overlap(a, b, keys=keys)), pieces()
    monkeypatch.setattr(O, "PACKED", 0)
    dealt = rows(O.polygon_overlap(a, b, keys=keys))
    assert packed and packed == pytest.approx(dealt, rel=1e-9, abs=1e-9)
    assert packed_pieces == pieces()


def test_columns_of_both_sides(spark):
    a, b = stars(spark, "a", 5, 3), stars(spark, "b", 5, 4)
    left, right = (x.groupBy("place_id").agg(F.count("*").alias("n")) for x in (a.where("place_id != 'a0'"), b))
    got = O.polygon_overlap(a, b, left=left, right=right.withColumnRenamed("n", "m"))
    assert got.columns == ["a_id", "b_id", "a_n", "b_m", "area"]
    assert {r["a_id"] for r in got.collect()} == {"a1", "a2", "a3", "a4"}
    assert {(r["a_n"], r["b_m"]) for r in got.collect()} == {(14, 14)}


def test_even_odd_by_columns_and_by_arrays(spark, monkeypatch):
    e = stars(spark, "a", 30, 5)
    points = spark.range(1_000).selectExpr("id as point_id", "cast(id % 40 as double) / 3 + 4.013 as lon", "cast(id div 40 as double) / 4 - 3.007 as lat", "id * 2 as v")
    every = e.crossJoin(points.select("point_id", "lon", "lat", "v")).where("(ya > lat) != (yb > lat) and lon < (xb - xa) * (lat - ya) / (yb - ya) + xa")
    want = {tuple(r) for r in every.groupBy("point_id", "place_id", "v").count().where("count % 2 = 1").drop("count").collect()}
    for few in (O.FEW, 1):
        monkeypatch.setattr(O, "FEW", few)
        got = [tuple(r) for r in O.points_in_polygons(points, e, carry=("v",)).collect()]
        assert len(got) == len(want) and set(got) == want
