"""Spatial joins on a dense ring: rows grow with the edges, not with their square."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from terrane.operators import geometry as G
from terrane.operators import overlap as O

N = 100_000


def circle(spark, n=N):
    """A circle of radius 10 around (0, 0) as edges."""
    at = lambda f, i: 10 * f(2 * math.pi * (i % n) / n)
    i = F.col("id")
    return spark.range(n).select(F.lit("c").alias("place_id"), F.lit(1).alias("part"), F.lit(0).alias("ring"), i.alias("seq"), at(F.cos, i).alias("xa"), at(F.sin, i).alias("ya"), at(F.cos, i + 1).alias("xb"), at(F.sin, i + 1).alias("yb"))


def box(spark, x, y, size):
    p = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    rows = [("b", 1, 0, k, *map(float, p[k]), *map(float, p[k + 1])) for k in range(4)]
    return spark.createDataFrame(rows, "place_id string, part int, ring int, seq long, xa double, ya double, xb double, yb double")


def test_bands_hold_two_rows_for_an_edge(spark):
    e = circle(spark)
    for axis in "xy":
        bands = G.deal(e, axis, G.steps(e, axis, "place_id"), "place_id").groupBy("band").count()
        assert bands.agg(F.sum("count")).first()[0] <= 2.1 * N
        assert bands.count() > 1000


def test_overlap_of_a_dense_ring(spark):
    got = O.polygon_overlap(circle(spark), box(spark, 0, 0, 20)).collect()
    assert [(r["a_id"], r["b_id"], round(r["area"], 4)) for r in got] == [("c", "b", round(math.pi * 25, 4))]


def test_points_in_a_dense_ring(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 9.99, 0.0), (3, 7.2, 7.2), (4, 7.0, 7.0), (5, 10.01, 0.0), (6, 0.0, 9.9999), (7, 0.0, 50.0)], "point_id long, lon double, lat double")
    assert sorted(r["point_id"] for r in O.points_in_polygons(points, circle(spark)).collect()) == [1, 2, 4, 6]


def test_a_dense_ring_does_not_cross_itself(spark):
    assert G.crossings(circle(spark, 20_000)).count() == 0
    bow = [("w", 1, 0, k, *a, *b) for k, (a, b) in enumerate(zip([(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0)], [(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)], strict=True))]
    e = spark.createDataFrame(bow, "place_id string, part int, ring int, seq int, xa double, ya double, xb double, yb double")
    assert [(r["a"], r["b"]) for r in G.crossings(e).collect()] == [(0, 2)]


def test_flat_and_missing_rings(spark):
    flat = box(spark, 0, 0, 0)
    assert O.polygon_overlap(flat, box(spark, -1, -1, 3)).count() == 0
    assert O.polygon_overlap(flat.limit(0), flat.limit(0)).count() == 0
