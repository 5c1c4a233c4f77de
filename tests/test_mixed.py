"""Mixed geometry: routing to one kind, centres by the highest dimension, digits of small places far from 0."""

from __future__ import annotations

import pytest

from terrane.operators import mixed as X

SCHEMA = "place_id string, part int, ring int, seq int, x double, y double, kind string"


def vertices(spark, parts):
    """``parts`` are (place, part, ring, kind, points)."""
    rows = [(p, n, r, k, *map(float, xy), kind) for p, n, r, kind, points in parts for k, xy in enumerate(points)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def box(x, y, w, h, back=False):
    points = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return points[::-1] if back else points


NAN = float("nan")
PARTS = [
    ("all", 1, 0, "point", [(50, 50)]), ("all", 2, 0, "line", [(0, 0), (9, 9)]), ("all", 3, 0, "polygon", box(1, 1, 2, 2)),
    ("lines", 1, 0, "line", [(0, 0), (4, 0)]), ("lines", 2, 0, "line", [(7, 7), (7, 7)]), ("lines", 3, 0, "point", [(1, 1)]),
    ("points", 1, 0, "point", [(1, 2)]), ("points", 2, 0, "point", [(3, 6)]), ("dot", 1, 0, "line", [(5, 5), (5, 5)]), ("nothing", 1, 0, "polygon", [(NAN, 1)]),
    ("far", 1, 0, "point", [(200, 0)]), ("near", 1, 0, "point", [(-180, 90)]),
]


@pytest.mark.parametrize(
    ("wanted", "kept", "empty"),
    [
        ("mixed", {("all", 3), ("lines", 1), ("points", 1), ("points", 2), ("far", 1), ("near", 1)}, {"dot", "nothing"}),
        ("polygon", {("all", 3)}, {"lines", "points", "dot", "nothing", "far", "near"}),
        ("line", {("all", 2), ("lines", 1)}, {"points", "dot", "nothing", "far", "near"}),
        ("one point", {("near", 1)}, {"all", "lines", "points", "dot", "nothing", "far"}),
    ],
)
def test_routes(spark, wanted, kept, empty):
    v, gone = X.routed(vertices(spark, PARTS), wanted)
    assert {(r["place_id"], r["part"]) for r in v.collect()} == kept
    told = gone.collect()
    assert {r["place_id"] for r in told if r["problem"] == "empty"} == empty
    assert {(r["place_id"], r["part"]) for r in told if r["part"] is not None} == {(p, n) for p, n, *_ in PARTS} - kept


def test_reasons(spark):
    got = {(r["place_id"], r["part"]): r["problem"] for r in X.routed(vertices(spark, PARTS))[1].where("part is not null").collect()}
    assert got == {("all", 1): "lower kind", ("all", 2): "lower kind", ("lines", 2): "zero length", ("lines", 3): "lower kind", ("dot", 1): "zero length", ("nothing", 1): "no coordinates"}
    assert {r["problem"] for r in X.routed(vertices(spark, PARTS), "one point")[1].where("place_id = 'far'").collect()} == {"range", "empty"}
    with pytest.raises(ValueError, match="unknown kind"):
        X.part_problems(vertices(spark, PARTS), "solid")


def test_centres(spark):
    parts = [
        *PARTS[:9], ("hole", 1, 0, "polygon", box(0, 0, 4, 4)), ("hole", 1, 1, "polygon", box(2, 0, 2, 4, back=True)), ("flat", 1, 0, "polygon", [(0, 0), (6, 0), (6, 0), (0, 0)]),
        ("two", 1, 0, "polygon", box(0, 0, 1, 1)), ("two", 2, 0, "polygon", box(10, 0, 3, 1)),
    ]
    got = {r["place_id"]: (r["dimension"], round(r["lon"], 9), round(r["lat"], 9)) for r in X.centroids(vertices(spark, parts)).collect()}
    assert got == {"all": (2, 2, 2), "lines": (1, 2, 0), "points": (0, 2, 4), "dot": (0, 5, 5), "hole": (2, 1, 2), "flat": (1, 3, 0), "two": (2, (0.5 + 11.5 * 3) / 4, 0.5)}


def test_small_places_keep_their_digits(spark):
    size = 1e-7
    got = X.centroids(vertices(spark, [("small", 1, 0, "polygon", box(170.0, 60.0, size, size))])).first()
    assert abs(got["lon"] - 170 - size / 2) < 1e-12 and abs(got["lat"] - 60 - size / 2) < 1e-12
