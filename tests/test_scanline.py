"""Cells by scanlines against the even-odd test of every centre of the box, and refusal before any crossing is made."""

from __future__ import annotations

import math
import random

import pytest

from terrane.operators import cells as C

GRID = {"x0": -180.0, "y0": 90.0, "res": 0.5, "ncol": 720, "nrow": 360}


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (xa, ya), (xb, yb) in zip(ring, ring[1:], strict=False):
            if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
                odd = not odd
    return odd


def plain(parts, most):
    """Cells of a place, or None if it is refused. ``parts`` are lists of closed rings, the outer one first."""
    g, found = GRID, set()
    for rings in parts:
        xs, ys = zip(*rings[0], strict=True)
        at = lambda v: math.floor(v + 1e-9)
        rows = range(max(0, at((g["y0"] - max(ys)) / g["res"])), min(g["nrow"] - 1, at((g["y0"] - min(ys)) / g["res"])) + 1)
        columns = range(at((min(xs) - g["x0"]) / g["res"]), at((max(xs) - g["x0"]) / g["res"]) + 1)
        if len(rows) * len(columns) > 4 * most:
            return None
        own = {(r, c) for r in rows for c in columns if inside(g["x0"] + (c + 0.5) * g["res"], g["y0"] - (r + 0.5) * g["res"], rings)}
        own = own or {(at((g["y0"] - (min(ys) + max(ys)) / 2) / g["res"]), at(((min(xs) + max(xs)) / 2 - g["x0"]) / g["res"]))}
        found |= {r * g["ncol"] + c % g["ncol"] + 1 for r, c in own}
    return found if len(found) <= most else None


def edges(spark, sites):
    rows = []
    for name, parts in sites.items():
        for part, rings in enumerate(parts):
            for ring, points in enumerate(rings):
                rows += [(name, part, ring, k, *map(float, (*a, *b))) for k, (a, b) in enumerate(zip(points, points[1:], strict=False))]
    return spark.createDataFrame(rows, "place_id string, part int, ring int, seq int, xa double, ya double, xb double, yb double").repartition(4)


def star(rng, x, y, size, n):
    points = [(x + size * rng.uniform(0.2, 1) * math.cos(2 * math.pi * k / n), y + size * rng.uniform(0.2, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [*points, points[0]]


@pytest.fixture(scope="module")
def sites():
    rng = random.Random(9)
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    found = {f"star{k}": [[star(rng, rng.uniform(-170, 170), rng.uniform(-80, 80), rng.uniform(0.1, 6), rng.randint(3, 40))] for _ in range(rng.randint(1, 4))] for k in range(25)}
    found |= {
        "on the centres": [[box(0.25, 0.25, 2, 2)]], "on the lines": [[box(10, 10, 3, 2)]], "with a hole": [[box(20, 20, 5, 5), box(21, 21, 2.2, 2.1)]],
        "past the edge": [[box(177, 0, 8, 3)]], "twice around": [[box(-190, -2, 370, 0.6)]], "two that overlap": [[box(40, 40, 3, 3)], [box(41, 41, 3, 3)]],
        "tiny": [[box(60.01, 10.01, 0.1, 0.1)], [box(62, 12, 0.01, 0.02)]], "off the grid": [[box(0, 89, 2, 3)]], "bow": [[[(80, 0), (84, 4), (84, 0), (80, 4), (80, 0)]]],
        "many": [[box(100, -20, 14, 14)]], "huge": [[box(-100, -60, 90, 90)], [box(0, 0, 1, 1)]],
    }
    return found


@pytest.mark.parametrize("most", [700, 100_000])
def test_cells(spark, sites, most):
    got = C.place_cells(edges(spark, sites), **GRID, tile_deg=5.0, most=most).collect()
    cells = {}
    for r in got:
        assert r["listed"] == (r["cell"] is not None)
        if r["listed"]:
            assert r["cell"] not in cells.setdefault(r["place_id"], set())
            cells[r["place_id"]].add(r["cell"])
        else:
            assert r["place_id"] not in cells
            cells[r["place_id"]] = None
    assert cells == {name: plain(parts, most) for name, parts in sites.items()}
    assert {n for n, c in cells.items() if c is None} == ({"many", "huge", "twice around"} if most == 700 else set())


def test_refused_before_crossings(spark):
    """A box of most of the earth at a fine resolution, refused from its corners; one long edge list grows with rows, not with cells."""
    grid = {"x0": -180.0, "y0": 90.0, "res": 0.001, "ncol": 360_000, "nrow": 180_000}
    world = [(-179, -80), (179, -80), (179, 80), (-179, 80), (-179, -80)]
    strip = [(0.0, 0.0), (150.0, 0.0), (150.0, 0.0021), (0.0, 0.0021), (0.0, 0.0)]
    e = edges(spark, {"world": [[world]], "strip": [[strip]]})
    runs, status = C.place_runs(e, **grid, most=1_000_000)
    assert {r["place_id"]: (r["cells"], r["listed"]) for r in status.collect()} == {"world": (None, False), "strip": (300_000, True)}
    assert [(r["place_id"], r["c1"] - r["c0"] + 1) for r in runs.collect()] == [("strip", 150_000)] * 2


def test_empty(spark, sites):
    assert C.place_cells(edges(spark, sites).limit(0), **GRID, tile_deg=5.0).count() == 0
