"""Golden values and invariants on small frames."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from terrane.functions import boxes as B
from terrane.functions import text as T
from terrane.operators import aggregates as A
from terrane.operators import cells as C
from terrane.operators import geometry as G
from terrane.operators import graph as K
from terrane.operators import overlap as O
from terrane.operators import rows as R
from terrane.operators import species as S
from terrane.sources import readers


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ring(spark, *sites):
    """Vertices of single-ring sites: (id, points)."""
    rows = [(p, 1, 0, i + 1, float(x), float(y)) for p, points in sites for i, (x, y) in enumerate([*points, points[0]])]
    return spark.createDataFrame(rows, "place_id string, part int, ring int, seq int, x double, y double")


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


@pytest.mark.parametrize(("given", "want"), [("P00202", "OCS-P 0202"), ("OCS-G 37334 Provisional", "OCS-G 37334"), ("OCS-A-00467", "OCS-A 0467"), ("OCS-FL-2000", "OCS-FL-2000"), ("OCS-A 123456", "OCS-A 123456"), (None, "")])
def test_lease_number(spark, given, want):
    assert one(spark, T.lease_number(F.lit(given).cast("string"))) == want


def test_round_filter_is_half_even(spark):
    assert [one(spark, T.rounded(F.lit(v))) for v in ("0.5", "1.5", "2.5", "100062107.99999999", "x")] == ["0", "2", "2", "100062108", "x"]


def test_unknown_filter_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown template filter"):
        T.template("{a|shout}")


@pytest.mark.parametrize(
    ("boxes", "want"),
    [
        ([(-180, 19, -161, 32), (177, 25, 180, 30)], (177, 19, -161, 32)),
        ([(-90, 0, -80, 1), (90, 0, 100, 1)], (-90, 0, 100, 1)),
        ([(170, 0, -170, 1)], (170, 0, -170, 1)),
        ([(-180, -5, 180, 5)], (-180, -5, 180, 5)),
        ([(0, 0, 1, 1), (3, 0, 4, 2)], (0, 0, 4, 2)),
    ],
)
def test_union_bbox(spark, boxes, want):
    df = spark.createDataFrame([("a", *map(float, b)) for b in boxes], "g string, xmin double, ymin double, xmax double, ymax double")
    r = A.union_bbox(df, "g").first()
    assert tuple(r[c] for c in ("xmin", "ymin", "xmax", "ymax")) == want


def test_iou_third(spark):
    box = lambda *v: B.box(*[F.lit(float(x)) for x in v])
    assert one(spark, B.iou(box(0, 0, 2, 2), box(1, 0, 3, 2))) == pytest.approx(1 / 3)


def test_same_place_groups(spark):
    rows = [("a", "x", "Bank", "Polygon", 0.0, 0.0, 10.0, 10.0), ("b", "y", "bank ", "Polygon", 0.0, 0.0, 10.0, 9.0), ("c", "y", "Bánk", "MultiPolygon", 0.0, 0.5, 10.0, 10.0), ("d", "x", "Bank", "Polygon", 0.0, 0.0, 10.0, 7.2), ("e", "z", "Unnamed", "Polygon", 0.0, 0.0, 1.0, 1.0), ("f", "q", "unnamed", "Polygon", 0.0, 0.0, 1.0, 1.0), ("g", "x", "Bank", "Point", 0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "place_id string, collection string, name string, geom_type string, xmin double, ymin double, xmax double, ymax double")
    got = {r["place_id"]: r["group_id"] for r in K.same_place_groups(df).collect()}
    # d meets b only: 72 of 90
    assert got == {"a": "x/a", "b": "x/a", "c": "x/a", "d": "x/a", "e": None, "f": None, "g": None}


def test_latest_ignores_what_is_not_finite(spark):
    df = spark.createDataFrame([("1", 2024, "12.5", 0), ("1", 2025, "NaN?", 1), ("1", 2026, "NaN", 2), ("1", 2027, "Infinity", 3)], "code string, yr int, value string, seq int")
    assert [tuple(r) for r in A.latest_by(df).collect()] == [("1", 2024, 12.5)]


def test_merge_by_name_best_and_order(spark):
    rows = [("p", 1, 7, 5, 2000, 2001), ("p", 2, 7, 3, 1999, 2000), ("p", 2, 7, 4, 1990, 1995), ("p", 3, None, 1, 2000, 2000)]
    df = spark.createDataFrame(rows, "place_id string, aphiaid long, name_key long, n long, year_min int, year_max int")
    got = {r["key"]: (r["n"], r["best"], r["ids"], r["year_min"]) for r in S.merge_by_name(df).collect()}
    assert got == {7: (12, 1, [2, 1], 1990), -3: (1, 3, [3], 2000)}


def test_suffixes(spark):
    df = spark.createDataFrame([(1, "a", "Easement"), (2, "a", "easement"), (3, "a", None), (4, "a", "x"), (5, "b", "x")], "n int, id string, label string")
    got = {r["n"]: r["unique_id"] for r in R.suffixed(df, "id", F.col("label"), F.desc("n")).collect()}
    assert got == {4: "a", 3: "a:part", 2: "a:easement", 1: "a:easement-2", 5: "b"}


def test_union_refuses_two_types(spark):
    with pytest.raises(TypeError):
        R.union_sources({"a": spark.range(1).selectExpr("id as x"), "b": spark.range(1).selectExpr("'t' as x")})


def test_marine(spark):
    df = spark.createDataFrame([("CA1", 2, 90.0), ("CA2", 1, 0.0), ("CA3", 1, 5.0), ("CA4", None, None)], "id string, kind int, pct double")
    assert [r["id"] for r in R.marine_filter(df, "kind", "pct").orderBy("id").collect()] == ["CA1", "CA3", "CA4"]


def test_split_keeps_area_and_meets_at_180(spark):
    v = ring(spark, ("p", square(170, 0, 30)))
    parts = G.split_antimeridian(v)
    areas = G.area_plane(G.edges(parts)).first()["area"]
    assert areas == pytest.approx(900)
    b = sorted((r["xmin"], r["xmax"]) for r in G.bounds(parts, "place_id", "part").collect())
    assert b == [(-180, -160), (170, 180)]


def test_unwrap_of_wrapped_is_the_ring(spark):
    v = ring(spark, ("p", square(170, 0, 30)))
    wrapped = v.withColumn("x", F.when(F.col("x") > 180, F.col("x") - 360).otherwise(F.col("x")))
    got = [(r["x"], r["y"]) for r in G.unwrap_ring(wrapped).orderBy("seq").collect()]
    assert got == [(r["x"], r["y"]) for r in v.orderBy("seq").collect()]


def test_overlap_is_symmetric_and_own_area(spark):
    rng = random.Random(5)
    sites = []
    for k in range(8):
        cx, cy = rng.uniform(-20, 20), rng.uniform(-20, 20)
        import math

        sites.append((f"p{k}", [(cx + rng.uniform(2, 9) * math.cos(a), cy + rng.uniform(2, 9) * math.sin(a)) for a in [i * math.tau / 9 for i in range(9)]]))
    v = ring(spark, *sites)
    e = G.edges(v)
    got = {(r["a_id"], r["b_id"]): r["area"] for r in O.polygon_overlap(e, e).collect()}
    own = {r["place_id"]: r["area"] for r in G.area_plane(e).collect()}
    for p, area in own.items():
        assert got[p, p] == pytest.approx(area, rel=1e-9)
    for (a, b), area in got.items():
        assert got[b, a] == pytest.approx(area, rel=1e-9, abs=1e-9)

    def inside(points, x, y):
        hit = False
        for (xa, ya), (xb, yb) in zip(points, [*points[1:], points[0]], strict=True):
            if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
                hit = not hit
        return hit

    at = dict(sites)
    (a, b), area = max(((k, v) for k, v in got.items() if k[0] < k[1]), key=lambda x: x[1])
    n = 40_000
    hits = sum(inside(at[a], x, y) and inside(at[b], x, y) for x, y in ((rng.uniform(-30, 30), rng.uniform(-30, 30)) for _ in range(n)))
    assert hits / n * 3600 == pytest.approx(area, rel=0.15, abs=2)


def test_touching_polygons_give_no_piece(spark):
    e = G.edges(ring(spark, ("a", square(0, 0, 2)), ("b", square(2, 0, 2))))
    assert O.polygon_overlap(e, e).where("a_id != b_id").count() == 0


def test_membership_conserves_area(spark):
    e = G.edges(ring(spark, ("a", [(3, 1), (44, 7), (30, 40), (12, 22)])))
    audit = C.share_audit(C.grid_membership(e, 5, 0.0, 0.0), e).collect()
    assert len(audit) == 6
    assert all(abs(r["loss"]) < 1e-9 for r in audit)


def test_a_cell_as_a_place(spark):
    import math

    north = math.degrees(math.asin(0.5))
    e = G.edges(ring(spark, ("a", [(0, 0), (45, 0), (45, north), (0, north)])))
    got = [(r["ix"], r["iy"], r["share"]) for r in C.grid_membership(e, 2).where("res = 2").collect()]
    assert [(x, y) for x, y, _ in got] == [(4, 2)]
    assert got[0][2] == pytest.approx(1)


def test_wkb_round_trip(spark):
    v = ring(spark, ("a", square(0, 0, 2)), ("b", square(5.5, 1, 3)))
    back = readers.decode_wkb(readers.encode_wkb(v))
    key = lambda df: sorted(map(tuple, df.select("place_id", "part", "ring", "seq", "x", "y").collect()))
    assert key(back) == key(v)


def test_geojson_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":"7"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    (tmp_path / "b.json").write_text('{"type":"Feature","properties":{"id":"8"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,0]]]}}')
    f = readers.read_geojson(spark, str(tmp_path))
    areas = {r["place_id"]: r["area"] for r in G.area_plane(G.edges(readers.features_to_vertices(f, "id"))).collect()}
    assert areas == {"7": 0.5, "8": 2.0}
    assert readers.page_count_problem(f, 2).count() == 0
    assert readers.page_count_problem(f, 3).count() == 1


def test_event_log_splits_problems(spark, tmp_path):
    (tmp_path / "e.csv").write_text("key,date,status,source,note\nA,2024,open,http://x,\nA,2024-13-1,open,http://x,\nB,2024,open,ftp,\nC,2024,a,http://x,\nC,2024,a,http://x,\n,2024,a,http://x,\n")
    good, bad = readers.read_event_log(spark, str(tmp_path / "e.csv"))
    assert good.count() == 1
    assert sorted(r["problem"] for r in bad.collect()) == ["date", "repeated", "repeated", "status or source"]


def test_holes_go_to_the_smallest_shell(spark):
    shell = lambda p, n, s: [(p, n, i + 1, float(x), float(y)) for i, (x, y) in enumerate([*square(-s, -s, 2 * s)[::-1], square(-s, -s, 2 * s)[-1]])]
    hole = [("p", 3, i + 1, float(x), float(y)) for i, (x, y) in enumerate([*square(-1, -1, 2), (-1, -1)])]
    df = spark.createDataFrame(shell("p", 1, 10) + shell("p", 2, 5) + hole, "place_id string, ring int, seq int, x double, y double")
    assert {(r["ring"], r["shell"]) for r in G.assign_holes(df).collect()} == {(1, 1), (2, 2), (3, 2)}
