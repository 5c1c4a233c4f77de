"""The check of a built collection on small cases."""

from __future__ import annotations

from terrane.operators.quality import check_collection, check_contributions

SITES = "place_id string, geom_type string, xmin double, ymin double, xmax double, ymax double, license string, name string, status string, extra int"
VERTICES = "place_id string, part int, ring int, seq int, x double, y double"


def _square(id_, x, y, r=1.0):
    return [(id_, 1, 0, i + 1, x + a * r, y + b * r) for i, (a, b) in enumerate([(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)])]


def _check(spark, sites, vertices):
    d = check_collection(spark.createDataFrame(sites, SITES), spark.createDataFrame(vertices, VERTICES), [r"A:\d+"], "CC0", "MultiPolygon")
    return {r.rule: r.n for r in d.collect()}


def test_a_good_site_breaks_no_rule(spark):
    got = _check(spark, [("A:1", "MultiPolygon", -1.0, -1.0, 1.0, 1.0, "CC0", "n", "s", 1)], _square("A:1", 0.0, 0.0))
    assert len(got) == 12 and set(got.values()) == {0}


def test_nulls_and_repeats(spark):
    sites = [(None,) * 10, ("A:1", "MultiPolygon", -1.0, -1.0, None, 1.0, "CC0", "n", "", 1)] + [("A:2", "MultiPolygon", 179.0, -1.0, 181.0, 1.0, "CC0", "n", "s", 1)] * 2
    got = _check(spark, sites, _square("A:1", 0.0, 0.0) + _square("A:2", 180.0, 0.0))
    told = {"bad_id": 1, "empty_name": 1, "empty_status": 2, "empty_license": 1, "other_license": 1, "other_kind": 1, "no_geometry": 1, "outside": 2, "other_box": 1, "repeated_id": 1, "invalid": 0, "jumps": 0}
    assert got == told


def test_jump_over_the_antimeridian(spark):
    v = [("A:1", 1, 0, i + 1, x, y) for i, (x, y) in enumerate([(179.0, 0.0), (-179.0, 0.0), (-179.0, 1.0), (179.0, 1.0), (179.0, 0.0)])]
    assert _check(spark, [("A:1", "MultiPolygon", -179.0, 0.0, 179.0, 1.0, "CC0", "n", "s", 1)], v)["jumps"] == 1


def test_empty_table_and_missing_columns(spark):
    assert set(_check(spark, [], []).values()) == {0}
    short = spark.createDataFrame([("A:1",)], "place_id string")
    got = check_collection(short, spark.createDataFrame([], VERTICES), [], "CC0", "MultiPolygon")
    assert "missing license" in {r.rule for r in got.collect()}


NEW = "dir string, name string, place_type string, license string, attribution string, contributor_orcid string, source_url string, extra int"
DIRS = [f"OM-0{i:025d}" for i in range(9)]


def _offers(spark, new, vertices, existing=()):
    e = spark.createDataFrame(list(existing), "name string, place_type string, dir string")
    d = check_contributions(spark.createDataFrame(new, NEW), spark.createDataFrame(vertices, VERTICES), e, ["park"], ["CC0-1.0"], vertex_cap=6)
    return {r.dir: (r.errors, r.warnings, r.ok) for r in d.collect()}


def _offer(dir_, name="n"):
    return (dir_, name, "park", "CC0-1.0", "us", None, None, 1)


def test_contributions_geometry(spark):
    nan, far = float("nan"), 500.0
    shapes = {0: _square(DIRS[0], 0.0, 0.0), 1: [(DIRS[1], 1, 0, 1, nan, 0.0)] + _square(DIRS[1], 0.0, 0.0)[1:], 2: _square(DIRS[2], far, 0.0), 3: _square(DIRS[3], 0.0, 0.0, 0.0), 4: _square(DIRS[4], 0.0, 0.0) * 2, 5: _square(DIRS[5], 180.0, 0.0)}
    shapes[6] = [(*v[:3], 6 - v[3], *v[4:]) for v in _square(DIRS[6], 0.0, 0.0)]
    got = _offers(spark, [_offer(d, f"name {i}") for i, d in enumerate(DIRS[:8])], [v for s in shapes.values() for v in s])
    want = [[], ["no_numbers"], ["degrees"], ["flat"], ["vertices"], [], [], ["no_geometry"]]
    assert [got[d][0] for d in DIRS[:8]] == want
    assert [got[d][1] for d in DIRS[:8]] == [[], [], [], [], [], ["split"], ["winding"], []]
    assert all(got[d][2] == (not e) for d, e in zip(DIRS, want, strict=False))


def test_contributions_names_and_nulls(spark):
    new = [_offer(DIRS[0], "Bay  One"), _offer(DIRS[1], " bay one"), _offer(DIRS[2], "Old"), _offer(DIRS[3], "other"), (None,) * 8]
    got = _offers(spark, new, [v for d in DIRS[:4] for v in _square(d, 0.0, 0.0)], [("old", "park", "x"), ("other", "reserve", "x"), (None, None, None)])
    assert [got[d][1] for d in DIRS[:4]] == [["name_used"], ["name_used"], ["name_used"], []]
    assert got[None] == (["dir", "name", "place_type", "license", "attribution", "no_geometry"], [], False)
    assert _offers(spark, [], []) == {}
