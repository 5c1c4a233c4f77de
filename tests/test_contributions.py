"""Contributed folders: envelopes, kinds of geometry, metadata of any type; one case for each rule."""

from __future__ import annotations

import json

import pytest

from terrane.operators import contributions as C
from terrane.sources.readers import read_contribution_files

META = {"name": "Test Reef", "place_type": "habitat", "license": "CC0-1.0", "attribution": "A. Tester"}
SQUARE = [[-120.5, 34.4], [-120.4, 34.4], [-120.4, 34.5], [-120.5, 34.5], [-120.5, 34.4]]
POLYGON = {"type": "Polygon", "coordinates": [SQUARE]}


def _feature(geometry, **more):
    return {"type": "Feature", "properties": {}, "geometry": geometry, **more}


def _of(kind, coordinates):
    return _feature({"type": kind, "coordinates": coordinates})


#: name: (GeoJSON or its text, metadata or its text, errors, warnings)
CASES = {
    "clean": (_feature(POLYGON), META, [], []),
    "collection of one": ({"type": "FeatureCollection", "features": [_feature(POLYGON)]}, {**META, "contributor_orcid": "0000-0002-1825-009X", "source_url": "https://example.org/x"}, [], []),
    "point": (_of("Point", [-120.5, 34]), META, [], []),
    "points": (_of("MultiPoint", [[-120.5, 34], [1, 2, 3]]), META, [], []),
    "line": (_of("LineString", [[-120.5, 34.4], [-120.4, 34.5]]), META, [], []),
    "lines": (_of("MultiLineString", [[[-120.5, 34.4], [-120.4, 34.5]], [[0, 0], [1, 1]]]), META, [], []),
    "polygons": (_of("MultiPolygon", [[SQUARE], [[[0, 0], [1, 0], [1, 1], [0, 0]]]]), META, [], []),
    "open ring": (_of("Polygon", [SQUARE[:4]]), META, [], []),
    "unparsed": ("{not json", META, ["geojson_unparsed"], []),
    "missing": (None, META, ["geojson_missing"], []),
    "too long": (_feature(POLYGON, note="x" * 3000), META, ["geojson_size"], []),
    "list": ([1], META, ["geojson_object"], []),
    "two": ({"type": "FeatureCollection", "features": [_feature(POLYGON)] * 2}, META, ["one_feature"], []),
    "none": ({"type": "FeatureCollection", "features": []}, META, ["one_feature"], []),
    "no list": ({"type": "FeatureCollection", "features": "x"}, META, ["one_feature"], []),
    "member": ({"type": "FeatureCollection", "features": [POLYGON]}, META, ["not_feature"], []),
    "bare": (POLYGON, META, ["geojson_type"], []),
    "kind": (_feature({"type": "GeometryCollection", "geometries": []}), META, ["geometry_type"], []),
    "null geometry": (_feature(None), META, ["no_geometry"], []),
    "crs": (_feature(POLYGON, crs={"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}), META, ["crs"], []),
    "crs text": (_feature(POLYGON, crs="EPSG:4326"), META, ["crs"], []),
    "crs84": (_feature(POLYGON, crs={"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}), META, [], []),
    "crs null": (_feature(POLYGON, crs=None), META, [], []),
    "projected": (_of("Polygon", [[[-13400000, 4000000], [-13300000, 4000000], [-13300000, 4100000], [-13400000, 4000000]]]), META, ["degrees"], []),
    "empty": (_of("Polygon", []), META, ["empty"], []),
    "empty ring": (_of("Polygon", [[]]), META, ["empty"], []),
    "no coordinates": (_feature({"type": "Point"}), META, ["empty"], []),
    "nested": (_of("Polygon", SQUARE), META, ["malformed"], []),
    "texts": (_of("LineString", [["1", "2"], ["3", "4"]]), META, ["malformed"], []),
    "one number": (_of("LineString", [[1], [2, 3]]), META, ["short_position"], []),
    "short line": (_of("LineString", [[1, 2]]), META, ["malformed"], []),
    "winding": (_of("Polygon", [SQUARE[::-1]]), META, [], ["winding"]),
    "bow": (_of("Polygon", [[[0, 0], [2, 2], [2, 0], [0, 3], [0, 0]]]), META, [], ["repair"]),
    "flat": (_of("Polygon", [[[0, 0], [1, 1], [2, 2], [0, 0]]]), META, ["flat"], []),
    "antimeridian": (_of("Polygon", [[[170, 0], [190, 0], [190, 10], [170, 10], [170, 0]]]), META, [], ["split"]),
    "far point": (_of("Point", [190, 10]), META, ["longitudes"], []),
    "long line": (_of("LineString", [[170, 0], [-170, 0]]), META, [], ["long_segment"]),
    "still line": (_of("LineString", [[1, 0], [1, 0]]), META, ["no_length"], []),
    "meta missing": (_feature(POLYGON), None, ["meta_missing"], []),
    "meta unparsed": (_feature(POLYGON), "{", ["meta_unparsed"], []),
    "meta list": (_feature(POLYGON), [1], ["meta_object"], []),
    "no fields": (_feature(POLYGON), {}, ["name", "place_type", "license", "attribution"], []),
    "null licence": (_feature(POLYGON), {**META, "license": None}, ["license"], []),
    "other licence": (_feature(POLYGON), {**META, "license": "cc0-1.0"}, ["license"], []),
    "types": (_feature(POLYGON), {**META, "name": 5, "contributor_orcid": 7, "source_url": ["x"], "description": 1, "example": "yes"}, ["name", "orcid", "source_url", "description", "example"], []),
    "fit types": (_feature(POLYGON), {**META, "contributor_orcid": None, "source_url": "", "description": None, "example": True}, [], []),
    "unknown key": (_feature(POLYGON), {**META, "colour": "red", "a b": 1}, [], ["unknown_keys"]),
}


@pytest.fixture(scope="module")
def told(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("offers")
    for i, (geo, meta, *_) in enumerate(CASES.values()):
        folder = root / f"OM-0{i:025d}"
        folder.mkdir()
        if isinstance(meta, dict) and meta.get("name") == "Test Reef":
            meta = {**meta, "name": f"Test Reef {i}"}
        for name, value in ((C.GEOJSON, geo), (C.META, meta)):
            if value is not None:
                (folder / name).write_text(value if isinstance(value, str) else json.dumps(value))
        (folder / "last").write_text("x") if geo is None and meta is None else None
    (root / "OM-00000000000000000000000000" / "notes.txt").write_text("x")
    (root / "my-reef").mkdir()
    (root / "my-reef" / C.META).write_bytes(b"\xff\xfe")
    existing = spark.createDataFrame([("TEST  reef 1", "habitat"), ("test reef 2", "lease")], "name string, place_type string")
    d = C.check_contribution_files(read_contribution_files(spark, str(root)), existing, ["habitat"], ["CC0-1.0", "CC-BY-4.0", "ODbL-1.0"], max_bytes=2000)
    return {r.dir: r for r in d.collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=list(CASES))
def test_rules(told, i):
    name, (geo, _, errors, warnings) = list(CASES.items())[i]
    got = told[f"OM-0{i:025d}"]
    more = {"clean": ["extra_files"], "collection of one": ["name_used"]}.get(name, [])
    assert (got.errors, got.warnings, got.ok) == (errors, more + warnings, not errors)
    assert (got.geometry is None) == bool(set(errors) & {e for e in errors if e in FAULTS})


FAULTS = {"geojson_missing", "geojson_size", "geojson_unparsed", "geojson_object", "geojson_type", "one_feature", "not_feature", "crs", "no_geometry", "geometry_type", "empty", "malformed", "short_position"}


def test_folders_and_names(told):
    assert told["my-reef"].errors == ["dir", "meta_unparsed", "geojson_missing"]
    assert told["OM-00000000000000000000000000"].extra == ["notes.txt"]
    assert told[f"OM-0{list(CASES).index('unknown key'):025d}"].unknown_keys == ["a b", "colour"]
    assert len(told) == len(CASES) + 1


def test_no_files_null_paths_and_extra_columns(spark):
    schema = "path string, length long, content binary, dir int, kind string"
    names = spark.createDataFrame([], "name string, place_type string")
    check = lambda rows: C.check_contribution_files(spark.createDataFrame(rows, schema), names, ["habitat"], ["CC0-1.0"]).collect()
    assert check([]) == []
    assert check([(None, 1, b"x", 1, "k")]) == []
    folder = f"OM-0{0:025d}"
    rows = [(f"{folder}/{C.GEOJSON}", 9, json.dumps(_feature(POLYGON)).encode(), 1, "k"), (f"{folder}/{C.META}", 9, json.dumps(META).encode(), 1, "k")]
    assert [(r.dir, r.ok) for r in check(rows * 2)] == [(folder, True)]
    assert [r.errors for r in check([(f"{folder}/{C.GEOJSON}", 0, None, 1, "k")])] == [["meta_missing", "geojson_unparsed"]]
