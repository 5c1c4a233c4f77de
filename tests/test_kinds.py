"""The data source of captured pages and the registries of source kinds and operations."""

from __future__ import annotations

import json

import pytest

from terrane.sources import kinds, pages


def _page(folder, offset, n, **more):
    features = [{"properties": {"id": f"{offset + i:03d}", "n": offset + i, "none": None, "tags": ["a"]}, "geometry": {"type": "Point", "coordinates": [i, 0.5]}} for i in range(n)]
    (folder / f"page_{offset:07d}.geojson").write_text(json.dumps({"features": features, **more}))


def _read(spark, folder, **options):
    pages.register(spark)
    return spark.read.format("feature_pages").options(**options).load(str(folder))


@pytest.fixture
def three(tmp_path):
    for offset, n in ((0, 4), (4, 4), (8, 3)):
        _page(tmp_path, offset, n)
    (tmp_path / "count.txt").write_text("11")
    return tmp_path


def test_pages_are_tasks(spark, three):
    d = _read(spark, three, declared=11)
    assert d.rdd.getNumPartitions() == 3
    rows = sorted(d.collect(), key=lambda r: r["at"])
    assert [r["at"] for r in rows] == list(range(11))
    assert rows[5]["properties"] == {"id": "005", "n": "5", "none": None, "tags": '["a"]'}
    assert json.loads(rows[5]["geometry"]) == {"type": "Point", "coordinates": [1, 0.5]}
    assert rows[10]["page"] == "page_0000008.geojson"
    assert _read(spark, f"file:{three}").count() == _read(spark, f"file://{three}").count() == 11


def test_gaps_and_errors_end_the_job(spark, three):
    with pytest.raises(Exception, match="has 3 features, 4 are declared"):
        _read(spark, three, declared=12).collect()
    _page(three, 4, 2)
    with pytest.raises(Exception, match="has 2 features, 4 are declared"):
        _read(spark, three).collect()
    assert _read(spark, three, mode="permissive").count() == 9
    (three / "page_0000004.geojson").write_text('{"error": {"code": 500}}')
    with pytest.raises(Exception, match="holds an error"):
        _read(spark, three).collect()
    (three / "page_0000000.geojson").unlink()
    with pytest.raises(Exception, match="first page is missing"):
        _read(spark, three, declared=11).collect()


def test_empty_folder_and_esri_pages(spark, tmp_path):
    assert _read(spark, tmp_path).count() == 0
    assert _read(spark, tmp_path, declared=0).count() == 0
    with pytest.raises(Exception, match="first page is missing"):
        _read(spark, tmp_path, declared=3).count()
    (tmp_path / "page_0000000.json").write_text('{"features":[{"attributes":{"a":1.5,"b":true},"geometry":null},{"attributes":null,"geometry":null}]}')
    rows = _read(spark, tmp_path, declared=2).collect()
    assert [(r["properties"], r["geometry"]) for r in rows] == [({"a": "1.5", "b": "true"}, None), ({}, None)]


def test_pages_are_written_again_in_place(spark, tmp_path):
    pages.register(spark)
    d = spark.createDataFrame([(0, '{"features":[{"properties":{"é":"1"}}]}', 1), (1, '{"features":[{"properties":{}},{"properties":{}}]}', 2)], "at long, text string, extra int")
    for _ in range(2):
        d.write.format("feature_pages").mode("append").save(str(tmp_path / "new"))
    assert sorted(p.name for p in (tmp_path / "new").iterdir()) == ["page_0000000.geojson", "page_0000001.geojson"]
    rows = sorted(_read(spark, tmp_path / "new", declared=3).collect(), key=lambda r: r["at"])
    assert [r["properties"] for r in rows] == [{"é": "1"}, {}, {}]
    with pytest.raises(Exception, match="its place from 0, not -1"):
        spark.createDataFrame([(-1, "{}")], "at long, text string").write.format("feature_pages").mode("append").save(str(tmp_path / "other"))
    with pytest.raises(Exception, match="columns at and text"):
        d.select("at").write.format("feature_pages").mode("append").save(str(tmp_path / "other"))


def test_configured_pages(spark, three):
    config = {"kind": "feature_pages", "path": str(three), "declared": 11, "exclude": {"n": [3, 4]}}
    assert kinds.read_source(spark, config | {"expected": 9}).count() == 9
    with pytest.raises(ValueError, match="9 features are left, 10 are expected"):
        kinds.read_source(spark, config | {"expected": 10})


def test_unknown_kinds_and_options(spark):
    with pytest.raises(ValueError, match="unknown source kind ftp; known are csv, derive, feature_pages"):
        kinds.read_source(spark, {"kind": "ftp"})
    with pytest.raises(ValueError, match="source kind sites: unknown colour; missing columns, path"):
        kinds.read_source(spark, {"kind": "sites", "colour": 1})
    with pytest.raises(ValueError, match="unknown operation union"):
        kinds.derive("union", None, None)
    with pytest.raises(ValueError, match="csv is taken"):
        kinds.source_kind("csv")(lambda spark: None)


def test_a_kind_of_ones_own(spark):
    @kinds.source_kind("numbers")
    def _(spark, n: int):
        return spark.range(n)

    try:
        assert kinds.read_source(spark, {"kind": "numbers", "n": 3}).count() == 3
    finally:
        del kinds.SOURCE_KINDS["numbers"]


def test_derived_source(spark, tmp_path):
    schema = "place_id string, part int, ring int, seq int, x double, y double"
    square = lambda i, x: [(i, 1, 0, k + 1, x + a, b) for k, (a, b) in enumerate([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)])]
    for name, x in (("a", 0.0), ("b", 1.0)):
        spark.createDataFrame(square(name, x), schema).write.parquet(str(tmp_path / name))
    d = kinds.read_source(spark, {"kind": "derive", "operation": "intersect", "first": str(tmp_path / "a"), "second": str(tmp_path / "b")})
    assert [(r["a_id"], r["b_id"], r["reason"]) for r in d.collect()] == [("a", "b", None)]
