"""Building a collection from several sources: one pass of filters, kinds, ids, statuses, notes and problems."""

from __future__ import annotations

import pytest

from terrane.operators import build as U

V = "feature long, part int, ring int, seq int, x double, y double, kind string"


def source(spark, name, rows, points, **more):
    v = [(f, 1, 0, k, float(x), float(y), kind) for f, kind, xy in points for k, (x, y) in enumerate(xy)]
    return U.Source(name, spark.createDataFrame(rows, "id long, code string, Name string, size string"), spark.createDataFrame(v, V), "id", **more)


CONFIG = {"place_id": "X:{code}", "source_id": "{id}", "name": "{Name}", "authority": "X", "place_type": "t", "license": "L", "attribution": " a  b ", "version": "2", "status": "designated", "status_source": "s", "pattern": r"^X:[a-z]+(:.*)?$"}
SQUARE = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]


def built(spark, **config):
    one = source(
        spark, "one", [(1, "a", "First", "3"), (2, "a", "Second", "x"), (3, "b", "Third", None), (4, "gone", "", "1"), (5, "c", "none", "1"), (6, "9", "bad", "1")],
        [(1, "polygon", SQUARE), (2, "line", [(0, 0), (2, 0)]), (3, "line", [(1, 1), (1, 1)]), (4, "point", [(0, 0)]), (6, "point", [(3, 3)])],
        kinds={"size": "int"}, exclude={"code": ["gone", "never"]}, edit_day="2024-05-01",
    )
    two = source(spark, "two", [(1, "a", "Other", "7"), (8, "out", "Out", "8")], [(1, "point", [(5, 5)]), (8, "point", [(6, 6)])], kinds={"size": "int"}, include={"code": ["a"]}, retrieved="2024-06-01")
    events = spark.createDataFrame([(2, "2024-01-01", "proposed", "u", 1), (2, "2024-02-01", "retired", "w", 2)], "key long, date string, value string, source string, seq long")
    return U.build_collection(CONFIG | config, [one, two], events, "id")


def test_build(spark):
    b = built(spark)
    got = {r["place_id"]: (r["component"], r["source_id"], r["name"], r["Name_src"], r["size"], r["geom_type"], r["status"], r["status_date"], str(r["source_date"]), r["attribution"]) for r in b.places.collect()}
    assert got == {
        "X:a": ("one", "1", "First", "First", 3, "MultiPolygon", "designated", "", "2024-05-01", "a b"),
        "X:a:one": ("one", "2", "Second", "Second", None, "MultiLineString", "retired", "2024-02-01", "2024-05-01", "a b"),
        "X:a:two": ("two", "1", "Other", "Other", 7, "MultiPoint", "designated", "", "2024-06-01", "a b"),
        "X:9": ("one", "6", "bad", "bad", 1, "MultiPoint", "designated", "", "2024-05-01", "a b"),
    }
    assert {tuple(r) for r in b.dropped.collect()} == {("one", "code=gone", 1), ("one", "no geometry", 2), ("two", "not included", 1)}
    assert {tuple(r) for r in b.problems.collect()} == {("X:9", "pattern")}
    assert {r["place_id"]: r["count"] for r in b.vertices.groupBy("place_id").count().collect()} == {"X:a": 5, "X:a:one": 2, "X:a:two": 1, "X:9": 1}


@pytest.mark.parametrize("order", ["id", "space"])
def test_orders(spark, order):
    ids = [r["place_id"] for r in built(spark, order=order).places.collect()]
    assert ids == (sorted(ids) if order == "id" else ["X:a:one", "X:a", "X:9", "X:a:two"])


def test_one_kind_only(spark):
    b = built(spark, geometry="polygon")
    assert [r["place_id"] for r in b.places.collect()] == ["X:a"]
    assert {tuple(r) for r in b.dropped.collect()} == {("one", "code=gone", 1), ("one", "no geometry", 4), ("two", "not included", 1), ("two", "no geometry", 1)}


def test_types_of_sources_must_agree(spark):
    one = source(spark, "one", [(1, "a", "n", "1")], [(1, "point", [(0, 0)])], kinds={"size": "int"})
    two = source(spark, "two", [(1, "a", "n", "1")], [(1, "point", [(0, 0)])])
    with pytest.raises(TypeError, match="size"):
        U.build_collection(CONFIG, [one, two])


def test_filters_and_counts_are_one_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id % 5 as string) code").write.parquet(str(tmp_path / "in"))
    kept, seen = U.observed_filter(spark.read.parquet(str(tmp_path / "in")), {"code": ["1", "2", "3"]}, {"code": ["2", "7"], "id": [6, 7]})
    assert kept._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert U.written(kept).count() == 39
    assert seen.get == {"rows": 100, "not included": 40, "code=2": 20, "code=7": 0, "id=6": 1, "id=7": 0}
