"""The index of places: precedence of row, collection and id, unwrapped shapes, crosswalk, groups, extent."""

from __future__ import annotations

from terrane.operators import index as I

V = "place_id string, part int, ring int, seq int, x double, y double, kind string"


def box(place, part, x, y, w, h):
    return [(place, part, 0, k, float(a), float(b), "polygon") for k, (a, b) in enumerate([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)])]


def layers(spark):
    rows = [("MPA:12", " Deep  Reef ", None, "Deep", 7.0, "0"), ("MRGID:5:a", "Strait", "X", None, 0.0, "Q1"), ("plain", None, "", "Bay", None, None)]
    one = spark.createDataFrame(rows, "PLACE_ID string, Name string, authority string, bay string, wdpa_id double, wikidata_qid string").withColumnRenamed("PLACE_ID", "place_id")
    shapes = [*box("MPA:12", 1, 0, 0, 2, 2), *box("MRGID:5:a", 1, 170, 0, 10, 2), *box("MRGID:5:a", 2, -180, 0, 20, 2), ("plain", 1, 0, 0, 3.0, 4.0, "point")]
    two = spark.createDataFrame([("OTHER:1", "deep reef", 0.0, 0.0, 2.0, 2.0, 9.0), ("MPA:12", "again", None, None, None, None, None)], "place_id string, name string, xmin double, ymin double, xmax double, ymax double, area_km2 double")
    return [
        I.Layer("reefs", one, spark.createDataFrame(shapes, V), {"geometry_type": "MultiPolygon", "authority": "A", "license": "CC0", "updated": "2024-01-02"}, "3", "https://x.test/{bay}/{wdpa_id}", None, ("bay",), {"MPA": "area"}),
        I.Layer("zones", two, None, {"geometry_type": "Polygon", "attribution": "Z"}),
        I.Layer("secret", two, None, {"access": "unlisted"}),
    ]


def test_precedence_and_shapes(spark):
    made = I.build_index(layers(spark))
    got = {(r["collection"], r["place_id"]): r for r in made.places.collect()}
    assert set(got) == {("reefs", "MPA:12"), ("reefs", "MRGID:5:a"), ("reefs", "plain"), ("zones", "OTHER:1"), ("zones", "MPA:12")}
    reef, strait, plain, zone = (got[k] for k in (("reefs", "MPA:12"), ("reefs", "MRGID:5:a"), ("reefs", "plain"), ("zones", "OTHER:1")))
    assert (reef["name"], reef["authority"], reef["place_type"], reef["geom_type"], reef["keywords"], reef["url"]) == ("Deep Reef", "A", "area", "MultiPolygon", None, "https://x.test/Deep/7")
    assert (strait["authority"], strait["xmin"], strait["xmax"], strait["centroid_lon"], strait["url"]) == ("X", 170, 200, 185, None)
    assert (plain["geom_type"], plain["centroid_lat"], plain["area_km2"], plain["place_type"], plain["keywords"]) == ("Point", 4, None, None, "Bay")
    assert (zone["authority"], zone["geom_type"], zone["centroid_lon"], zone["area_km2"], zone["attribution"], zone["version"]) == ("OTHER", "Polygon", 1, 9, "Z", None)
    assert 49_000 < reef["area_km2"] < 49_500
    assert reef["group_id"] == zone["group_id"] == "reefs/MPA:12" and strait["group_id"] is None


def test_crosswalk_counts_and_extent(spark):
    made = I.build_index(layers(spark))
    cross = {(r["place_id"], r["mrgid"], r["mpainv_site_id"], r["wdpa_id"], r["wikidata_qid"]) for r in made.crosswalk.collect()}
    assert cross == {("MPA:12", None, "12", "7", None), ("MPA:12", None, "12", None, None), ("MRGID:5:a", "5", None, None, "Q1")}
    assert {tuple(r) for r in made.counts.collect()} == {("reefs", 3), ("zones", 2)}
    n = made.crosswalk_counts.first()
    assert (n["rows"], n["mpainv_site_id"], n["wdpa_id"], n["psgid"]) == (3, 2, 1, 0)
    assert {tuple(r) for r in made.shared.collect()} == {("MPA:12", 2)}
    e = made.extent.first()
    assert (e["xmin"], e["xmax"], e["ymin"], e["ymax"]) == (170, 3, 0, 4)


def test_last_column_of_an_id_counts(spark):
    rows = spark.createDataFrame([("PSGID:9", "a", None), ("PSGID:8", "a", "b"), ("x", "a", "n/a")], "place_id string, psgid string, ProSeasID string")
    assert {(r["place_id"], r["psgid"]) for r in I.layer_crosswalk(rows).collect()} == {("PSGID:9", "9"), ("PSGID:8", "b")}


def test_authority_by_another_column(spark):
    rows = spark.createDataFrame([("Z:1", "from the row"), ("Z:2", None)], "place_id string, keeper string")
    got = {r["place_id"]: r["authority"] for r in I.layer_index(I.Layer("a", rows, authority_field="keeper")).collect()}
    assert got == {"Z:1": "from the row", "Z:2": "Z"}
