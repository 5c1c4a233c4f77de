"""Readers, writers and streams on small files."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from terrane.operators import rows as R
from terrane.sources import readers, writers
from terrane.streaming import jobs


def test_feature_pages_of_both_kinds(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"features":[{"type":"Feature","properties":{"id":1},"geometry":{"type":"Point","coordinates":[0,0]}}]}')
    (tmp_path / "2.json").write_text('{"features":[{"attributes":{"id":2},"geometry":{"rings":[]}},{"attributes":{"id":3},"geometry":null}]}')
    f = readers.read_feature_pages(spark, str(tmp_path))
    assert sorted(r["properties"]["id"] for r in f.collect()) == ["1", "2", "3"]
    assert f.select("page").distinct().count() == 2
    assert [tuple(r) for r in readers.page_count_problem(f, 4).collect()] == [(3, 4)]


def test_csv_subsets_keep_zeros_and_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,purpose\n007,"two\nlines, ""quoted"""\n')
    (tmp_path / "b.csv").write_text("id,extra\n8,x\n")
    got = sorted(map(tuple, readers.read_csv_subsets(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()))
    assert got == [("007", 'two\nlines, "quoted"', None), ("8", None, "x")]


def test_stations_and_placemarks(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿Line,Station,Lon,Lat,Depth\n76.7,49,-120.5,35,\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_stations(spark, str(tmp_path / "s.csv")).collect()] == [(76.7, 49.0, -120.5, 35.0, None)]
    (tmp_path / "k.kml").write_text("<kml><Placemark id='1'>\n<name> 076.7 049.0 </name></Placemark><Placemark><name>b</name></Placemark></kml>")
    assert sorted(r["key"] for r in readers.read_placemark_keys(spark, str(tmp_path / "k.kml")).collect()) == ["076.7 049.0", "b"]


def test_collection_documents_and_series(spark, tmp_path):
    for slug in ("one", "two"):
        (tmp_path / slug).mkdir()
        (tmp_path / slug / "collection.json").write_text(json.dumps({"id": slug, "title": slug.upper()}, indent=1))
    got = {r["slug"]: r["title"] for r in readers.read_collection_docs(spark, f"{tmp_path}/*/collection.json").collect()}
    assert got == {"one": "ONE", "two": "TWO"}
    (tmp_path / "s.json").write_text('{"data":[{"geoAreaCode":"4","timePeriodStart":2020.0,"value":"1.5"},{"geoAreaCode":"4","timePeriodStart":2021.0,"value":"NaN"}]}')
    assert [tuple(r) for r in readers.read_series(spark, str(tmp_path / "s.json")).collect()] == [("4", 2020, "1.5", 0), ("4", 2021, "NaN", 1)]


def test_listing_has_sizes_only(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.bin").write_bytes(b"12345")
    assert [r["size"] for r in readers.read_listing(spark, str(tmp_path)).collect()] == [5]


def test_sites_written_for_lookups(spark, tmp_path):
    path = str(tmp_path / "sites")
    writers.write_sites(spark.range(5000).select(F.format_string("P:%05d", "id").alias("place_id"), F.col("id").alias("Area")), path, partitions=4)
    got = R.place_lookup(readers.read_sites(spark, path, ["PLACE_ID", "area", "missing"]).withColumnRenamed("PLACE_ID", "place_id"), "P:00042")
    assert [tuple(r) for r in got.collect()] == [("P:00042", 42, None)]
    assert "PushedFilters: [IsNotNull(place_id), EqualTo(place_id,P:00042)]" in got._jdf.queryExecution().toString()


def test_membership_and_tiles(spark, tmp_path):
    m = spark.range(100).select(F.concat(F.lit("p"), F.col("id") % 5).alias("place_id"), F.col("id").alias("cell"), F.lit(0.5).alias("share"), (F.col("id") % 3).alias("res"), (F.col("id") % 2).alias("parent"))
    writers.write_membership(m, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert back.count() == 100
    assert writers.membership_manifest(back).count() == 6
    assert writers.place_parents(back).count() == 30
    spark.range(50).select(F.col("id").alias("cell"), (F.col("id") % 10).alias("tile")).write.partitionBy("tile").parquet(str(tmp_path / "t"))
    wanted = spark.createDataFrame([(3, 13), (3, 14), (7, 27)], "tile int, cell long")
    assert sorted(r["cell"] for r in readers.read_tiles(spark, str(tmp_path / "t"), wanted).collect()) == [13, 27]


def test_wkb_of_many_rings_and_gaps_in_their_numbers(spark):
    rows = [("a", p, r, k, float(p * 10 + r), float(k)) for p, r in [(1, 0), (1, 1), (1, 4), (3, 0), (7, 2)] for k in range(1, 5)] + [("b", 1, 0, k, 0.0, float(k)) for k in range(1, 4)]
    v = spark.createDataFrame(rows[::-1], "place_id string, part int, ring int, seq int, x double, y double").repartition(3)
    got = sorted(map(tuple, readers.decode_wkb(readers.encode_wkb(v)).collect()))
    numbered = {(1, 0): (1, 0), (1, 1): (1, 1), (1, 4): (1, 2), (3, 0): (2, 0), (7, 2): (3, 0)}
    assert got == sorted((i, *numbered[p, r], k, x, y) for i, p, r, k, x, y in rows)
    many = spark.range(400_000).select(F.lit("m").alias("place_id"), (F.col("id") / 40_000).cast("int").alias("part"), (F.col("id") % 40_000 / 4).cast("int").alias("ring"), (F.col("id") % 4).cast("int").alias("seq"), F.col("id").cast("double").alias("x"), F.lit(0.5).alias("y"))
    assert readers.decode_wkb(readers.encode_wkb(many)).agg(F.count("*"), F.count_distinct("part", "ring"), F.sum("x")).first()[:] == (400_000, 100_000, 400_000 * 399_999 / 2)


def test_feature_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, None, '{"type":"Point","coordinates":[0,1]}')], "id int, name string, geometry string")
    writers.write_feature_lines(df, ["id", "name"], str(tmp_path / "f"))
    got = json.loads(spark.read.text(str(tmp_path / "f")).first()["value"])
    assert got == {"type": "Feature", "properties": {"id": 1}, "geometry": {"type": "Point", "coordinates": [0, 1]}}


def test_change_stream_reports_and_survives_failures(spark, tmp_path):
    schema = "slug string, source_no int, last_edit string, n long, checksum string, etag string"
    published = spark.createDataFrame([("a", 1, "2024", 5, None, None), ("b", 1, None, 3, "x", None), ("c", 1, None, 1, None, "e")], schema)
    arriving = spark.createDataFrame([("a", 1, "2024", 6, None, None, None), ("b", 1, None, 3, "x", None, None), ("c", 1, None, None, None, None, "timeout")], f"{schema}, error string")
    arriving.write.parquet(str(tmp_path / "in"))
    q = jobs.change_stream(spark.readStream.schema(arriving.schema).parquet(str(tmp_path / "in")), published, str(tmp_path / "out"), str(tmp_path / "state"))
    q.processAllAvailable()
    q.stop()
    got = {(r["slug"], r["reason"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", "count"), ("c", "failed: timeout")}


def test_feature_pages_arrive_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"id":1,"ts":"2024-01-01T00:00:00"}\n{"id":2,"ts":"2024-01-01T00:00:00"}\n{"id":1,"ts":"2024-01-01T00:10:00"}\n')
    q = jobs.feature_pages_stream(spark, str(tmp_path / "in"), "id long, ts timestamp").writeStream.format("memory").queryName("pages_once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.sql("select id from pages_once").collect()) == [1, 2]


def test_rates_are_per_minute(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, s), "a") for s in (1, 2, 59)] + [(dt.datetime(2024, 1, 1, 0, 1, 0), "a")]
    got = jobs.anonymous_rates(spark.createDataFrame(rows, "ts timestamp, client string"), 2).collect()
    assert [(r["client"], r["n"]) for r in got] == [("a", 3)]
