"""Readers: captured page files, GeoJSON, CSV subsets, event logs, stations, catalog documents, listings, WKB."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.text import valid_partial_date
from terrane.operators.geometry import explode_vertices

_FEATURE = "struct<properties:map<string,string>,attributes:map<string,string>,geometry:string>"


def read_feature_pages(spark: SparkSession, path: str) -> DataFrame:
    """Features of captured GeoJSON or Esri JSON pages: (properties, geometry, page)."""
    page = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<features:array<{_FEATURE}>>").alias("p"), F.col("_metadata.file_path").alias("page"))
    each = page.select(F.explode("p.features").alias("f"), "page")
    return each.select(F.coalesce("f.properties", "f.attributes").alias("properties"), F.col("f.geometry").alias("geometry"), "page")


def page_count_problem(features: DataFrame, declared: int) -> DataFrame:
    """A row when the pages hold another number of features than the source declared."""
    return features.agg(F.count("*").alias("found")).where(F.col("found") != declared).withColumn("declared", F.lit(declared))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, geometry) of a Feature or a FeatureCollection in each file."""
    d = spark.read.text(path, wholetext=True)
    many = F.from_json("value", f"struct<features:array<{_FEATURE}>>")["features"]
    one = F.array(F.from_json("value", _FEATURE))
    feature = F.explode(F.when(F.get_json_object("value", "$.type") == "FeatureCollection", many).otherwise(one))
    return d.select(feature.alias("f")).select("f.properties", "f.geometry")


def read_csv_subsets(spark: SparkSession, paths: list[str], ids: tuple[str, ...] = ()) -> DataFrame:
    """Several CSV files united by column name; missing columns are null. Values may hold line ends.

    All columns are text, so that ids keep their zeros; with ``ids`` only those stay text and others take the type of their values.
    """
    reader = lambda: spark.read.option("header", True).option("multiLine", True).option("escape", '"')

    def one(path: str) -> DataFrame:
        if not ids:
            return reader().csv(path)
        found = reader().option("inferSchema", True).csv(path).schema
        return reader().schema(", ".join(f"`{f.name}` {'string' if f.name in ids else f.dataType.simpleString()}" for f in found)).csv(path)

    parts = [one(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_event_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good events (key, date, status, source, note) and bad ones with their problem."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', schema="key string, date string, status string, source string, note string")
    return split_events(raw)


def split_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events without a key are left out; a bad date, a missing status or source, or a repeated (key, date, status) is a problem."""
    clean = raw.select(*[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in ("key", "date", "status", "source", "note")]).where("key != ''")
    again = clean.groupBy("key", "date", "status").agg(F.count("*").alias("n"))
    d = clean.join(again, ["key", "date", "status"])
    problem = F.when(~valid_partial_date("date"), "date").when((F.col("status") == "") | ~F.col("source").startswith("http"), "status or source").when(F.col("n") > 1, "repeated")
    d = d.withColumn("problem", problem).drop("n")
    return d.where("problem is null").drop("problem"), d.where("problem is not null")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """(line, station, lon, lat, depth): a byte order mark is dropped, a blank depth is null."""
    raw = spark.read.csv(path, header=True)
    raw = raw.withColumnsRenamed({c: c.lstrip("﻿").strip().lower() for c in raw.columns})
    return raw.select(*[F.col(c).try_cast("double").alias(c) for c in ("line", "station", "lon", "lat", "depth") if c in raw.columns])


def read_placemark_keys(spark: SparkSession, path: str) -> DataFrame:
    """Names of the placemarks of a KML file."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<Placemark\b.*?<name>\s*([^<]*?)\s*</name>"), F.lit(1))).alias("key"))


def read_collection_docs(spark: SparkSession, path: str) -> DataFrame:
    """Catalog documents with their slug, the folder they lie in."""
    slug = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return spark.read.json(path, multiLine=True).select("*", slug.alias("slug"))


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """(code, yr, value, seq) of an indicator document {"data": [...]}."""
    d = spark.read.json(path, multiLine=True, schema="data array<struct<geoAreaCode:string,timePeriodStart:double,value:string>>")
    return d.select(F.posexplode("data").alias("seq", "r")).select(F.col("r.geoAreaCode").alias("code"), F.col("r.timePeriodStart").cast("int").alias("yr"), "r.value", "seq")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """(key, size, modified) of the files under a path, without their content."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return d.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_contribution_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files in each contribution's folder under ``path``; content is only read where it is used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "content")


def read_sites(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns, ignoring case; those that a file lacks are null."""
    d = spark.read.parquet(path)
    have = {c.lower(): c for c in d.columns}
    return d.select(*[(F.col(have[c.lower()]) if c.lower() in have else F.lit(None).cast("string")).alias(c) for c in columns])


def read_tiles(spark: SparkSession, path: str, cells: DataFrame) -> DataFrame:
    """Rows of a table partitioned by ``tile`` for the wanted (tile, cell): only their partitions are read."""
    return spark.read.parquet(path).join(cells.select("tile", "cell"), ["tile", "cell"])


# WKB ----
def decode_wkb(df: DataFrame) -> DataFrame:
    """Vertices of WKB polygons and multipolygons (place_id, geometry binary)."""
    schema = pa.schema([("place_id", pa.string()), ("part", pa.int32()), ("ring", pa.int32()), ("seq", pa.int32()), ("x", pa.float64()), ("y", pa.float64())])

    def rings(data: bytes):
        order = lambda at: "<" if data[at] == 1 else ">"
        number = lambda at, o: int(np.frombuffer(data, f"{o}u4", 1, at)[0])

        def polygon(at: int, part: int):
            o = order(at)
            n, at = number(at + 5, o), at + 9
            for ring in range(n):
                m = number(at, o)
                yield part, ring, np.frombuffer(data, f"{o}f8", 2 * m, at + 4).reshape(-1, 2)
                at += 4 + 16 * m
            return at

        kind = number(1, order(0)) % 1000
        if kind == 3:
            yield from polygon(0, 1)
        elif kind == 6:
            at = 9
            for part in range(number(5, order(0))):
                at = yield from polygon(at, part + 1)

    def run(batches):
        for batch in batches:
            found = [(i, *ring) for i, data in enumerate(batch.column(1).to_pylist()) if data for ring in rings(data)]
            if not found:
                continue
            sizes = np.array([len(xy) for *_, xy in found])
            spread = lambda values, kind: np.repeat(np.array(values, kind), sizes)
            row, part, ring = (spread([f[k] for f in found], "i4") for k in range(3))
            seq = np.arange(1, sizes.sum() + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            xy = np.concatenate([xy.astype(float) for *_, xy in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(part), pa.array(ring), pa.array(seq.astype("i4")), pa.array(xy[:, 0]), pa.array(xy[:, 1])], schema=schema)

    return df.select("place_id", "geometry").mapInArrow(run, "place_id string, part int, ring int, seq int, x double, y double")


def encode_wkb(v: DataFrame) -> DataFrame:
    """(place_id, geometry binary): a WKB multipolygon for each place's vertices; for the sink only."""
    schema = pa.schema([("place_id", pa.string()), ("geometry", pa.binary())])

    def run(key, table):
        t = table.sort_by([("part", "ascending"), ("ring", "ascending"), ("seq", "ascending")])
        part, ring = t.column("part").to_numpy(), t.column("ring").to_numpy()
        xy = np.stack([t.column("x").to_numpy(), t.column("y").to_numpy()], axis=1).astype("<f8")
        u4 = lambda n: np.uint32(n).tobytes()
        starts = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (ring[1:] != ring[:-1])))  # of rings
        rings = [u4(len(r)) + r.tobytes() for r in np.split(xy, starts[1:])]
        firsts = np.flatnonzero(np.append(True, part[starts][1:] != part[starts][:-1]))  # of parts, among rings
        out = [b"\1" + u4(3) + u4(n - m) + b"".join(rings[m:n]) for m, n in zip(firsts, [*firsts[1:], len(rings)], strict=True)]
        return pa.table([pa.array([key[0].as_py()]), pa.array([b"\1" + u4(6) + u4(len(out)) + b"".join(out)], pa.binary())], schema=schema)

    return v.groupBy("place_id").applyInArrow(run, "place_id string, geometry binary")


def features_to_vertices(features: DataFrame, id_property: str) -> DataFrame:
    """Vertices of read features, keyed by one of their properties."""
    return explode_vertices(features.select(F.col("properties")[id_property].alias("place_id"), "geometry"))
