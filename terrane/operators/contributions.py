"""Contributed places as files: one folder each with ``place.geojson`` and ``meta.json``, read as VARIANT and checked by rules.

Files come in the columns of Spark's binaryFile source (path, length, content), so a folder, an archive or a table serves.
Each file is one row and is at most ``max_bytes`` long before it is decoded; everything after that is a join on the folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.operators.graph import scratch
from terrane.operators.quality import check_contributions

GEOJSON, META = "place.geojson", "meta.json"
#: Accepted geometries with the number of arrays around their positions, and the kind of their vertices.
GEOMETRIES = {"Point": (0, "point"), "MultiPoint": (1, "point"), "LineString": (1, "line"), "MultiLineString": (2, "line"), "Polygon": (2, "polygon"), "MultiPolygon": (3, "polygon")}
#: Names of longitude and latitude on WGS 84 in a ``crs`` member, in lower case.
DEGREES = ("urn:ogc:def:crs:ogc:1.3:crs84", "urn:ogc:def:crs:epsg::4326", "urn:ogc:def:crs:epsg:6.6:4326", "epsg:4326", "crs84", "ogc:crs84")
#: The keys of ``meta.json``.
META_KEYS = ("name", "place_type", "license", "attribution", "contributor_orcid", "source_url", "description", "example")
_FIELD_RULES = ("name", "place_type", "license", "attribution", "orcid", "source_url")
_NUMBERS = r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))>$"


def _get(v: Column | str, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _kind(v: Column | str) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, BIGINT and so on; VOID for a JSON null, null where there is nothing."""
    return F.regexp_extract(F.schema_of_variant(v), r"^\w+", 0)


def _absent(v: Column | str) -> Column:
    return F.coalesce(_kind(v) == "VOID", F.lit(True))


def _object(v: Column | str) -> Column:
    return F.coalesce(_kind(v) == "OBJECT", F.lit(False))


def contribution_texts(files: DataFrame, max_bytes: int = 5 << 20) -> DataFrame:
    """(dir, extra, geo_bytes, meta_bytes, geo, meta): one row for each folder; texts only of files within ``max_bytes``.

    ``extra`` are names of other files in order. Texts that are not UTF-8 are null although their bytes are known. Of
    several files with one path the longest counts, of these the largest content. Rows with a null path are left out.
    """
    parts = F.split("path", "/")
    d = files.where("path is not null").withColumn("__file", F.get(parts, F.size(parts) - 1)).withColumn("dir", F.get(parts, F.size(parts) - 2))
    wanted = F.col("__file").isin(GEOJSON, META)
    listed = d.groupBy("dir").agg(
        F.array_sort(F.collect_set(F.when(~wanted, F.col("__file")))).alias("extra"),
        *[F.max(F.when(F.col("__file") == name, F.col("length"))).alias(f"{c}_bytes") for c, name in (("geo", GEOJSON), ("meta", META))],
    )
    text = F.try_validate_utf8(F.col("content").cast("string"))
    read = d.where(wanted & (F.col("length") <= max_bytes)).select(F.col("dir").alias("__dir"), "__file", F.struct("length", text.alias("t")).alias("s"))
    texts = read.groupBy("__dir").agg(*[F.max(F.when(F.col("__file") == name, F.col("s")))["t"].alias(c) for c, name in (("geo", GEOJSON), ("meta", META))])
    return listed.join(texts, F.col("dir").eqNullSafe(F.col("__dir")), "left").drop("__dir")


def _parts(c: Column, kind: Column) -> Column:
    """Parts of rings of positions, whatever the geometry; null if the arrays are nested otherwise."""
    at = lambda n: _get(c, "$", "array<" * n + "variant" + ">" * n)
    forms = {
        "Point": F.array(F.array(F.array(c))),
        "MultiPoint": F.transform(at(1), lambda p: F.array(F.array(p))),
        "LineString": F.array(F.array(at(1))),
        "MultiLineString": F.transform(at(2), lambda line: F.array(line)),
        "Polygon": F.array(at(2)),
        "MultiPolygon": at(3),
    }
    return reduce(lambda done, name: done.when(kind == name, forms[name]), forms, F.when(F.lit(False), forms["MultiPolygon"]))


def decoded(texts: DataFrame, max_bytes: int = 5 << 20) -> DataFrame:
    """Each folder with its decoded metadata, its geometry as nested arrays, and the first fault of its GeoJSON.

    Adds ``m`` (variant), ``kind``, ``parts`` (part, ring, position, number) and ``fault``: geojson_missing, geojson_size,
    geojson_unparsed, geojson_object, geojson_type, one_feature, not_feature, crs, no_geometry, geometry_type, empty,
    malformed or short_position. Parts are null where there is a fault. A bare NaN or a repeated key does not parse.
    """
    d = texts.withColumn("doc", F.try_parse_json("geo")).withColumn("m", F.try_parse_json("meta"))
    top = _get("doc", "$.type", "string")
    features = F.when(_kind(_get("doc", "$.features")) == "ARRAY", _get("doc", "$.features", "array<variant>"))
    d = d.withColumn("top", top).withColumn("features", features)
    d = d.withColumn("f", F.when(F.col("top") == "Feature", F.col("doc")).when((F.col("top") == "FeatureCollection") & (F.size("features") == 1), F.get("features", F.lit(0))))
    d = d.withColumn("g", _get("f", "$.geometry")).withColumn("kind", _get("g", "$.type", "string"))
    d = d.withColumn("c", _get("g", "$.coordinates"))
    d = d.withColumn("raw", _parts(F.col("c"), F.col("kind")))
    places = F.flatten(F.flatten("raw"))
    shape = lambda p: F.coalesce(F.schema_of_variant(p), F.lit(""))
    few = F.exists("raw", lambda part: F.exists(part, lambda ring: F.size(ring) < F.when(F.col("kind").endswith("Polygon"), 3).when(F.col("kind").endswith("LineString"), 2).otherwise(1)))
    hollow = F.exists("raw", lambda part: F.size(part) == 0)

    def odd_crs(v: str) -> Column:
        crs = _get(v, "$.crs")
        return ~_absent(crs) & ~F.coalesce(F.lower(_get(crs, "$.properties.name", "string")).isin(*DEGREES), F.lit(False))

    fault = (
        F.when(F.col("geo_bytes").isNull(), "geojson_missing")
        .when(F.col("geo_bytes") > max_bytes, "geojson_size")
        .when(F.col("doc").isNull(), "geojson_unparsed")
        .when(~_object("doc"), "geojson_object")
        .when(~F.coalesce(F.col("top").isin("Feature", "FeatureCollection"), F.lit(False)), "geojson_type")
        .when(F.col("f").isNull(), "one_feature")
        .when(~_object("f") | ~F.coalesce(_get("f", "$.type", "string") == "Feature", F.lit(False)), "not_feature")
        .when(odd_crs("doc") | odd_crs("f"), "crs")
        .when(~_object("g") | _absent(_get("g", "$.type")), "no_geometry")
        .when(~F.col("kind").isin(*GEOMETRIES), "geometry_type")
        .when(_absent("c") | F.coalesce(F.schema_of_variant("c").rlike(r"^(ARRAY<)+VOID>+$"), F.lit(False)), "empty")
        .when(F.col("raw").isNull() | places.isNull(), "malformed")
        .when(F.size(places) == 0, "empty")
        .when(F.exists(places, lambda p: ~shape(p).rlike(_NUMBERS)), "malformed")
        .when(F.exists(places, lambda p: F.size(_get(p, "$", "array<double>")) < 2), "short_position")
        .when(few | hollow, "malformed")
    )
    numbers = F.transform("raw", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: _get(p, "$", "array<double>"))))
    d = d.withColumn("fault", fault)
    return d.withColumn("parts", F.when(F.col("fault").isNull(), numbers)).select("dir", "extra", "geo_bytes", "meta_bytes", "m", "fault", F.when(F.col("fault").isNull(), F.col("kind")).alias("kind"), "parts")


def contribution_vertices(d: DataFrame) -> DataFrame:
    """Vertices (place_id, part, ring, seq, x, y, kind) of decoded folders; rings that are open are closed."""
    closed = F.when((F.col("kind") == "polygon") & (F.get("points", F.lit(0)) != F.element_at("points", -1)), F.concat("points", F.slice("points", 1, 1))).otherwise(F.col("points"))
    kind = reduce(lambda done, name: done.when(F.col("kind") == name, GEOMETRIES[name][1]), GEOMETRIES, F.when(F.lit(False), ""))
    p = d.select(F.col("dir").alias("place_id"), kind.alias("kind"), F.posexplode("parts").alias("part", "rings"))
    r = p.select("place_id", "kind", (F.col("part") + 1).alias("part"), F.posexplode("rings").alias("ring", "points"))
    v = r.select("place_id", "kind", "part", "ring", F.posexplode(closed).alias("seq", "p"))
    return v.select("place_id", "part", "ring", (F.col("seq") + 1).alias("seq"), F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y"), "kind")


def stored(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read again: many checks follow, and files are to be decoded once."""
    path = scratch(df)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _open_shapes(v: DataFrame, vertex_cap: int) -> DataFrame:
    """(dir, fault, long): lines and points must lie within the degrees; ``long`` says that a step passes 180 degrees."""
    line = F.struct("part", "seq", "x")
    each = v.where("kind <> 'polygon'")
    steps = each.groupBy("place_id", "part", "kind").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(line)).alias("s"), *[f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))])
    jump = F.exists(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.abs(F.get("s", i)["x"] - F.get("s", i - 1)["x"]) > 180)
    by_part = steps.withColumn("long", (F.col("kind") == "line") & (F.col("n") > 1) & jump).withColumn("still", (F.col("kind") == "line") & (F.col("lox") == F.col("hix")) & (F.col("loy") == F.col("hiy")))
    of = by_part.groupBy("place_id").agg(F.sum("n").alias("n"), F.max("long").alias("long"), F.max("still").alias("still"), *[f(c).alias(c) for c, f in (("lox", F.min), ("hix", F.max), ("loy", F.min), ("hiy", F.max))])
    reach = F.greatest(F.abs("lox"), F.abs("hix"))
    fault = F.when(F.col("n") > vertex_cap, "vertices").when((F.greatest(F.abs("loy"), F.abs("hiy")) > 90) | (reach > 360), "degrees").when(reach > 180, "longitudes").when(F.col("still"), "no_length")
    return of.select(F.col("place_id").alias("__dir"), fault.alias("open_fault"), "long")


def check_contribution_files(files: DataFrame, existing: DataFrame, kinds: list[str], licences: list[str], max_bytes: int = 5 << 20, vertex_cap: int = 100_000) -> DataFrame:
    """(dir, geometry, errors, warnings, unknown_keys, extra, ok): one row for each folder of ``files`` (path, length, content).

    ``existing`` has (name, place_type). ``geometry`` is its GeoJSON type, null if it was not read. Errors are those of
    ``check_contributions`` on the decoded metadata and polygons, ``meta_missing``, ``meta_unparsed`` or ``meta_object`` in
    place of the fields' errors, ``description`` and ``example`` of another type, and one fault of the geometry: one of
    ``decoded``, or vertices, degrees, longitudes, no_length of lines and points. A text of another type counts as missing,
    an ORCID or URL of another type as unfit. Warnings add ``extra_files``, ``unknown_keys`` and ``long_segment``. Folders
    with a null name have the error ``dir``; an empty table gives no row; extra columns are left out.
    """
    d = stored(decoded(contribution_texts(files, max_bytes), max_bytes))
    string = lambda k: F.when(_kind(_get("m", f"$.{k}")) == "STRING", _get("m", f"$.{k}", "string"))
    loose = lambda k: F.when(~_absent(_get("m", f"$.{k}")), F.coalesce(_get("m", f"$.{k}", "string"), F.lit("?")))
    new = d.select("dir", *[string(k).alias(k) for k in ("name", "place_type", "license", "attribution")], *[loose(k).alias(k) for k in ("contributor_orcid", "source_url")])
    v = stored(contribution_vertices(d))
    told = check_contributions(new, v.where("kind = 'polygon'").drop("kind"), existing, kinds, licences, vertex_cap)

    bad_meta = F.when(F.col("meta_bytes").isNull(), "meta_missing").when(F.col("m").isNull(), "meta_unparsed").when(~_object("m"), "meta_object")
    other = lambda k, kind: ~_absent(_get("m", f"$.{k}")) & (_kind(_get("m", f"$.{k}")) != kind)
    unknown = F.array_sort(F.array_except(F.map_keys(_get("m", "$", "map<string,variant>")), F.array(*map(F.lit, META_KEYS))))
    own = d.select(
        F.col("dir").alias("__of"), F.col("kind").alias("geometry"), "extra", "fault", bad_meta.alias("bad_meta"),
        F.coalesce(F.when(_object("m"), unknown), F.array().cast("array<string>")).alias("unknown_keys"),
        F.array_compact(F.array(F.when(other("description", "STRING"), "description"), F.when(other("example", "BOOLEAN"), "example"))).alias("types"),
    )
    own = own.join(_open_shapes(v, vertex_cap), F.col("__of") == F.col("__dir"), "left")
    polygon = F.col("geometry").endswith("Polygon")
    shape = F.when(F.col("fault").isNotNull(), F.col("fault")).when(~polygon, F.col("open_fault"))
    kept = F.filter("errors", lambda e: ~e.isin(*_FIELD_RULES) | F.col("bad_meta").isNull())
    kept = F.filter(kept, lambda e: (e != "no_geometry") | F.coalesce(polygon, F.lit(False)))
    joined = told.join(own, F.col("dir").eqNullSafe(F.col("__of")))
    errors = F.array_compact(F.concat(kept, F.array("bad_meta"), "types", F.array(shape)))
    more = F.array_compact(F.array(F.when(F.size("extra") > 0, "extra_files"), F.when(F.size("unknown_keys") > 0, "unknown_keys"), F.when(shape.isNull() & F.col("long"), "long_segment")))
    return joined.select("dir", "geometry", errors.alias("errors"), F.concat("warnings", more).alias("warnings"), "unknown_keys", "extra").withColumn("ok", F.size("errors") == 0)
