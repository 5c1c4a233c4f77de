"""Contributed folders over the tables: suppliers offer points, lines and polygons, some of them faulty (B-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators import contributions as C
from terrane.plans.base import Book, Tables

book = Book()
QUERIES, ORACLE_SQL = book.queries, book.sql

#: What is wrong with the offer of supplier k, as SQL of both engines.
_NO_GEO, _NO_META = "k % 10 = 9", "k % 14 = 3"
_GEOMETRY = "case k % 6 when 0 then 'Point' when 1 then 'LineString' when 2 then 'Polygon' when 3 then 'MultiPoint' when 4 then 'Polygon' else 'MultiLineString' end"


def offered_files(t: Tables) -> DataFrame:
    """(path, length, content): the files of every supplier's folder."""
    at = lambda x, y: F.format_string("[%.2f,%.2f]", F.expr(f"cx + {x} * r"), F.expr(f"cy + {y} * r"))
    listed = lambda *c: F.concat(F.lit("["), F.concat_ws(",", *c), F.lit("]"))
    a, b, c, d = at(-1, -1), at(1, -1), at(1, 1), at(-1, 1)
    k = F.col("k") % 6
    coordinates = F.when(k == 0, at(0, 0)).when((k == 1) | (k == 3), listed(a, c)).when(k == 2, listed(listed(a, b, c, d, a))).when(k == 4, listed(listed(a, d, c, b, a))).otherwise(listed(listed(a, b), listed(c, d)))
    shape = F.concat(F.lit('{"type":"'), F.expr(_GEOMETRY), F.lit('","coordinates":'), coordinates, F.lit("}"))
    crs = F.when(F.expr("k % 17 = 2"), F.lit(',"crs":{"properties":{"name":"EPSG:3857"}}')).otherwise("")
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), shape, crs, F.lit("}"))
    many = lambda *f: F.concat(F.lit('{"type":"FeatureCollection","features":'), listed(*f), F.lit("}"))
    geo = F.when(F.expr("k % 19 = 4"), "{not").when(F.expr("k % 13 = 5"), many(feature, feature)).when(F.expr("k % 11 = 3"), shape).when(F.expr("k % 7 = 6"), many(feature)).otherwise(feature)
    meta = F.to_json(F.struct(
        F.expr("case when k % 4 <> 0 then concat('Site ', k % 700) end").alias("name"), F.lit("park").alias("place_type"),
        F.expr("case when k % 7 = 2 then 'all rights' else 'CC0-1.0' end").alias("license"), F.lit("us").alias("attribution"),
        F.expr("case when k % 9 = 1 then k end").alias("description"), F.expr("case when k % 8 = 5 then 'red' end").alias("colour"),
    ))
    files = F.array(
        F.when(~F.expr(_NO_GEO), F.struct(F.lit(C.GEOJSON).alias("f"), geo.alias("t"))),
        F.when(~F.expr(_NO_META), F.struct(F.lit(C.META).alias("f"), meta.alias("t"))),
        F.when(F.expr("k % 12 = 7"), F.struct(F.lit("notes.txt").alias("f"), F.lit("x").alias("t"))),
    )
    each = t.fx_place.select(F.format_string("OM-0%025d", "k").alias("dir"), F.explode(F.array_compact(files)).alias("e"))
    return each.select(F.concat_ws("/", F.lit("offers"), "dir", "e.f").alias("path"), F.octet_length("e.t").cast("long").alias("length"), F.col("e.t").cast("binary").alias("content"))


def _checked(t: Tables) -> DataFrame:
    names = t.nation.select(F.concat(F.lit("SITE  "), F.col("n_nationkey").cast("string")).alias("name"), F.lit("park").alias("place_type"))
    d = C.check_contribution_files(offered_files(t), names, ["park"], ["CC0-1.0"])
    return d.select("dir", "geometry", *[F.array_join(c, ",").alias(c) for c in ("errors", "warnings", "unknown_keys", "extra")], "ok")


_SQL = f"""with c as (select k, cx, r, 'OM-0' || lpad(cast(k as varchar), 25, '0') dir, not {_NO_META} has, case when not {_NO_META} and k % 4 <> 0 then k % 700 end as name, {_GEOMETRY} kind,
  case when {_NO_GEO} then 'geojson_missing' when k % 19 = 4 then 'geojson_unparsed' when k % 13 = 5 then 'one_feature' when k % 11 = 3 then 'geojson_type' when k % 17 = 2 then 'crs' end unread
  from fx_place where not ({_NO_GEO} and {_NO_META} and k % 12 <> 7)),
d as (select *, case when unread is null then kind end geometry, cx - r < -180 or cx + r > 180 far, name is not null and (count(*) over (partition by name) > 1 or exists (select 1 from nation where n_nationkey = name)) used from c),
e as (select dir, geometry, concat_ws(',', case when has and k % 4 = 0 then 'name' end, case when has and k % 7 = 2 then 'license' end, case when not has then 'meta_missing' end, case when has and k % 9 = 1 then 'description' end, coalesce(unread, case when far and k % 6 in (1, 3, 5) then 'longitudes' end)) errors,
  concat_ws(',', case when unread is null and k % 6 = 4 then 'winding' end, case when unread is null and far and kind = 'Polygon' then 'split' end, case when used then 'name_used' end, case when k % 12 = 7 then 'extra_files' end, case when has and k % 8 = 5 then 'unknown_keys' end) warnings,
  case when has and k % 8 = 5 then 'colour' else '' end unknown_keys, case when k % 12 = 7 then 'notes.txt' else '' end extra from d)
select *, errors = '' as ok from e"""
book.add("b6_contribution_files", _checked, _SQL)
