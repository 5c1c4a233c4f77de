"""Queries of readers and writers: rows are written to the shared folder, read back and compared (family S)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators import aggregates as A
from terrane.operators.graph import scratch
from terrane.plans.base import Book, Tables
from terrane.sources import pages
from terrane.sources import readers as R
from terrane.sources import writers as W
from terrane.sources.kinds import read_source

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql

PAGE = 100  # rows of one page file


def _one_file_each(df: DataFrame, text: str) -> str:
    """Writes the text of each row as a file of its own and gives the folder."""
    path = scratch(df)
    df.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return path


def _pages(t: Tables) -> DataFrame:
    """Feature collections of the suppliers' boxes, PAGE features in each."""
    b = t.fx_box
    point = F.format_string('{"type":"Point","coordinates":[%.2f,%.2f]}', "xmin", "ymin")
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(F.col("place_id").alias("id"), F.col("k").cast("string").alias("k"))), F.lit(',"geometry":'), point, F.lit("}"))
    each = b.select(F.floor(F.col("k") / PAGE).alias("page"), feature.alias("f"))
    return each.groupBy("page").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("f"), ","), F.lit("]}")).alias("text"))


_FEATURES = lambda f: f.select(F.col("properties")["id"].alias("id"), F.col("properties")["k"].cast("bigint").alias("k"), F.get_json_object("geometry", "$.type").alias("kind"), F.round(F.get_json_object("geometry", "$.coordinates[0]").cast("double"), 2).alias("x"))
_FEATURES_SQL = "select place_id id, k, 'Point' kind, round(xmin, 2) x from fx_box"
add("s1_feature_pages", lambda t: _FEATURES(R.read_feature_pages(t.spark, _one_file_each(_pages(t), "text"))), _FEATURES_SQL)
add("s1_page_count_problem", lambda t: R.page_count_problem(R.read_feature_pages(t.spark, _one_file_each(_pages(t), "text")), 7), "select count(*) as found, 7 declared from fx_box having count(*) <> 7")
add("s2_geojson_files", lambda t: _FEATURES(R.read_geojson(t.spark, _one_file_each(_pages(t), "text"))), _FEATURES_SQL)


def _captured(t: Tables) -> DataFrame:
    """The suppliers' pages written and read as a data source, each page a task that counts its own features."""
    path = scratch(t.supplier)
    pages.register(t.spark)
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("xmin", "ymin").alias("coordinates")))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(F.col("place_id").alias("id"), "k")), F.lit(',"geometry":'), point, F.lit("}"))
    each = t.fx_box.groupBy((F.floor(F.col("k") / PAGE) * PAGE).alias("at")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", feature.alias("f")))), lambda s: s["f"]), ",").alias("f"))
    each.select("at", F.concat(F.lit('{"features":['), "f", F.lit("]}")).alias("text")).write.format("feature_pages").mode("append").save(path)
    return read_source(t.spark, {"kind": "feature_pages", "path": path, "exclude": {"k": [3, 5]}})


add("s1_page_source", lambda t: _captured(t).select(F.col("properties")["id"].alias("id"), "page", "at", F.round(F.get_json_object("geometry", "$.coordinates[0]").cast("double"), 2).alias("x")), f"select place_id id, 'page_' || lpad(cast(k // {PAGE} * {PAGE} as varchar), 7, '0') || '.geojson' page, k as at, round(xmin, 2) x from fx_box where k not in (3, 5)")


def _subsets(t: Tables) -> DataFrame:
    """Two files with ids of leading zeros, one with line ends in its values, one with another column."""
    a, b = scratch(t.part), scratch(t.part)
    padded = F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("id")
    t.part.select(padded, F.concat("p_brand", F.lit('\n"'), "p_name", F.lit('"')).alias("note"), "p_size").write.csv(a, header=True, escape='"')
    t.part.select(padded, F.col("p_type").alias("kind")).write.csv(b, header=True)
    return R.read_csv_subsets(t.spark, [a, b], ids=("id",))


add("s3_csv_subsets", _subsets, "select lpad(cast(p_partkey as varchar), 12, '0') id, p_brand || chr(10) || '\"' || p_name || '\"' note, p_size, null kind from part union all select lpad(cast(p_partkey as varchar), 12, '0'), null, null, p_type from part")

_DATE = "case when seq % 7 = 0 then substr(d, 1, 4) when seq % 11 = 0 then '2024-1' else d end"
_LOGGED = f"(select *, case when date = '2024-1' then 'date' when source = '' then 'status or source' when count(*) over (partition by k, date, status) > 1 then 'repeated' end problem from (select k, seq, status, {_DATE} as date, case when seq % 13 = 0 then '' else source end source from fx_event))"


def _log(t: Tables) -> tuple[DataFrame, DataFrame]:
    path = scratch(t.events)
    rows = t.fx_event.select(F.col("k").alias("key"), F.expr(_DATE).alias("date"), "status", F.expr("case when seq % 13 = 0 then '' else source end").alias("source"), F.lit("two\nlines").alias("note"))
    rows.write.csv(path, header=True, escape='"')
    return R.read_event_log(t.spark, path)


add("s4_event_log_good", lambda t: _log(t)[0].select("key", "date", "status", "source"), f"select cast(k as varchar) as key, date, status, source from {_LOGGED} where problem is null")
add("s4_event_log_bad", lambda t: _log(t)[1].groupBy("problem").agg(F.count("*").alias("n")), f"select problem, count(*) n from {_LOGGED} where problem is not null group by 1")


def _stations(t: Tables) -> DataFrame:
    path = scratch(t.orders)
    t.fx_point.select((F.col("point_id") % 90).alias("\ufeffLine"), F.col("point_id").alias("Station"), F.col("lon").alias("Lon"), F.col("lat").alias("Lat"), F.expr("case when point_id % 3 = 0 then ' ' else cast(point_id % 5000 as string) end").alias("Depth")).write.csv(path, header=True)
    return R.read_stations(t.spark, path)


add("s5_stations", lambda t: _stations(t).select("line", "station", F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"), "depth"), "select cast(point_id % 90 as double) line, cast(point_id as double) station, round(lon, 5) lon, round(lat, 5) lat, case when point_id % 3 <> 0 then cast(point_id % 5000 as double) end depth from fx_point")
_KML = lambda t: t.supplier.groupBy(F.floor(F.col("s_suppkey") / PAGE).alias("page")).agg(F.concat(F.lit("<kml>"), F.array_join(F.collect_list(F.concat(F.lit("<Placemark id='x'> <name> "), "s_name", F.lit(" </name></Placemark>"))), ""), F.lit("</kml>")).alias("text"))
add("s5_placemark_keys", lambda t: R.read_placemark_keys(t.spark, _one_file_each(_KML(t), "text")), "select s_name as key from supplier")
add("s6_read_sites_file", lambda t: R.read_sites(t.spark, _sites(t), ["PLACE_ID", "Name", "area_km2"]).withColumnsRenamed({"PLACE_ID": "place_id", "Name": "name"}), "select place_id, name, cast(null as varchar) area_km2 from fx_name")


def _sites(t: Tables) -> str:
    path = scratch(t.supplier)
    W.write_sites(t.fx_name, path, "place_id")
    return path


def _docs(t: Tables) -> DataFrame:
    path = scratch(t.nation)
    t.nation.select(F.col("n_nationkey").alias("doc"), F.col("n_name").alias("title"), F.col("n_regionkey").alias("region")).write.partitionBy("doc").json(path)
    return R.read_collection_docs(t.spark, f"{path}/doc=*/*.json")


add("s7_collection_docs", lambda t: _docs(t).select("slug", "title", F.col("region").cast("bigint").alias("region")), "select 'doc=' || n_nationkey slug, n_name title, cast(n_regionkey as bigint) region from nation")
_SERIES_DOCS = lambda t: t.fx_series.groupBy("code").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("code").cast("string").alias("geoAreaCode"), F.col("yr").cast("double").alias("timePeriodStart"), F.round("val", 2).cast("string").alias("value"))).alias("data"))).alias("text"))
add("s8_series_files", lambda t: A.latest_by(R.read_series(t.spark, _one_file_each(_SERIES_DOCS(t), "text"))), "select cast(code as varchar) code, max(yr) yr, round(arg_max(val, yr), 2) val from fx_series group by code")
_LISTED = lambda t: t.supplier.groupBy(F.floor(F.col("s_suppkey") / PAGE).alias("page")).agg(F.array_join(F.collect_list("s_name"), "\n").alias("text"))
add("s9_listing_files", lambda t: R.read_listing(t.spark, _one_file_each(_LISTED(t), "text")).where("key like '%.txt'").select("size"), f"select cast(sum(strlen(s_name) + 1) as bigint) size from supplier group by s_suppkey // {PAGE}")
add("s10_wkb_round_trip", lambda t: R.decode_wkb(R.encode_wkb(t.fx_vertex)).select("place_id", "part", "ring", "seq", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")), "select place_id, part, ring, seq, round(x, 6) x, round(y, 6) y from fx_vertex")
add("s11_write_sites", lambda t: t.spark.read.parquet(_sites(t)), "select * from fx_name")


def _site_files(t: Tables) -> DataFrame:
    """One row: how many rows the files hold, how many are not in order, and how many files share a range of keys with another."""
    path = scratch(t.supplier)
    W.write_sites(t.fx_name, path, "place_id", file_bytes=20_000, blooms=("name",))
    d = t.spark.read.parquet(path).select("place_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("place_id").over(Window.partitionBy("file").orderBy("at"))
    files = d.withColumn("late", F.col("place_id") < before).groupBy("file").agg(F.count("*").alias("n"), F.count_if("late").alias("late"), F.min("place_id").alias("first"), F.max("place_id").alias("last"))
    shared = F.col("first") <= F.max("last").over(Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("shared", shared).agg(F.sum("n").alias("rows"), F.sum("late").alias("late"), F.count_if("shared").alias("shared"))


add("s11_site_files", _site_files, "select count(*) as rows, 0 late, 0 shared from fx_name")


def _membership(t: Tables) -> DataFrame:
    path = scratch(t.lineitem)
    rows = t.lineitem.select(F.concat(F.lit("SUP:"), F.col("l_suppkey").cast("string")).alias("place_id"), F.col("l_orderkey").alias("cell"), (F.col("l_discount") * 10).cast("double").alias("share"), F.col("l_linenumber").cast("int").alias("res"), (F.col("l_orderkey") % 7).cast("int").alias("parent"))
    W.write_membership(rows, path)
    return t.spark.read.parquet(path)


add("s12_membership_files", lambda t: W.membership_manifest(_membership(t)), "select l_linenumber res, l_orderkey % 7 parent, count(*) as rows, count(distinct l_suppkey) sites from lineitem group by 1, 2")


def _tiles(t: Tables) -> DataFrame:
    """Points by cells of a degree, stored by tiles of ten; the cells under the boxes' lower edges are wanted."""
    path = scratch(t.orders)
    cell = lambda x, y: (F.floor(y + 90) * 360 + F.floor(x + 180)).alias("cell")
    tile = lambda x: F.floor((x + 180) / 10).cast("int").alias("tile")
    t.fx_point.select("point_id", cell(F.col("lon"), F.col("lat")), tile(F.col("lon"))).repartition("tile").write.partitionBy("tile").parquet(path)
    under = t.fx_box.select(F.explode(F.sequence(F.floor("xmin").cast("bigint"), F.floor("xmax").cast("bigint"))).alias("x"), "ymin")
    return R.read_tiles(t.spark, path, under.select(cell(F.col("x"), F.col("ymin")), tile(F.col("x"))).distinct())


add("s16_tile_files", lambda t: _tiles(t).select("point_id", F.col("cell").cast("bigint").alias("cell"), F.col("tile").cast("bigint").alias("tile")), "select point_id, p.cell, p.tile from (select point_id, cast(floor(lat + 90) * 360 + floor(lon + 180) as bigint) cell, cast(floor((lon + 180) / 10) as bigint) tile from fx_point) p join (select distinct cast(floor(ymin + 90) * 360 + floor(x + 180e0) as bigint) cell, cast(floor((x + 180) / 10e0) as bigint) tile from (select ymin, unnest(range(cast(floor(xmin) as bigint), cast(floor(xmax) as bigint) + 1)) x from fx_box)) w on w.cell = p.cell and w.tile = p.tile")
