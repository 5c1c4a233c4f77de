"""Queries of aggregates, sources, sinks and catalog jobs (families A, S, B)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrane.functions import text as T
from terrane.operators import aggregates as A
from terrane.operators import build as U
from terrane.operators import geometry as G
from terrane.operators import graph as K
from terrane.operators import index as I
from terrane.operators import joins as J
from terrane.operators import quality as Q
from terrane.operators import rows as R
from terrane.plans import q_joins
from terrane.plans.base import Book
from terrane.plans.q_geometry import _Q
from terrane.sources import writers as W

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql

_SERIES = lambda t: t.fx_series.select("code", "yr", F.expr("case when (code + yr) % 4 = 0 then 'NaN' when (code + yr) % 7 = 0 then 'n/a' else cast(round(val, 2) as string) end").alias("value"), F.col("yr").alias("seq"))
_SERIES_SQL = "(select code, yr, val from fx_series where (code + yr) % 4 <> 0 and (code + yr) % 7 <> 0)"
add("a1_latest_by", lambda t: A.latest_by(_SERIES(t)), f"select code, max(yr) yr, round(arg_max(val, yr), 2) val from {_SERIES_SQL} group by code")
add("s8_read_series", lambda t: A.latest_by(_SERIES(t).select(F.from_json(F.to_json(F.struct("code", "yr", "value", "seq")), "code int, yr int, value string, seq int").alias("r")).select("r.*")), f"select code, max(yr) yr, round(arg_max(val, yr), 2) val from {_SERIES_SQL} group by code")
add("a7_status_rollup", lambda t: A.status_rollup(t.fx_coverage), "select place_id, count(*) filter (where status = 'above') \"above\", count(*) filter (where status = 'within') \"within\", count(*) filter (where status = 'below') \"below\", count(*) filter (where status = 'none') \"none\", count(*) filter (where status = 'nodata') nodata, count(*) cells, max(last_time) filter (where status <> 'nodata') latest from fx_coverage group by 1")
_METRIC = lambda t: t.fx_metric.withColumn("interval", F.expr("case when cls = 'click' then 10 else 1 end"))
_USAGE_SQL = "select api_key, date_trunc('month', ts) as month, cast(sum(bytes * case when cls = 'click' then 10 else 1 end) as bigint) bytes, count(*) requests from fx_metric group by 1, 2"
add("a8_usage_rollup", lambda t: A.usage_rollup(_METRIC(t)).withColumn("month", F.date_format("month", "yyyy-MM")), f"select api_key, strftime(month, '%Y-%m') as month, bytes, requests from ({_USAGE_SQL})")
add("a9_cap_state", lambda t: A.cap_state(A.usage_rollup(_METRIC(t)), t.fx_metric.select("api_key", F.expr("100000 + api_key * 1000").alias("cap")).distinct()).select("api_key", F.date_format("month", "yyyy-MM").alias("month"), "state", "percent"), f"select api_key, strftime(month, '%Y-%m') as month, case when bytes >= 100000 + api_key * 1000 then 'hard' when bytes * 1e0 / (100000 + api_key * 1000) >= 8e-1 then 'soft' else 'ok' end state, round(bytes * 1e0 / (100000 + api_key * 1000) * 100, 1) percent from ({_USAGE_SQL})")
_LIST = lambda t: t.fx_listing.withColumn("modified", F.expr("date_add(date'2024-01-01', cast(page_id % 300 as int))")).select(F.regexp_replace("key", r"[?#].*$", "").alias("key"), "size", "modified")
_DIR_SQL = """select directory, count(*) objects, cast(sum(size) as bigint) bytes, min(modified) oldest, max(modified) newest from (
  select unnest(list_concat(['/'], list_transform(range(1, len(st)), lambda i: array_to_string(st[1:i], '/') || '/'))) directory, size, modified
  from (select string_split(regexp_replace(key, '[?#].*$', ''), '/') st, size, cast(date '2024-01-01' + cast(page_id % 300 as integer) as date) modified from fx_listing)) group by 1"""
add("a10_directory_rollup", lambda t: A.directory_rollup(_LIST(t)), _DIR_SQL)
add("b10_storage_report", lambda t: A.directory_rollup(_LIST(t)).withColumn("gate", T.access_class(F.col("directory"), restricted=("internal", "private"))["gate"]).withColumn("label", T.size_label(F.col("bytes"))).orderBy(F.desc("bytes"), "directory").limit(40).select("directory", "objects", "gate", "label"), f"select directory, objects, case when split_part(directory, '/', 1) in ('internal', 'private') then 'key' else 'anonymous' end gate, case when bytes >= 1e6 then printf('%.1f MB', round(bytes / 1e6, 1)) when bytes >= 1e3 then printf('%.1f kB', round(bytes / 1e3, 1)) else cast(bytes as varchar) || ' B' end label from ({_DIR_SQL}) order by bytes desc, directory limit 40")
add("a11_collection_counts", lambda t: A.collection_counts(t.fx_index), "select collection, count(*) sites, count(name) named, count(distinct place_id) ids from fx_index group by 1")
add("a11_shared_ids", lambda t: A.shared_ids(t.fx_name.withColumn("place_id", F.col("k"))), "select k place_id, count(distinct collection) collections from fx_name group by k having count(distinct collection) > 1")
add("a12_infer_types", lambda t: A.infer_types(t.part.withColumn("mixed", F.expr("case when p_size = 3 then 'x' else '7' end")).withColumn("nothing", F.lit(None).cast("string")), ["p_partkey", "p_retailprice", "p_name", "mixed", "nothing"]), "select * from (values ('p_partkey', 'int'), ('p_retailprice', 'float'), ('p_name', 'string'), ('mixed', 'string'), ('nothing', 'string')) v(\"column\", \"type\")")
add("a13_content_checksum", lambda t: A.content_checksum(t.supplier.select("s_nationkey", "s_suppkey", "s_name"), "s_nationkey"), "select s_nationkey, sha256(cast(sum(cast(cast(('0x' || substring(h, 1, 15)) as bigint) as hugeint)) as varchar) || '|' || cast(sum(cast(cast(('0x' || substring(h, 16, 15)) as bigint) as hugeint)) as varchar) || '|' || cast(sum(cast(cast(('0x' || substring(h, 31, 15)) as bigint) as hugeint)) as varchar) || '|' || cast(sum(cast(cast(('0x' || substring(h, 46, 15)) as bigint) as hugeint)) as varchar)) checksum from (select s_nationkey, sha256(s_nationkey || '|' || s_suppkey || '|' || s_name) h from supplier) group by 1")
add("a14_empties", lambda t: A.empties(t.customer.withColumn("a", F.expr("case when c_custkey % 3 = 0 then ' ' when c_custkey % 3 = 1 then null else 'x' end")), ["a", "c_mktsegment"]), "select 'a' as rule, count(*) filter (where c_custkey % 3 <> 2) n from customer union all select 'c_mktsegment', 0")
add("a14_problems", lambda t: A.problems(t.lineitem, {"no_discount": F.col("l_discount") == 0, "late": F.year("l_shipdate") > 1997, "high": F.col("l_quantity") > 45}), "select 'no_discount' as rule, count(*) filter (where l_discount = 0) n from lineitem union all select 'late', count(*) filter (where year(l_shipdate) > 1997) from lineitem union all select 'high', count(*) filter (where l_quantity > 45) from lineitem")
add("a15_duplicate_ids", lambda t: R.duplicate_ids(t.orders.select(F.col("o_custkey").alias("place_id"))), "select o_custkey place_id, count(*) n from orders group by 1 having count(*) > 1")
_CB = lambda t: t.customer.select((F.col("c_nationkey")).alias("g"), F.expr("cast(((c_custkey * 37 + c_nationkey * 90) % 120) + c_nationkey * 10 - 180 as double)").alias("x0"), F.expr("cast(c_custkey % 9 + 1 as double)").alias("wd"), F.expr("cast(c_custkey % 50 - 25 as double)").alias("ymin"), F.expr("cast(c_custkey % 50 - 20 as double)").alias("ymax")).select("g", F.expr("case when x0 >= 180 then x0 - 360 else x0 end").alias("xmin"), F.expr("case when x0 + wd > 180 then x0 + wd - 360 else x0 + wd end").alias("xmax"), "ymin", "ymax")
_CB_SQL = "cb as (select g, case when x0 >= 180 then x0 - 360 else x0 end xmin, case when x0 + wd > 180 then x0 + wd - 360 else x0 + wd end xmax, ymin, ymax from (select c_nationkey g, cast(((c_custkey * 37 + c_nationkey * 90) % 120) + c_nationkey * 10 - 180 as double) x0, cast(c_custkey % 9 + 1 as double) wd, cast(c_custkey % 50 - 25 as double) ymin, cast(c_custkey % 50 - 20 as double) ymax from customer))"
_UNION_SQL = """sp as (select g, xmin a, case when xmin > xmax then 180e0 else xmax end b from {0} union all select g, -180e0, xmax from {0} where xmin > xmax),
rn as (select *, max(b) over (partition by g order by a, b rows between unbounded preceding and 1 preceding) bef from sp),
wh as (select g, min(a) west, max(b) east from sp group by g),
gp as (select g, a, bef, row_number() over (partition by g order by a - bef desc, a) r from rn where a > bef),
un as (select w.g, case when gp.a - gp.bef > west + 360 - east then gp.a else west end xmin, case when gp.a - gp.bef > west + 360 - east then gp.bef else east end xmax from wh w left join gp on gp.g = w.g and r = 1)"""
add("a16_union_bbox", lambda t: A.union_bbox(_CB(t), "g"), f"with {_CB_SQL}, {_UNION_SQL.format('cb')} select un.g, xmin, ymin, xmax, ymax from un join (select g, min(ymin) ymin, max(ymax) ymax from cb group by g) l on l.g = un.g")
add("g12_place_bbox", lambda t: A.place_bbox(_CB(t).where("xmin <= xmax"), "g"), f"with {_CB_SQL}, pt as (select * from cb where xmin <= xmax), wd as (select g, max(xmax) - min(xmin) > 180 w from pt group by g), gr as (select p.g, min(xmin) xmin, min(ymin) ymin, max(xmax) xmax, max(ymax) ymax from pt p join wd on wd.g = p.g group by p.g, case when w then case when (xmin + xmax) / 2 < 0 then 1 else 2 end else 0 end), {_UNION_SQL.format('gr')} select un.g, un.xmin, ymin, un.xmax, ymax from un join (select g, min(ymin) ymin, max(ymax) ymax from pt group by g) l on l.g = un.g")
add("g13_unwrap_crossing", lambda t: A.unwrap_crossing(t.supplier.select("s_nationkey", "s_suppkey", F.expr("case when s_suppkey % 2 = 0 then 170D else -180D end").alias("xmin"), F.lit(0.0).alias("ymin"), F.expr("case when s_suppkey % 2 = 0 then 180D else -170D end").alias("xmax"), F.lit(1.0).alias("ymax")), "s_nationkey").select("s_suppkey", "xmin", "xmax"), "select s_suppkey, case when s_suppkey % 2 = 0 then 170e0 when b then 180e0 else -180e0 end xmin, case when s_suppkey % 2 = 0 then 180e0 when b then 190e0 else -170e0 end xmax from (select s_suppkey, count(*) filter (where s_suppkey % 2 = 0) over (partition by s_nationkey) > 0 and count(*) filter (where s_suppkey % 2 = 1) over (partition by s_nationkey) > 0 b from supplier)")
add("a17_source_date", lambda t: t.orders.select("o_orderkey", A.source_date(F.expr("array(named_struct('last_edit', cast(o_orderdate as string)), named_struct('last_edit', cast(null as string)), named_struct('last_edit', '1995-06-01T00:00:00'))")).alias("d")), "select o_orderkey, greatest(strftime(o_orderdate, '%Y-%m-%d'), '1995-06-01') d from orders")
add("a18_colour_domain", lambda t: A.colour_domain(t.lineitem, "l_returnflag", "l_extendedprice"), "select l_returnflag, max(case when r = floor(5e-2 * (n - 1)) + 1 then v end) lo, max(case when r = floor(95e-2 * (n - 1)) + 1 then v end) hi from (select l_returnflag, l_extendedprice v, row_number() over (partition by l_returnflag order by l_extendedprice) r, count(*) over (partition by l_returnflag) n from lineitem) group by 1")
add("a19_group_layers", lambda t: A.group_layers(t.nation.select(F.expr("case when n_regionkey = 2 then '  ' else concat('R', n_regionkey) end").alias("authority"), F.col("n_name").alias("title"))).withColumn("titles", F.array_join("titles", ",")), "select case when n_regionkey = 2 then 'Other' else 'R' || n_regionkey end authority, string_agg(n_name, ',' order by n_name) titles, n_regionkey = 2 as \"last\" from nation group by n_regionkey")
add("a20_line_stats", lambda t: A.line_stats(t.orders.select(F.expr("o_orderkey % 3000").alias("line"), F.expr("o_orderkey div 3000").alias("station"), (F.col("o_totalprice") > 200000).alias("core"))), "select o_orderkey % 3000 as line, count(*) n, count(*) filter (where o_totalprice > 200000) n_core, max(o_totalprice) > 200000 any_core, min(o_orderkey // 3000) as first, max(o_orderkey // 3000) as last, count(*) < 2 too_short from orders group by 1")
_STATIONS = lambda t: t.fx_point.selectExpr("point_id % 300 as line", "point_id as station", "lon", "lat", "v > 200000 as core").withColumn("before", F.lag(F.struct("lon", "lat")).over(Window.partitionBy("line").orderBy("station")))
add("a20_line_lengths", lambda t: A.line_stats(_STATIONS(t), G.haversine_km(F.col("before.lon"), F.col("before.lat"), F.col("lon"), F.col("lat"))).select("line", "n", "length_km", "too_short"), "select line, count(*) n, round(sum(2 * 6371.0088 * asin(sqrt(pow(sin(radians(lat - b) / 2), 2) + cos(radians(b)) * cos(radians(lat)) * pow(sin(radians(lon - a) / 2), 2)))), 1) length_km, count(*) < 2 too_short from (select point_id % 300 line, lon, lat, lag(lon) over w a, lag(lat) over w b from fx_point window w as (partition by point_id % 300 order by point_id)) group by 1")
add("a21_layer_status", lambda t: A.layer_status(t.fx_event.select(F.col("k").alias("layer"), F.col("d").alias("date"), F.concat(F.lit("in_"), "status").alias("value"), "seq")), "select k layer, d as date, 'in_' || status as value, 'in ' || status || ' ' || d as label from (select *, row_number() over (partition by k order by d desc, seq desc) r from fx_event) where r = 1")
add("a24_expected_count", lambda t: A.expected_count(t.customer, "c_nationkey", t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.expr("60 + n_nationkey % 3").alias("expected"), F.expr("case when n_regionkey = 1 then 'fail' else 'warn' end").alias("mode"))), "select n_nationkey c_nationkey, coalesce(n, 0) n, 60 + n_nationkey % 3 expected, case when n_regionkey = 1 then 'fail' else 'warn' end problem from nation left join (select c_nationkey, count(*) n from customer group by 1) on c_nationkey = n_nationkey where coalesce(n, 0) <> 60 + n_nationkey % 3")
add("a25_provenance", lambda t: A.provenance(t.supplier.select("s_nationkey", F.col("s_suppkey").alias("source_no"), F.concat(F.lit("u/"), "s_name").alias("url"), F.expr("case when s_suppkey % 2 = 0 then ' ' else 'x' end").alias("extra"), F.col("s_suppkey").alias("n")), "s_nationkey"), "select s_nationkey, '[' || string_agg('{\"source_no\":' || s_suppkey || ',\"url\":\"u/' || s_name || '\"' || case when s_suppkey % 2 = 0 then '' else ',\"extra\":\"x\"' end || ',\"n\":' || s_suppkey || '}', ',' order by s_suppkey) || ']' sources, cast(sum(s_suppkey) as bigint) as rows from supplier group by 1")

# sources and sinks ----
add("s6_read_sites", lambda t: t.fx_index.select(R.pick_col(t.fx_index, ["PLACE_ID"]).alias("place_id"), R.pick_col(t.fx_index, ["area_km2"]).alias("area_km2"), R.pick_col(t.fx_index, ["Name"]).alias("name")), "select place_id, cast(null as varchar) area_km2, name from fx_index")
add("s9_read_listing", lambda t: _LIST(t).groupBy(F.regexp_extract("key", r"\.([a-z]+)/", 1).alias("domain")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "select regexp_extract(regexp_replace(key, '[?#].*$', ''), '\\.([a-z]+)/', 1) as domain, count(*) n, cast(sum(size) as bigint) bytes from fx_listing group by 1")
add("s12_membership_layout", lambda t: W.membership_manifest(t.lineitem.select(F.col("l_suppkey").alias("place_id"), F.expr("l_linenumber").alias("res"), F.expr("l_orderkey % 7").alias("parent"))), "select l_linenumber res, l_orderkey % 7 parent, count(*) as rows, count(distinct l_suppkey) sites from lineitem group by 1, 2")
add("s13_feature_ndjson", lambda t: W.feature_lines(t.fx_point.select("point_id", F.expr("case when point_id % 2 = 0 then 'even' end").alias("kind"), F.expr("concat('{\"type\":\"Point\",\"coordinates\":[', cast(point_id as string), ',0]}')").alias("geometry")), ["point_id", "kind"]), "select '{\"type\":\"Feature\",\"properties\":{\"point_id\":' || point_id || case when point_id % 2 = 0 then ',\"kind\":\"even\"' else '' end || '},\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || point_id || ',0]}}' line from fx_point")
add("s14_index_rows", lambda t: K.same_place_groups(t.fx_index).select("place_id", "collection", "name", "group_id").withColumn("rank", T.search_rank(F.expr("case when collection = 'suppliers' then 'mpa_inventory' when place_id like '%7' then 'protectedseas_a' when place_id like '%8' then 'mine' else collection end"), own="mine")), q_joins.SAME_PLACE_SQL.replace("select collection, place_id, case when g", "select place_id, collection, name, case when collection = 'suppliers' or place_id like '%7' then 1 when place_id like '%8' then 2 else 0 end as rank, case when g"))
add("s15_export_values", lambda t: W.export_values(t.fx_value.withColumnRenamed("t", "time").withColumnRenamed("v", "value").withColumn("sd", F.lit(None).cast("double")).withColumn("unit", F.lit("m, deep")), "SUP:11", "suppliers.parquet"), "select 'SUP:11,suppliers,' || indicator || ',month,' || strftime(t, '%Y-%m-%d') || ',' || class || ',' || n || ',,\"m, deep\",suppliers.parquet' line from fx_value where place_id = 'SUP:11'")
add("s16_partitioned_tiles", lambda t: t.fx_point.withColumn("tile", F.floor((F.col("lon") + 180) / 10)).join(t.fx_box.select(F.explode(F.sequence(F.floor((F.col("xmin") + 180) / 10), F.floor((F.col("xmax") + 180) / 10))).alias("tile")).distinct(), "tile").groupBy("tile").agg(F.count("*").alias("n")), "select floor((lon + 180) / 10) tile, count(*) n from fx_point where floor((lon + 180) / 10) in (select unnest(range(cast(floor((xmin + 180) / 10) as bigint), cast(floor((xmax + 180) / 10) as bigint) + 1)) from fx_box) group by 1")

# catalog jobs ----
_RAW = lambda t: t.supplier.select("s_suppkey", "s_name", "s_nationkey", F.expr("case when s_suppkey % 6 = 0 then 'Withdrawn' else 'Active' end").alias("state"), F.col("s_acctbal").alias("Name"))
_BUILT = lambda t: J.apply_events(R.suffixed(R.rename_natives(R.exclude(_RAW(t), {"state": ["Withdrawn"]})).select("*", T.template("NAT:{s_nationkey}").alias("base_id"), T.template("{s_name|slug}").alias("name")), "base_id", F.lit("zone"), F.col("s_suppkey")).withColumn("key", F.col("s_suppkey")), _B_EVENTS(t), "key", F.lit("designated"), F.lit("https://x.test"), F.lit(""))
_B_EVENTS = lambda t: t.fx_event.select(F.col("k").alias("key"), F.col("d").alias("date"), F.col("status").alias("value"), "source", "seq")
_BUILT_SQL = "(select s_suppkey, case rk when 1 then nk when 2 then nk || ':zone' else nk || ':zone-' || (rk - 1) end unique_id, trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-') as name, s_acctbal \"Name_src\", coalesce(e.status, 'designated') status from (select *, 'NAT:' || s_nationkey nk, row_number() over (partition by s_nationkey order by s_suppkey) rk from supplier where s_suppkey % 6 <> 0) left join (select *, row_number() over (partition by k order by d desc, seq desc) r from fx_event) e on e.k = s_suppkey and e.r = 1)"
add("b1_build_collection", lambda t: _BUILT(t).select("s_suppkey", "unique_id", "name", "Name_src", "status"), f"select * from {_BUILT_SQL}")
_NATIVE = lambda df, k, state: df.selectExpr(f"{k}_{'suppkey' if k == 's' else 'custkey'} as key", f"{k}_nationkey as nat", f"{k}_name as label", f"{state} as state", f"cast({k}_acctbal as string) as Name")
_KEPT_SEGMENTS = ["BUILDING", "MACHINERY"]


def _two_sources(t) -> list[U.Source]:
    """Suppliers as polygons, some without geometry, and customers as points."""
    corners = t.fx_vertex.join(t.fx_place.select("place_id", F.col("k").alias("feature")), "place_id").where("feature % 9 != 0").select("feature", "part", "ring", "seq", "x", "y", F.lit("polygon").alias("kind"))
    points = t.customer.selectExpr("c_custkey as feature", "1 as part", "0 as ring", "1 as seq", "cast(c_custkey * 7 % 360 - 180 as double) as x", "cast(c_custkey % 180 - 90 as double) as y", "'point' as kind")
    return [
        U.Source("area", _NATIVE(t.supplier, "s", "case when s_suppkey % 6 = 0 then 'Withdrawn' else 'Active' end"), corners, "key", {"Name": "float"}, exclude={"state": ["Withdrawn"]}, edit_day="2024-01-05"),
        U.Source("point", _NATIVE(t.customer, "c", "c_mktsegment"), points, "key", {"Name": "float"}, include={"state": _KEPT_SEGMENTS}, exclude={"nat": [3]}, retrieved="2024-02-03"),
    ]


_TWO = {"place_id": "NAT:{nat}", "source_id": "{key}", "name": "{label|slug}", "authority": "NAT", "place_type": "nation", "license": "CC0", "attribution": " two   words ", "version": "1.0", "status": "designated", "status_source": "https://x.test", "pattern": r"^NAT:\d+(:(area|point)(-\d+)?)?$", "order": "space"}
_TWO_BUILT = lambda t: U.build_collection(_TWO, _two_sources(t), _B_EVENTS(t), "key")
_TWO_SQL = """nn as (select 'area' component, 1 cr, s_suppkey as key, s_nationkey nat, s_name label, case when s_suppkey % 6 = 0 then 'Withdrawn' else 'Active' end state, s_acctbal amount from supplier union all select 'point', 2, c_custkey, c_nationkey, c_name, c_mktsegment, c_acctbal from customer),
nr as (select *, case when component = 'area' and state = 'Withdrawn' then 'state=Withdrawn' when component = 'point' and state not in ('BUILDING', 'MACHINERY') then 'not included' when component = 'point' and nat = 3 then 'nat=3' when component = 'area' and key % 9 = 0 then 'no geometry' end reason from nn),
nk as (select *, row_number() over (partition by nat order by cr, cast(key as varchar)) rk from nr where reason is null),
ni as (select *, 'NAT:' || nat || case when rk = 1 then '' else ':' || component || case when row_number() over (partition by nat, component, rk > 1 order by rk) = 1 then '' else '-' || row_number() over (partition by nat, component, rk > 1 order by rk) end end place_id from nk)"""
add("b1_two_sources", lambda t: _TWO_BUILT(t).places.select("place_id", "component", "source_id", "name", "geom_type", "Name_src", "state", "status", "n_events", "attribution", "authority", F.col("source_date").cast("string").alias("source_date")), f"""with {_TWO_SQL}, ev as (select k, arg_max(status, struct_pack(d := d, seq := seq)) status, count(*) n from fx_event group by 1)
select place_id, component, cast(key as varchar) source_id, trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-') as name, case component when 'area' then 'MultiPolygon' else 'MultiPoint' end geom_type, amount "Name_src", state, coalesce(ev.status, 'designated') status, cast(coalesce(ev.n, 0) as integer) n_events, 'two words' attribution, 'NAT' authority, case component when 'area' then '2024-01-05' else '2024-02-03' end source_date from ni left join ev on k = key""")
add("b1_dropped", lambda t: _TWO_BUILT(t).dropped, f"with {_TWO_SQL} select component, reason, count(*) n from nr where reason is not null group by 1, 2")
add("b1_vertices", lambda t: _TWO_BUILT(t).vertices.groupBy("place_id").agg(F.count("*").alias("n"), F.min("x").alias("west"), F.min("kind").alias("kind")), f"with {_TWO_SQL}, vv as (select 'area' component, k, x, 'polygon' kind from fx_vertex v join fx_place p on p.place_id = v.place_id union all select 'point', c_custkey, cast(c_custkey * 7 % 360 - 180 as double), 'point' from customer) select ni.place_id, count(*) n, min(x) west, min(kind) kind from ni join vv on vv.component = ni.component and vv.k = ni.key group by 1")
add("p1_observed_filter", lambda t: _observed(t), "select 'rows' as counted, count(*) n from part union all select 'not included', count(*) from part where p_size > 40 union all select 'p_brand=' || p_brand, count(*) from part where p_size <= 40 and p_brand in ('Brand#1', 'Brand#2') group by 1 union all select 'kept', count(*) from part where p_size <= 40 and p_brand not in ('Brand#1', 'Brand#2')")


def _observed(t):
    """What one pass of include and exclude rules kept and dropped."""
    kept, seen = U.observed_filter(t.part, {"p_size": list(range(1, 41))}, {"p_brand": ["Brand#1", "Brand#2"]})
    n = U.written(kept).count()
    return t.spark.createDataFrame([*((k, v) for k, v in seen.get.items() if v), ("kept", n)], "counted string, n long")


add("b2_check_collection", lambda t: A.problems(_BUILT(t), {"bad_id": ~R.matches_ids(F.col("unique_id"), [r"NAT:\d+(:zone(-\d+)?)?"]), "no_name": F.col("name") == "", "suffixed": F.col("unique_id").contains(":zone"), "negative": F.col("Name_src") < 0}), f"select 'bad_id' as rule, 0 n union all select 'no_name', 0 union all select 'suffixed', count(*) from {_BUILT_SQL} where contains(unique_id, ':zone') union all select 'negative', count(*) from {_BUILT_SQL} where \"Name_src\" < 0")
_ID = "concat(case when {k} % 19 = 1 then 'SUP-' else 'SUP:' end, cast({k} as {string}))"
_CHECKED = lambda t: _BUILT(t).join(t.fx_box.drop("place_id"), F.col("k") == F.col("s_suppkey")).select(F.expr(_ID.format(k="k", string="string")).alias("place_id"), F.expr("case when k % 12 <> 7 then name end").alias("name"), "status", F.expr("case when k % 31 = 5 then ' ' when k % 9 = 2 then 'other' else 'CC-BY-4.0' end").alias("license"), F.expr("case when k % 11 = 4 then 'Polygon' else 'MultiPolygon' end").alias("geom_type"), F.expr("case when k % 13 = 2 then xmin + 0.5D else xmin end").alias("xmin"), "ymin", "xmax", "ymax", F.explode(F.expr("sequence(1, case when k % 23 = 1 then 2 else 1 end)")).alias("copy"))
_CHECKED_V = lambda t: t.fx_vertex.join(t.fx_place.select("place_id", "k", "cx", "r"), "place_id").where("not (seq = 6 and k % 7 = 0) and k % 29 <> 3").select(F.expr(_ID.format(k="k", string="string")).alias("place_id"), "part", "ring", "seq", F.expr("case when k % 5 = 1 and seq = 4 then cx + 2 * r else x end").alias("x"), "y")
_RULES_SQL = {"bad_id": "k % 19 = 1", "empty_name": "k % 12 = 7", "empty_status": "coalesce(trim(status), '') = ''", "empty_license": "k % 31 = 5", "other_license": "k % 31 = 5 or k % 9 = 2", "other_kind": "k % 11 = 4", "no_geometry": "not g", "invalid": "g and (k % 7 = 0 or k % 5 = 1)", "jumps": "false", "outside": "g and (cx - r < -180 or cx + r * case when k % 5 = 1 then 2 else 1 end > 180)", "other_box": "g and (k % 13 = 2 or k % 5 = 1)"}
add("b2_collection_problems", lambda t: Q.check_collection(_CHECKED(t), _CHECKED_V(t), [r"SUP:\d+"], "CC-BY-4.0", "MultiPolygon"), f"with s as (select p.k, p.cx, p.r, b.status, p.k % 29 <> 3 g from {_BUILT_SQL} b join fx_place p on p.k = b.s_suppkey, range(case when p.k % 23 = 1 then 2 else 1 end)) " + " union all ".join(f"select '{rule}' as rule, count(*) filter (where {sql}) n from s" for rule, sql in _RULES_SQL.items()) + " union all select 'repeated_id', count(*) from (select k from s group by k having count(*) > 1)")
add("b3_build_index", lambda t: t.fx_index.where("geom_type = 'Polygon'").groupBy("collection").agg(F.count("*").alias("sites"), F.round(F.sum((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))), 4).alias("area")).join(A.union_bbox(t.fx_index.select("collection", "xmin", "ymin", "xmax", "ymax"), "collection"), "collection"), "with a as (select collection, count(*) sites, round(sum((xmax - xmin) * (ymax - ymin)), 4) area from fx_index where geom_type = 'Polygon' group by 1), b as (select collection, min(xmin) xmin, min(ymin) ymin, max(xmax) xmax, max(ymax) ymax from fx_index group by 1) select * from a join b using (collection)")


def _layers(t) -> list[I.Layer]:
    """Suppliers as polygons, customers as points, and nations, which are unlisted."""
    named = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey"))
    sites = t.supplier.join(named, F.expr("s_nationkey = n_nationkey")).selectExpr(
        "concat('SUP:', s_suppkey) place_id", "upper(n_name) as NAME", "cast(case when s_suppkey % 4 = 0 then 0 else s_suppkey end as double) WDPAID", "concat('Q', s_suppkey) psgid",
        "case when s_suppkey % 5 = 0 then concat('P', s_suppkey) end proseasid", "r_name region", "n_name nation", "s_suppkey k", "case when s_suppkey % 3 = 0 then ' own  licence ' else '' end license", "case when s_suppkey % 7 = 0 then 12.5D end sq",
    )
    points = t.customer.join(named, F.expr("c_nationkey = n_nationkey")).selectExpr("c_custkey", "case when c_custkey % 2 = 1 then concat('MRGID:', c_custkey, ':x') else concat('CUS:', c_custkey) end place_id", "lower(n_name) name", "cast(c_nationkey as double) source_id")
    at = points.selectExpr("place_id", "1 as part", "0 as ring", "1 as seq", "cast(c_custkey * 7 % 360 - 180 as double) as x", "cast(c_custkey % 180 - 90 as double) as y", "'point' as kind")
    return [
        I.Layer("sites", sites, t.fx_vertex.withColumn("kind", F.lit("polygon")), {"geometry_type": "MultiPolygon", "license": "CC0", "attribution": " By  us. ", "place_type": "area", "updated": "2024-01-01"}, "2", "https://x.test/{k}?n={WDPAID}", "sq", ("region", "nation", "absent")),
        I.Layer("points", points, at, {"providers": [{"name": "P", "roles": ["producer"]}, {"name": "H", "roles": ["host"]}], "processor": "them", "license": "L"}, usual_types={"CUS": "customer"}),
        I.Layer("hidden", t.nation.selectExpr("concat('NAT:', n_nationkey) place_id"), None, {"access": "unlisted"}),
    ]


_INDEX = lambda t: I.build_index(_layers(t))
_INDEX_SQL = f"""ip as (select 'points' collection, case when c_custkey % 2 = 1 then 'MRGID:' || c_custkey || ':x' else 'CUS:' || c_custkey end place_id, c_custkey k, lower(n_name) as name, case when c_nationkey <> 0 then cast(c_nationkey as varchar) end source_id, cast(c_custkey * 7 % 360 - 180 as double) x, cast(c_custkey % 180 - 90 as double) y from customer join nation on c_nationkey = n_nationkey),
ib as (select place_id, min(xa) xmin, min(ya) ymin, max(xa) xmax, max(ya) ymax, sum((xa + xb) * (xa * yb - xb * ya)) / (3 * sum(xa * yb - xb * ya)) lon, sum((ya + yb) * (xa * yb - xb * ya)) / (3 * sum(xa * yb - xb * ya)) lat, sum((xa - xb) * ({_Q.format('ya')} + {_Q.format('yb')})) / 2 * radians(1) * 6378.137 * 6378.137 / 2 km2 from fx_edge group by 1),
ix as (select place_id, upper(n_name) as name, 'SUP' authority, 'area' place_type, 'MultiPolygon' geom_type, 'sites' collection, xmin, ymin, xmax, ymax, lon, lat, case when s_suppkey % 7 = 0 then 12.5 else km2 end km2, case when s_suppkey % 3 = 0 then 'own licence' else 'CC0' end license, 'By us.' attribution, '2' as version, '2024-01-01' updated, null source_id, case when s_suppkey % 4 <> 0 then 'https://x.test/' || s_suppkey || '?n=' || s_suppkey end url, r_name keywords
  from supplier join ib on place_id = 'SUP:' || s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  union all select place_id, name, split_part(place_id, ':', 1), case when k % 2 = 0 then 'customer' end, 'Point', collection, x, y, x, y, x, y, null, 'L', 'P. Processed by them.', null, null, source_id, null, null from ip)"""
add("b3_index_places", lambda t: _INDEX(t).places.drop("group_id").withColumnsRenamed({"centroid_lon": "lon", "centroid_lat": "lat", "area_km2": "km2"}).withColumns({c: F.round(c, 6) for c in ("lon", "lat")}).withColumn("km2", F.round("km2", 0)), f"with {_INDEX_SQL} select * replace (round(lon, 6) as lon, round(lat, 6) as lat, round(km2, 0) as km2) from ix")
add("b3_crosswalk", lambda t: _INDEX(t).crosswalk, "select 'SUP:' || s_suppkey place_id, null mrgid, case when s_suppkey % 5 = 0 then 'P' || s_suppkey end psgid, case when s_suppkey % 4 <> 0 then cast(s_suppkey as varchar) end wdpa_id, null mpainv_site_id, null mpatlas_id, null wikidata_qid, null gers_id from supplier where s_suppkey % 5 = 0 or s_suppkey % 4 <> 0 union all select 'MRGID:' || c_custkey || ':x', cast(c_custkey as varchar), null, null, null, null, null, null from customer where c_custkey % 2 = 1")
add("b3_index_counts", lambda t: _INDEX(t).counts.unionByName(_INDEX(t).crosswalk_counts.select(F.inline(F.expr("array(struct('crosswalk' as collection, rows as n), struct('psgid' as collection, psgid as n), struct('mrgid' as collection, mrgid as n), struct('wdpa_id' as collection, wdpa_id as n))")))), "select 'sites' collection, count(*) n from supplier union all select 'points', count(*) from customer union all select 'psgid', count(*) filter (where s_suppkey % 5 = 0) from supplier union all select 'wdpa_id', count(*) filter (where s_suppkey % 4 <> 0) from supplier union all select 'mrgid', count(*) filter (where c_custkey % 2 = 1) from customer union all select 'crosswalk', (select count(*) from supplier where s_suppkey % 5 = 0 or s_suppkey % 4 <> 0) + (select count(*) from customer where c_custkey % 2 = 1)")
add("b4_layers_manifest", lambda t: J.attach_if_current(t.nation.select(F.col("n_name").alias("slug"), F.sha2("n_name", 256).alias("sha"), T.search_rank("n_name").alias("search_rank"), T.citation(F.lit(None).cast("string"), F.lit("By us."), F.initcap("n_name"), F.lit("1"), F.lit(2024)).alias("citation")), t.supplier.groupBy(F.col("s_nationkey").alias("n")).agg(F.count("*").alias("rows")).join(t.nation, F.expr("n = n_nationkey")).select(F.col("n_name").alias("slug"), F.sha2("n_name", 256).alias("sha"), "rows")).select("slug", "search_rank", "rows"), "select n_name slug, 0 search_rank, r as rows from nation left join (select s_nationkey, count(*) r from supplier group by 1) on s_nationkey = n_nationkey")
_CONTRIB = lambda t: t.customer.select(F.col("c_custkey").alias("id"), F.expr("case when c_custkey % 4 = 0 then null else c_mktsegment end").alias("name"), F.expr("case when c_custkey % 3 = 0 then 'all rights' else 'CC-BY-4.0' end").alias("license"), F.expr("case when c_custkey % 5 = 0 then 'ftp://x' else 'https://x.test' end").alias("source_url"), F.expr("case when c_custkey % 2 = 0 then '0000-0002-1825-0097' else '0000' end").alias("orcid"))
add("b6_validate_contributions", lambda t: _CONTRIB(t).select("id", F.array_compact(F.array(F.when(F.col("name").isNull(), F.lit("name")), F.when(~F.col("license").startswith("CC"), F.lit("license")), F.when(~T.orcid_valid("orcid"), F.lit("orcid")))).alias("errors"), F.array_compact(F.array(F.when(~F.col("source_url").startswith("http"), F.lit("source_url")))).alias("warnings")).select("id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), (F.size("errors") == 0).alias("ok")), "select c_custkey id, coalesce(concat_ws(',', case when c_custkey % 4 = 0 then 'name' end, case when c_custkey % 3 = 0 then 'license' end, case when c_custkey % 2 = 1 then 'orcid' end), '') errors, case when c_custkey % 5 = 0 then 'source_url' else '' end warnings, c_custkey % 4 <> 0 and c_custkey % 3 <> 0 and c_custkey % 2 = 0 ok from customer")
_DIR = "concat(case when {k} % 17 = 3 then 'OM-I' else 'OM-0' end, lpad(cast({k} as {string}), 25, '0'))"
_KIND = "case when {k} % 9 = 0 then 'other' when {k} % 2 = 0 then 'reserve' else 'park' end"
_OFFERED = lambda t: t.customer.select(F.expr(_DIR.format(k="c_custkey", string="string")).alias("dir"), F.expr("case when c_custkey % 4 = 0 then ' ' else concat('Site ', c_custkey % 700) end").alias("name"), F.expr(_KIND.format(k="c_custkey")).alias("place_type"), F.expr("case when c_custkey % 7 = 2 then 'all rights' else 'CC-BY-4.0' end").alias("license"), F.expr("case when c_custkey % 14 <> 5 then 'us' end").alias("attribution"), F.expr("case when c_custkey % 8 = 1 then '0000' when c_custkey % 8 > 4 then '0000-0002-1825-009X' end").alias("contributor_orcid"), F.expr("case when c_custkey % 10 = 6 then 'ftp://x' else 'https://x.test' end").alias("source_url"))
_OFFERED_V = lambda t: t.fx_vertex.join(t.fx_place.select("place_id", "k", "cx", "r"), "place_id").select(F.expr(_DIR.format(k="k", string="string")).alias("place_id"), "part", "ring", F.expr("case when k % 6 = 5 then 7 - seq else seq end").alias("seq"), F.expr("case when k % 16 = 9 and seq = 2 then double('NaN') when k % 5 = 1 and seq = 4 then cx + 2 * r else x end").alias("x"), F.expr("case when k % 15 = 4 then y + 200 else y end").alias("y"))
_OFFERED_SQL = f"""with c as (select c_custkey k, {_DIR.format(k="c_custkey", string="varchar")} dir, {_KIND.format(k="c_custkey")} kind, case when c_custkey % 4 <> 0 then c_custkey % 700 end as name from customer),
d as (select c.*, count(*) over (partition by kind, name) > 1 or (kind = 'reserve' and exists (select 1 from supplier where s_suppkey = c.name)) used, cx, r,
  case when p.k is null then 'no_geometry' when c.k % 16 = 9 then 'no_numbers' when c.k % 15 = 4 then 'degrees' end g from c left join fx_place p on p.k = c.k),
e as (select dir, concat_ws(',', case when k % 17 = 3 then 'dir' end, case when name is null then 'name' end, case when k % 9 = 0 then 'place_type' end, case when k % 7 = 2 then 'license' end, case when k % 14 = 5 then 'attribution' end, case when k % 8 = 1 then 'orcid' end, case when k % 10 = 6 then 'source_url' end, g) errors,
  concat_ws(',', case when g is null and k % 6 = 5 then 'winding' end, case when g is null and k % 5 = 1 then 'repair' end, case when g is null and (cx - r < -180 or cx + r * case when k % 5 = 1 then 2 else 1 end > 180) then 'split' end, case when name is not null and used then 'name_used' end) warnings from d)
select dir, errors, warnings, errors = '' as ok from e"""
add("b6_contribution_checks", lambda t: Q.check_contributions(_OFFERED(t), _OFFERED_V(t), t.supplier.select(F.expr("concat('site  ', s_suppkey)").alias("name"), F.lit("reserve").alias("place_type")), ["reserve", "park"], ["CC0-1.0", "CC-BY-4.0", "ODbL-1.0"]).withColumn("errors", F.array_join("errors", ",")).withColumn("warnings", F.array_join("warnings", ",")), _OFFERED_SQL)
add("b9_zone_indicators", lambda t: J.assign_indicator(t.fx_zone, A.latest_by(_SERIES(t))).groupBy("basis", "yr").agg(F.count("*").alias("zones"), F.round(F.sum("val"), 2).alias("total")), f"with l as (select code, max(yr) yr, round(arg_max(val, yr), 2) val from {_SERIES_SQL} group by code), z as (select case when p then coalesce(a.yr, b.yr) end yr, case when p then coalesce(a.val, b.val) end val, case when p and a.yr is not null then 'territory' when p and b.yr is not null then 'sovereign' end basis from (select *, pol_type = '200NM' p from fx_zone) z left join l a on a.code = z.ter left join l b on b.code = z.sov) select basis, yr, count(*) zones, round(sum(val), 2) total from z group by 1, 2")
