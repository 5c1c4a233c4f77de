"""Queries of row operators, scalar functions, ids, sets and order (families P, F, W-1..4, U, O)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrane.functions import boxes as B
from terrane.functions import text as T
from terrane.operators import rows as R
from terrane.plans.base import Book

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql
_RULES = {"p_brand": ["Brand#11", "Brand#23"], "p_size": [1, 7, 15]}
_RULE_SQL = "case when p_brand in ('Brand#11','Brand#23') then 'p_brand' when cast(p_size as varchar) in ('1','7','15') then 'p_size' end"

# P ----
add("p1_exclude", lambda t: R.exclude(t.part, _RULES).select("p_partkey", "p_brand", "p_size"), f"select p_partkey, p_brand, p_size from part where {_RULE_SQL} is null")
add("p1_exclude_counts", lambda t: R.exclude_counts(t.part, _RULES), f"select {_RULE_SQL} as rule, count(*) n from part where {_RULE_SQL} is not null group by 1")
add("p2_include", lambda t: R.include(t.orders, {"o_orderstatus": ["O", "P"], "o_orderpriority": ["1-URGENT", "2-HIGH"]}).select("o_orderkey"), "select o_orderkey from orders where o_orderstatus in ('O','P') and o_orderpriority in ('1-URGENT','2-HIGH')")
add("p2_include_left_out", lambda t: R.include_left_out(t.orders, {"o_orderstatus": ["O", "P"]}), "select count(*) filter (where not o_orderstatus in ('O','P')) left_out, count(*) filter (where o_orderstatus in ('O','P')) kept from orders")
_KIND = lambda df: df.withColumn("kind", F.expr("case when p_size % 5 = 4 then null else p_size % 4 end")).withColumn("pct", F.expr("case when p_partkey % 3 = 0 then null else p_retailprice - 1200 end"))
_KIND_SQL = "(select *, case when p_size % 5 = 4 then null else p_size % 4 end kind, case when p_partkey % 3 = 0 then null else p_retailprice - 1200 end pct from part)"
add("p3_marine_filter", lambda t: R.marine_filter(_KIND(t.part), "kind", "pct").select("p_partkey"), f"select p_partkey from {_KIND_SQL} where kind is null or kind in (0, 2) or coalesce(pct > 0, false)")
add("p3_marine_counts", lambda t: R.marine_counts(_KIND(t.part), "kind", "pct"), f"select count(*) filter (where k) kept, count(*) filter (where not k) inland from (select kind is null or kind in (0, 2) or coalesce(pct > 0, false) k from {_KIND_SQL})")
add("p4_listed", lambda t: R.listed(t.customer.withColumn("access", F.expr("case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then 'unlisted' else 'public' end"))).select("c_custkey", "access"), "select c_custkey, case when c_custkey % 3 = 0 then null else 'public' end access from customer where c_custkey % 3 <> 1")
add("p5_polygon_layers", lambda t: R.polygon_layers(t.fx_index.withColumn("place_type", F.expr("case when k % 4 = 0 then null else 'eez' end"))).select("place_id"), "select place_id from fx_index where geom_type = 'Polygon' and k % 4 <> 0")
add("p6_rename_natives", lambda t: R.rename_natives(t.nation.withColumnRenamed("n_name", "Name").withColumnRenamed("n_nationkey", "key")).select("key", "Name_src"), "select n_nationkey as key, n_name as \"Name_src\" from nation")
add("p7_coerce", lambda t: R.coerce(t.events.select("event_id", F.get_json_object("props", "$.k").alias("k_text"), F.col("value").cast("string").alias("v"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at")), {"v": "float", "at": "date"}).select("event_id", "v", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at")), "select event_id, value v, strftime(ts, '%Y-%m-%d %H:%M:%S') as at from events")
add("p8_stamp_common", lambda t: R.stamp_common(t.nation, {"id": "NAT:{n_nationkey}", "name": "{n_name|slug}", "authority": "NAT", "place_type": "nation", "license": "CC0", "attribution": " two   words ", "version": "1.0"}, F.expr("case when n_regionkey = 0 then null else date'2024-01-05' end"), F.lit("2024-02-03 10:00:00")).select("place_id", "name", "authority", "license", "attribution", "version", F.col("source_date").cast("string").alias("source_date")), "select 'NAT:' || n_nationkey place_id, trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') as name, 'NAT' authority, 'CC0' license, 'two words' attribution, '1.0' as version, case when n_regionkey = 0 then '2024-02-03' else '2024-01-05' end source_date from nation")
add("p9_precedence", lambda t: t.customer.select("c_custkey", R.precedence(F.expr("case when c_custkey % 2 = 0 then '  ' else c_mktsegment end"), F.expr("case when c_custkey % 3 = 0 then null else ' from  collection ' end"), F.lit("last")).alias("v")), "select c_custkey, case when c_custkey % 2 <> 0 then c_mktsegment when c_custkey % 3 <> 0 then 'from collection' else 'last' end v from customer")
add("p10_pick_geom_type", lambda t: t.part.select("p_partkey", R.pick_geom_type(F.expr("case when p_size % 5 = 0 then 'Point' end"), F.expr("case when p_size % 4 = 0 then null else 'MultiPolygon' end"), F.expr("case when p_size % 3 = 0 then 'Polygon' when p_size % 3 = 1 then 'LineString' end")).alias("g")), "select p_partkey, case when p_size % 5 = 0 then 'Point' when p_size % 4 <> 0 and p_size % 3 <> 1 then 'MultiPolygon' when p_size % 3 = 0 then 'Polygon' when p_size % 3 = 1 then 'LineString' end g from part")
add("p11_bbox_window", lambda t: R.bbox_window(t.fx_box, -20, -30, 60, 30).select("place_id"), "select place_id from fx_box where xmin <= 60 and xmax >= -20 and ymin <= 30 and ymax >= -30")
_BOX = lambda: B.box(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
_ALASKA = lambda: B.box(F.lit(170.0), F.lit(-40.0), F.lit(-150.0), F.lit(60.0))
add("p12_boxes_meet", lambda t: t.fx_box.where(B.meet(_BOX(), _ALASKA())).select("place_id"), "select place_id from fx_box where ymin <= 60 and -40 <= ymax and ((xmin <= 210 - 360 and 170 - 360 <= xmax) or (xmin <= 210 and 170 <= xmax) or (xmin <= 570 and 530 <= xmax))")
add("p13_is_global", lambda t: t.part.select("p_partkey", B.is_global(B.box(F.lit(-180.0), F.lit(-88.0), F.col("p_size") * 10.0 - 180, F.lit(85.0))).alias("g")), "select p_partkey, p_size * 10 >= 359 g from part")
add("p14_place_lookup", lambda t: R.place_lookup(t.fx_value, "SUP:7"), "select * from fx_value where place_id = 'SUP:7'")
add("p15_search_text", lambda t: t.fx_lookup.where(R.matches_text(F.concat_ws(" ", "species", T.group_of(F.col("eov"), F.col("class")), "class", F.when(F.col("redlist").isNotNull(), F.concat(F.lit("iucn "), "redlist"))), "iucn st")).select("aphiaid"), "select aphiaid from fx_lookup where redlist is not null and contains(lower(species || ' ' || coalesce(eov, class, 'other') || ' ' || class || ' iucn ' || redlist), 'iucn') and contains(lower(species || ' ' || coalesce(eov, class, 'other') || ' ' || class || ' iucn ' || redlist), 'st')")
add("p16_filter_group", lambda t: t.fx_lookup.where("eov = 'Brand#12'").select("aphiaid", "eov"), "select aphiaid, eov from fx_lookup where eov = 'Brand#12'")
add("p18_id_pattern", lambda t: t.fx_name.select("place_id", R.matches_ids(F.col("place_id"), [r"SUP:\d", r"CUS:\d{2,3}"]).alias("ok")), "select place_id, regexp_full_match(place_id, 'SUP:[0-9]|CUS:[0-9]{2,3}') ok from fx_name")
add("p19_over_budget", lambda t: R.over_budget(t.fx_box, 0.5, 500, 900), "select place_id, cast(sum(c) as bigint) cells, cast(max(c) as bigint) largest, sum(c) > 900 or max(c) > 500 as \"over\" from (select place_id, ceil((xmax - xmin) / 5e-1) * ceil((ymax - ymin) / 5e-1) c from fx_box) group by place_id")
_KEY = "case page_id % 9 when 0 then concat('data/v', page_id, '/x.parquet') when 1 then concat('cog/a/', md5(url), '.tif') when 2 then concat('set/c/d/v2/', page_id, '.PMTILES') when 3 then concat('index/', page_id, '.zip') when 4 then concat('closed/', page_id, '.json') when 5 then 'a/b/credits' when 6 then concat('set/_history/v2/v3/', page_id, '.fgb') when 7 then '.json' else concat('x/y/', page_id, '.JSON') end"
_STORE = "case when page_id % 11 = 0 then 'unlisted' else 'public' end"
add("p20_access_class", lambda t: t.pages.select("page_id", T.access_class(F.expr(_KEY), F.expr(_STORE), "index/", ("closed",), ("data",), ("cog",), ("set",)).alias("a")).select("page_id", "a.class", "a.gate", "a.immutable"), f"""
with k as (select page_id, {_KEY} key, {_STORE} store from pages),
e as (select *, lower(key) low, regexp_extract(lower(key), '[^/][.]([^./]*)$', 1) ext from k),
p as (select *, ext in ('json', 'md', 'html', 'png', 'jpg', 'jpeg', 'txt', 'csv', 'svg', 'atom', 'xml') or ends_with(low, '/credits') page from e)
select page_id,
  case when store = 'unlisted' or starts_with(low, 'closed/') then 'unlisted' when ext = 'json' then 'stac' when page then 'other'
       when ext in ('parquet', 'pmtiles') then ext when ext in ('tif', 'tiff') then 'tif' else 'data' end as class,
  case when store = 'unlisted' and starts_with(low, 'index/') then 'open' when store = 'unlisted' or starts_with(low, 'closed/') then 'key'
       when page or starts_with(low, 'index/') then 'open' else 'anonymous' end gate,
  store = 'public' and ext in ('parquet', 'pmtiles', 'tif', 'tiff', 'fgb') and not regexp_matches(key, '(^|/)(_history)?(/|$)')
  and regexp_matches(key, '^data/v[0-9]+/|^cog/(.+/)?[0-9a-f]{{16,64}}(_3857)?[.](tif|tiff|pmtiles)$|^set/[^/]+/(.+/)?v[0-9]+/') immutable
from p""")
add("p21_legacy_fill", lambda t: R.legacy_fill(t.fx_name.withColumn("place_type", F.expr("case when k % 2 = 0 then 'area' end")).withColumn("title", F.expr("case when k % 3 = 0 then null when k % 3 = 1 then collection else 'A Title' end")), t.fx_name.select("collection", F.lit("SUP").alias("prefix"), F.lit("supplier").alias("place_type")).distinct()).select("place_id", "place_type", "title"), "select place_id, case when k % 2 = 0 then 'area' when place_id like 'SUP:%' then 'supplier' end place_type, case when k % 3 = 2 then 'A Title' else upper(collection[1]) || collection[2:] end title from fx_name")
add("p22_type_check_columns", lambda t: R.column_problems(t.fx_lookup, ["species", "EOV", "redlist", "place_id"]), "select 'EOV' as column, 'blank' as problem, count(*) filter (where eov is null) n from fx_lookup union all select 'redlist', 'blank', count(*) filter (where redlist is null) from fx_lookup union all select 'place_id', 'missing', count(*) from fx_lookup")
add("p23_annotate", lambda t: R.annotate(t.nation.select("n_nationkey", "n_name", "n_regionkey"), {"external_id": F.col("n_nationkey").cast("string"), "external_uri": F.concat(F.lit("https://x.test/id/"), F.col("n_nationkey").cast("string")), "product": F.lit("nations"), "version": F.lit("12"), "doi": F.lit("10.1/x"), "modified": F.lit("2024-01-01")}, drop="n_nationkey"), "select cast(n_nationkey as varchar) external_id, 'https://x.test/id/' || n_nationkey external_uri, 'nations' product, '12' as version, '10.1/x' doi, '2024-01-01' modified, n_name, n_regionkey from nation")
add("p24_grid_variables", lambda t: R.grid_variables(t.region.select(F.col("r_name").alias("collection"), F.lower("r_name").alias("title"), F.create_map(F.lit("sst"), F.lit("degC"), F.lit("sst_mask"), F.lit("1"), F.concat(F.lit("chl_"), F.col("r_regionkey").cast("string")), F.lit("mg"), F.lit("obs_count"), F.lit("1")).alias("variables"))), "select r_name collection, lower(r_name) title, v variable, u unit from region, (values ('sst', 'degC'), ('chl_', 'mg')) o(v0, u), lateral (select case when v0 = 'chl_' then 'chl_' || r_regionkey else v0 end v)")
add("p25_pick_col", lambda t: t.part.select("p_partkey", R.pick_col(t.part, ["missing", "P_BRAND", "p_type"]).alias("v"), R.pick_col(t.part, ["nothing"]).alias("w")), "select p_partkey, p_brand v, cast(null as varchar) w from part")

# F ----
add("f1_template", lambda t: t.nation.select("n_nationkey", T.template("  {n_name|slug|prefix:nat-}  of   {n_regionkey|map:r} ", maps={"r": {"0": "AF", "1": "AM"}}).alias("v")), "select n_nationkey, 'nat-' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') || ' of ' || case n_regionkey when 0 then 'AF' when 1 then 'AM' else cast(n_regionkey as varchar) end v from nation")
add("f2_filters", lambda t: t.part.withColumn("e", F.expr("case when p_size % 2 = 0 then '' else p_brand end")).select("p_partkey", T.template("{p_retailprice|round}|").alias("r"), T.template("{e|default:none}").alias("d"), T.template("{p_brand|blank:brand#12}").alias("b"), T.template("{e|else:p_type}").alias("x")), "select p_partkey, cast(cast(round_even(p_retailprice, 0) as bigint) as varchar) || '|' r, case when p_size % 2 = 0 then 'none' else p_brand end d, case when lower(p_brand) = 'brand#12' then '' else p_brand end b, trim(regexp_replace(case when p_size % 2 = 0 then p_type else p_brand end, '\\s+', ' ', 'g')) x from part")
add("f3_lease_number", lambda t: t.supplier.select("s_suppkey", T.lease_number(F.expr("case s_suppkey % 5 when 0 then concat('P00', s_suppkey) when 1 then concat('OCS-G ', s_suppkey, ' Provisional') when 2 then concat('OCS-A-00', s_suppkey) when 3 then 'OCS-FL-2000' end")).alias("v")), "select s_suppkey, case s_suppkey % 5 when 0 then 'OCS-P ' || case when s_suppkey < 1000 then lpad(cast(s_suppkey as varchar), 4, '0') else cast(s_suppkey as varchar) end when 1 then 'OCS-G ' || case when s_suppkey < 1000 then lpad(cast(s_suppkey as varchar), 4, '0') else cast(s_suppkey as varchar) end when 2 then 'OCS-A ' || case when s_suppkey < 1000 then lpad(cast(s_suppkey as varchar), 4, '0') else cast(s_suppkey as varchar) end when 3 then 'OCS-FL-2000' else '' end v from supplier")
add("f4_slug", lambda t: t.part.select("p_partkey", T.slug("p_type").alias("v"), T.slug_part(F.concat(F.lit("Éa "), "p_brand")).alias("w")), "select p_partkey, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') v, trim(regexp_replace('ea ' || lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-') w from part")
add("f5_norm_name", lambda t: t.documents.select("doc_id", F.sha2(T.norm_name("text"), 256).alias("h")), "select doc_id, sha256(trim(regexp_replace(lower(strip_accents(text)), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))) h from documents")
add("f6_is_placeholder", lambda t: t.fx_name.select("place_id", T.is_placeholder(F.expr("case when k % 4 = 0 then 'N/A' when k % 4 = 1 then concat('Unnamed ', name) else name end")).alias("p")), "select place_id, k % 4 < 2 p from fx_name")
add("f7_clean_id", lambda t: t.orders.select("o_orderkey", T.clean_id(F.expr("case o_orderkey % 4 when 0 then concat(o_orderkey, '.00') when 1 then ' None ' when 2 then concat('A', o_orderkey) else 'n/a' end")).alias("v")), "select o_orderkey, case o_orderkey % 4 when 0 then nullif(cast(o_orderkey as varchar), '0') when 2 then 'A' || o_orderkey end v from orders")
add("f8_prefix_id", lambda t: t.part.select("p_partkey", T.prefix_id(F.expr("case when p_partkey % 3 = 0 then concat('MRGID:', p_partkey, ':part') when p_partkey % 3 = 1 then concat('mpa: ', p_brand) else 'none' end"), "mrgid").alias("m"), T.prefix_id(F.expr("case when p_partkey % 3 = 1 then concat('mpa: ', p_brand) else 'none' end"), "mpainv_site_id").alias("n"), T.prefix_id(F.concat(F.lit("MPAINV:AK"), "p_partkey", F.lit(":part")), "mpainv_site_id").alias("o")), "select p_partkey, case when p_partkey % 3 = 0 then cast(p_partkey as varchar) end m, case when p_partkey % 3 = 1 then p_brand end n, 'AK' || p_partkey || ':part' o from part")
_XW = lambda t: t.part.select(F.expr("case when p_partkey % 3 = 0 then concat('MRGID:', p_partkey) when p_partkey % 3 = 1 then concat('MPA:', p_partkey) else concat('X:', p_partkey) end").alias("place_id"), F.expr("case when p_partkey % 5 = 0 then '77.0' when p_partkey % 5 = 1 then '0' end").alias("m"))
add("f9_crosswalk", lambda t: _XW(t).select("place_id", F.coalesce(T.clean_id("m"), T.prefix_id("place_id", "mrgid")).alias("mrgid"), T.prefix_id("place_id", "mpainv_site_id").alias("mpa")).where("coalesce(mrgid, mpa) is not null"), "select * from (select case when p_partkey % 3 = 0 then 'MRGID:' || p_partkey when p_partkey % 3 = 1 then 'MPA:' || p_partkey else 'X:' || p_partkey end place_id, case when p_partkey % 5 = 0 then '77' when p_partkey % 3 = 0 then cast(p_partkey as varchar) end mrgid, case when p_partkey % 3 = 1 then cast(p_partkey as varchar) end mpa from part) where coalesce(mrgid, mpa) is not null")
add("f10_keywords", lambda t: t.part.select("p_partkey", T.keywords([F.split_part("p_type", F.lit(" "), F.lit(1)), F.col("p_brand"), F.col("p_brand")], F.col("p_type")).alias("v")), "select p_partkey, p_brand v from part")
add("f11_place_link", lambda t: t.customer.withColumn("u", F.expr("case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then 'bad path' else 'ok' end")).select("c_custkey", T.place_link("https://x.test/{u}/{c_custkey}", {"u": F.col("u"), "c_custkey": F.col("c_custkey")}).alias("v")), "select c_custkey, case when c_custkey % 3 = 2 then 'https://x.test/ok/' || c_custkey end v from customer")
add("f12_squash", lambda t: t.customer.select("c_custkey", T.squash(F.concat(F.lit("  a \t b "), "c_mktsegment", F.lit("\n"))).alias("v"), T.squash(F.lit("  ")).alias("w")), "select c_custkey, 'a b ' || c_mktsegment v, cast(null as varchar) w from customer")
add("f13_resolve_status", lambda t: t.orders.select("o_orderkey", T.resolved_status("field:s", "unknown", {"s": F.expr("case when o_orderkey % 4 = 0 then ' ' else o_orderpriority end")}).alias("v"), T.status_date("data_last_edit", F.expr("case when o_orderkey % 3 = 0 then null else o_orderdate end")).alias("d")), "select o_orderkey, case when o_orderkey % 4 = 0 then 'unknown' else lower(trim(o_orderpriority)) end v, case when o_orderkey % 3 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end d from orders")
add("f14_upstream_status", lambda t: t.orders.select("o_orderkey", T.upstream_status(F.expr("case when o_orderkey % 4 = 0 then '  ' else concat(' ', o_orderstatus) end")).alias("v")), "select o_orderkey, case when o_orderkey % 4 <> 0 then o_orderstatus end v from orders")
add("f15_dates", lambda t: t.orders.select("o_orderkey", T.valid_partial_date(F.expr("case o_orderkey % 4 when 0 then '2026' when 1 then '2026-7' when 2 then '2026-07' end")).alias("ok"), T.iso_date(F.expr("case when o_orderkey % 2 = 0 then cast(unix_millis(cast(o_orderdate as timestamp)) as string) else 'as given' end")).alias("d")), "select o_orderkey, o_orderkey % 4 in (0, 2) ok, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') else 'as given' end d from orders")
add("f16_history_json", lambda t: t.customer.select("c_custkey", T.history_json(F.when(F.col("c_custkey") % 2 == 0, F.array(F.struct(F.lit("2024").alias("date"), F.col("c_mktsegment").alias("value"), F.lit(None).cast("string").alias("note")))).otherwise(F.array().cast("array<struct<date:string,value:string,note:string>>"))).alias("v")), "select c_custkey, case when c_custkey % 2 = 0 then '[{\"date\":\"2024\",\"value\":\"' || c_mktsegment || '\",\"note\":null}]' end v from customer")
add("f17_months", lambda t: t.lineitem.select("l_orderkey", "l_linenumber", T.month_of(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("m"), T.years_before(F.date_format("l_shipdate", "yyyy-MM"), 8).alias("b"), F.date_format(T.step_date(F.col("l_shipdate"), 1), "yyyy-MM").alias("s")), "select l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') m, lpad(cast(year(l_shipdate) - 8 as varchar), 4, '0') || strftime(l_shipdate, '-%m') b, strftime(l_shipdate + interval 1 month, '%Y-%m') s from lineitem")
add("f18_labels", lambda t: t.orders.select("o_orderkey", T.period_label(F.col("o_orderdate"), F.expr("case o_orderkey % 3 when 0 then 'year' when 1 then 'month' else 'day' end")).alias("p"), T.unit_label(F.expr("case when o_orderkey % 2 = 0 then '1' else 'm**2' end")).alias("u")), "select o_orderkey, case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y') when 1 then strftime(o_orderdate, '%Y-%m') else strftime(o_orderdate, '%Y-%m-%d') end p, case when o_orderkey % 2 = 0 then '' else 'm^2' end u from orders")
add("f19_bbox_wrap", lambda t: t.fx_box.select("place_id", B.wrap_bbox(_BOX()).alias("w"), B.unwrap_bbox(B.wrap_bbox(_BOX())).alias("u")).select("place_id", F.round("w.xmin", 6).alias("wx"), F.round("w.xmax", 6).alias("we"), F.round("u.xmax", 6).alias("ue")), "select place_id, round(xmin, 6) wx, round(case when xmax > 180 then xmax - 360 else xmax end, 6) we, round(xmax, 6) ue from fx_box")
add("f20_bbox_iou", lambda t: t.fx_box.select("place_id", F.round(B.iou(_BOX(), B.box(F.lit(0.0), F.lit(-20.0), F.lit(40.0), F.lit(20.0))), 6).alias("iou")), "select place_id, round(i / ((xmax - xmin) * (ymax - ymin) + 1600 - i), 6) iou from (select *, greatest(0, least(xmax, 40) - greatest(xmin, 0)) * greatest(0, least(ymax, 20) - greatest(ymin, -20)) i from fx_box)")
add("f21_bbox_wkt", lambda t: t.region.select("r_regionkey", B.bbox_wkt(B.box(170.0 + F.col("r_regionkey") * 5, F.lit(-10.5), 178.0 + F.col("r_regionkey") * 5, F.lit(10.0))).alias("wkt")), "select r_regionkey, case when w > e then 'MULTIPOLYGON(((' || w || ' -10.5, 180 -10.5, 180 10, ' || w || ' 10, ' || w || ' -10.5)), ((-180 -10.5, ' || e || ' -10.5, ' || e || ' 10, -180 10, -180 -10.5)))' else 'POLYGON((' || w || ' -10.5, ' || e || ' -10.5, ' || e || ' 10, ' || w || ' 10, ' || w || ' -10.5))' end wkt from (select r_regionkey, case when 170 + 5 * r_regionkey > 180 then 5 * r_regionkey - 190 else 170 + 5 * r_regionkey end w, case when 178 + 5 * r_regionkey > 180 then 5 * r_regionkey - 182 else 178 + 5 * r_regionkey end e from region)")
add("f22_cell_at", lambda t: t.fx_point.select("point_id", B.cell_at(F.floor((90.0 - F.col("lat")) / 0.5), F.floor((F.col("lon") + 180.0) / 0.5), 720, 0.5, 5.0).alias("c")).select("point_id", "c.cell", "c.tile"), "select point_id, cast(r * 720 + c + 1 as bigint) cell, cast(floor(r / 10) * 72 + floor(c / 10) as bigint) tile from (select point_id, floor((90e0 - lat) / 5e-1) r, floor((lon + 180e0) / 5e-1) c from fx_point)")
add("f23_cells", lambda t: t.part.select("p_partkey", F.expr("(shiftleft(cast(7 as bigint), 52) | (p_partkey * 4398046511))").alias("c")).select("p_partkey", B.cell_long(B.cell_hex(F.col("c"))).alias("back"), B.cell_resolution(F.col("c")).alias("res"), B.cell_parent(F.col("c"), 3).alias("up")), "select p_partkey, c back, (c >> 52) & 15 res, (c & ~(cast(15 as bigint) << 52)) | (cast(3 as bigint) << 52) | ((cast(1 as bigint) << 36) - 1) up from (select p_partkey, (cast(7 as bigint) << 52) | (p_partkey * 4398046511) c from part)")
_SPREAD = "list_sum(list_transform(range(0, 16), lambda i: ((cast({0} as bigint) >> i) & 1) << (2 * i)))"
add("f24_morton", lambda t: t.fx_point.select("point_id", B.morton(B.wrap_lon(F.col("lon")), F.col("lat")).alias("z")), f"select point_id, cast({_SPREAD.format('floor((lon + 180e0) / 360e0 * 65536)')} + 2 * {_SPREAD.format('floor((lat + 90e0) / 180e0 * 65536)')} as bigint) z from fx_point")
add("f25_geom_kind", lambda t: t.part.select("p_partkey", T.kind_of_all(F.array(F.expr("case when p_size % 2 = 0 then 'MultiPolygon' else 'Point' end"), F.expr("case when p_size % 3 = 0 then 'Polygon' else 'MultiPoint' end"))).alias("k")), "select p_partkey, case when p_size % 2 = 0 and p_size % 3 = 0 then 'polygon' when p_size % 2 = 1 and p_size % 3 <> 0 then 'point' else 'mixed' end k from part")
add("f26_search_rank", lambda t: t.customer.select("c_custkey", T.search_rank(F.expr("case c_custkey % 4 when 0 then 'own' when 1 then 'protectedseas_mpa' when 2 then 'noaa_hapc' else c_mktsegment end"), "own").alias("r")), "select c_custkey, case c_custkey % 4 when 0 then 2 when 1 then 1 when 2 then 1 else 0 end r from customer")
add("f27_station_key", lambda t: t.part.select("p_partkey", T.station_key(F.col("p_size") / 2, F.col("p_partkey") % 1000 / 2).alias("k")), "select p_partkey, printf('%05.1f', p_size / 2e0) || ' ' || printf('%05.1f', (p_partkey % 1000) / 2e0) k from part where true")
add("f28_camera", lambda t: t.fx_box.select("place_id", B.camera(_BOX()).alias("c")).select("place_id", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"), F.round("c.zoom", 1).alias("zoom")), "select place_id, round((xmin + xmax) / 2, 6) lon, round((ymin + ymax) / 2, 6) lat, round(round(least(greatest(log2(least(720 / (xmax - xmin), 450 / ((ymax - ymin) / cos(radians((ymin + ymax) / 2))))), 0), 14), 2), 1) zoom from fx_box")
add("f29_contributor_ids", lambda t: t.nation.select("n_nationkey", T.dir_to_id(F.concat(F.lit("OM-01-"), "n_name")).alias("id"), T.ulid_valid(F.expr("case when n_nationkey % 2 = 0 then '01ARZ3NDEKTSV4RRFFQ69G5FAV' else '81ARZ3NDEKTSV4RRFFQ69G5FAV' end")).alias("u"), T.orcid_valid(F.expr("case when n_nationkey % 2 = 0 then 'https://orcid.org/0000-0002-1825-0097' else '0000-0002-1825-0098' end")).alias("o")), "select n_nationkey, 'OM:01-' || n_name id, n_nationkey % 2 = 0 u, n_nationkey % 2 = 0 o from nation")
add("f30_size_label", lambda t: t.fx_listing.select("page_id", T.size_label(F.expr("size * 100 + page_id % 10")).alias("v"), T.size_label(F.col("page_id")).alias("w")), "select page_id, case when s >= 1e6 then printf('%.1f MB', round(s / 1e6, 1)) when s >= 1e3 then printf('%.1f kB', round(s / 1e3, 1)) else cast(s as varchar) || ' B' end v, case when page_id >= 1e3 then printf('%.1f kB', round(page_id / 1e3, 1)) else cast(page_id as varchar) || ' B' end w from (select page_id, size * 100 + page_id % 10 s from fx_listing)")
add("f31_citation", lambda t: t.nation.select("n_nationkey", T.citation(F.expr("case when n_nationkey % 3 = 0 then ' Own  text ' end"), F.expr("case when n_nationkey % 3 = 1 then 'By us.' end"), F.col("n_name"), F.lit("1.2"), F.lit(2024)).alias("v")), "select n_nationkey, case n_nationkey % 3 when 0 then 'Own text' when 1 then 'By us. ' || n_name || ', version 1.2 (2024)' else n_name || ', version 1.2 (2024)' end v from nation")
add("f32_hash_of", lambda t: t.nation.select("n_nationkey", T.hash_of(F.expr("case when n_nationkey % 2 = 0 then 'led' end"), F.concat(F.lit("1220"), F.sha2(F.col("n_name"), 256))).alias("h")), "select n_nationkey, case when n_nationkey % 2 = 0 then 'led' else sha256(n_name) end h from nation")
add("f33_csv_cell", lambda t: t.part.select("p_partkey", T.csv_cell(F.expr("case p_size % 3 when 0 then concat('a\"', p_brand) when 1 then concat(p_brand, ',x') end")).alias("v")), "select p_partkey, case p_size % 3 when 0 then '\"a\"\"' || p_brand || '\"' when 1 then '\"' || p_brand || ',x\"' else '' end v from part")
add("f34_group_of", lambda t: t.part.select("p_partkey", T.group_of(F.expr("case p_size % 4 when 0 then 'hardCorals' when 1 then p_brand when 2 then '' end"), F.expr("case when p_size % 8 < 4 then p_type end")).alias("g")), "select p_partkey, case p_size % 4 when 0 then 'hard corals' when 1 then p_brand else case when p_size % 8 < 4 then p_type else 'other' end end g from part")
add("f36_attribution", lambda t: t.nation.select("n_nationkey", T.attribution_text(F.expr("case when n_nationkey % 3 = 0 then ' own ' end"), F.expr("case when n_nationkey % 3 = 1 then array(n_name, 'B') else cast(array() as array<string>) end"), "the library").alias("v")), "select n_nationkey, case n_nationkey % 3 when 0 then 'own' when 1 then n_name || ', B. Processed by the library.' else 'Processed by the library.' end v from nation")

# W-1..W-4 ----
_W1 = "with r as (select *, row_number() over (partition by nk order by bal, s_suppkey) rk from (select s_suppkey, 'N:' || s_nationkey nk, s_acctbal bal, case when s_suppkey % 2 = 0 then 'Right of Way' end lab from supplier)), b as (select *, case when rk > 1 then nk || ':' || case when lab is null then 'part' else 'right-of-way' end else nk end base from r), n as (select *, row_number() over (partition by nk, base, rk > 1 order by rk) again from b)"
_W1_DF = lambda t: t.supplier.select("s_suppkey", F.concat(F.lit("N:"), F.col("s_nationkey").cast("string")).alias("nk"), F.col("s_acctbal").alias("bal"), F.expr("case when s_suppkey % 2 = 0 then 'Right of Way' end").alias("lab"))
add("w1_suffix_duplicates", lambda t: R.suffixed(_W1_DF(t), "nk", F.col("lab"), F.col("bal"), F.col("s_suppkey")).select("s_suppkey", "unique_id"), f"{_W1} select s_suppkey, case when rk = 1 or again = 1 then base else base || '-' || again end unique_id from n")
add("w2_lease_ids", lambda t: R.lease_ids(t.supplier.select("s_suppkey", F.expr("concat('P', s_nationkey)").alias("num"), F.expr("case when s_suppkey % 3 = 0 then 'Easement' when s_suppkey % 3 = 1 then 'Commercial' end").alias("kind")), "num", "kind", "s_suppkey").select("s_suppkey", "unique_id"), "with r as (select *, row_number() over (partition by nk order by case when lab = 'easement' then 1 else 0 end, s_suppkey) rk from (select s_suppkey, 'BOEM:OCS-P ' || lpad(cast(s_nationkey as varchar), 4, '0') nk, case s_suppkey % 3 when 0 then 'easement' when 1 then 'commercial' else 'part' end lab from supplier)), b as (select *, case when rk > 1 then nk || ':' || lab else nk end base from r), n as (select *, row_number() over (partition by nk, base, rk > 1 order by rk) again from b) select s_suppkey, case when rk = 1 or again = 1 then base else base || '-' || again end unique_id from n")
add("w2_template_ids", lambda t: R.template_ids(t.supplier, "{s_nationkey}", "s_suppkey").select("s_suppkey", "unique_id"), "select s_suppkey, case rk when 1 then nk when 2 then nk || ':part' else nk || ':part-' || (rk - 1) end unique_id from (select s_suppkey, cast(s_nationkey as varchar) nk, row_number() over (partition by s_nationkey order by s_suppkey) rk from supplier)")
add("w3_assign_parts", lambda t: R.assign_parts(_W1_DF(t), "nk", F.lit("zone"), F.col("bal"), F.col("s_suppkey")).select("s_suppkey", "part"), "select s_suppkey, case rk when 1 then null when 2 then 'zone' else 'zone-' || (rk - 1) end part from (select s_suppkey, row_number() over (partition by s_nationkey order by s_acctbal, s_suppkey) rk from supplier)")
add("w4_id_collisions", lambda t: R.suffixed(t.fx_name.withColumn("key", T.norm_name("name")), "key", F.col("collection"), F.expr("case when collection = 'suppliers' then 0 else 1 end"), F.col("k")).select("place_id", "unique_id"), "with r as (select *, row_number() over (partition by lower(name) order by case when collection = 'suppliers' then 0 else 1 end, k) rk from fx_name), b as (select *, case when rk > 1 then lower(name) || ':' || collection else lower(name) end base from r), n as (select *, row_number() over (partition by lower(name), base, rk > 1 order by rk) again from b) select place_id, case when rk = 1 or again = 1 then base else base || '-' || again end unique_id from n")
add("w8_page_numbers", lambda t: R.page_numbers(t.fx_listing.withColumn("folder", F.split_part("key", F.lit("/"), F.lit(1))), 5, "page_id").select("page_id", "page"), "select page_id, cast(floor((row_number() over (partition by split_part(key, '/', 1) order by page_id) - 1) / 5) as bigint) page from fx_listing")
add("w8_page", lambda t: R.page(t.fx_listing, "m", 20).select("key"), "select key from fx_listing where key > 'm' order by key limit 20")
add("w9_row_groups", lambda t: R.row_groups(t.fx_name, 4, "place_id", "collection"), "select collection, g row_group, count(*) n_rows, min(place_id) first_key, max(place_id) last_key from (select collection, place_id, cast(floor((row_number() over (partition by collection order by place_id) - 1) / ceil(count(*) over (partition by collection) / 4e0)) as bigint) g from fx_name) group by collection, g")
_VER = lambda t: t.supplier.select(F.col("s_nationkey").alias("slug"), F.expr("concat(s_suppkey % 2, '.', s_suppkey % 3, '.', s_suppkey % 12)").alias("version"))
add("w11_bump_version", lambda t: _VER(t).groupBy("slug").agg(F.max_by("version", F.transform(F.split("version", r"\."), lambda x: x.cast("int"))).alias("current")).withColumn("next", F.concat(F.regexp_extract("current", r"^(.*\.)\d+$", 1), (F.regexp_extract("current", r"(\d+)$", 1).cast("int") + 1).cast("string"))), "select s_nationkey slug, (m // 10000) || '.' || (m // 100 % 100) || '.' || (m % 100) current, (m // 10000) || '.' || (m // 100 % 100) || '.' || (m % 100 + 1) next from (select s_nationkey, max((s_suppkey % 2) * 10000 + (s_suppkey % 3) * 100 + s_suppkey % 12) m from supplier group by s_nationkey)")

# O ----
add("o1_morton_order", lambda t: t.fx_box.withColumn("wide", ((F.col("xmax") - F.col("xmin") > 60) | (F.col("ymax") - F.col("ymin") > 30)).cast("int")).withColumn("code", B.morton((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2)).select("place_id", "wide", F.row_number().over(Window.partitionBy(F.col("k") % 10).orderBy("wide", "code", "k")).alias("place")), f"select place_id, wide, row_number() over (partition by k % 10 order by wide, z, k) place from (select *, {_SPREAD.format('least(65535, floor(((xmin + xmax) / 2 + 180e0) / 360e0 * 65536))')} + 2 * {_SPREAD.format('least(65535, floor(((ymin + ymax) / 2 + 90e0) / 180e0 * 65536))')} z, case when xmax - xmin > 60 or ymax - ymin > 30 then 1 else 0 end wide from fx_box)")
add("o2_id_order", lambda t: t.fx_name.orderBy("place_id").select("place_id", "name"), "select place_id, name from fx_name order by place_id")
_SORT = lambda d: Window.partitionBy("class").orderBy(F.col("eov").asc_nulls_last() if d == "asc" else F.col("eov").desc_nulls_last(), F.desc("aphiaid"), "species")
add("o3_sort_species", lambda t: t.fx_lookup.select("aphiaid", F.row_number().over(_SORT("asc")).alias("up"), F.row_number().over(_SORT("desc")).alias("down")), "select aphiaid, row_number() over (partition by class order by eov asc nulls last, aphiaid desc, species) up, row_number() over (partition by class order by eov desc nulls last, aphiaid desc, species) down from fx_lookup")
add("o4_natural_order", lambda t: t.fx_species.withColumn("turn", F.row_number().over(Window.partitionBy("place_id").orderBy(F.desc("n"), "aphiaid"))).select("place_id", "aphiaid", "turn"), "select place_id, aphiaid, row_number() over (partition by place_id order by n desc, aphiaid) turn from fx_species")
add("o5_top_n", lambda t: R.top_n(t.fx_listing, 50, F.desc("size"), F.col("page_id")).select("page_id", "size").crossJoin(t.fx_listing.agg(F.count("*").alias("total"))), "select page_id, size, (select count(*) from fx_listing) total from fx_listing order by size desc, page_id limit 50")
add("o6_search_limit", lambda t: R.top_n(t.fx_name.where(R.matches_text(F.col("name"), "ati 1")), 12, F.col("collection"), F.col("k")).select("place_id"), "select place_id from fx_name where contains(lower(name), 'ati') and contains(lower(name), '1') order by collection, k limit 12")

# U ----
add("u1_union_sources", lambda t: R.union_sources({"s": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "s_acctbal"), "c": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))}), "select s_suppkey id, s_name as name, s_acctbal, 's' component, null segment from supplier union all select c_custkey, null, null, 'c', c_mktsegment from customer")
add("u2_except_keys", lambda t: R.except_keys(t.customer.select((F.col("c_custkey") * 2).alias("k")), t.orders.select(F.col("o_custkey").alias("k")), "k"), "select c_custkey * 2 k from customer except select o_custkey from orders")
add("u3_intersect_keys", lambda t: R.intersect_keys(t.customer.select(F.col("c_custkey").alias("k")), t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), "k"), "select c_custkey k from customer intersect select o_custkey from orders where o_orderstatus = 'F'")
add("u4_distinct_colls", lambda t: t.part.select("p_partkey", F.array_join(R.distinct_in_order(F.col("p_brand"), F.expr("case when p_size % 2 = 0 then p_brand end"), F.expr("case when p_size % 3 = 0 then 'X' end")), ",").alias("v")), "select p_partkey, p_brand || case when p_size % 3 = 0 then ',X' else '' end v from part")
add("u5_retire", lambda t: R.retire(t.nation.select(F.col("n_name").alias("slug")), t.supplier.select(F.expr("case when s_suppkey % 4 = 0 then concat('no-', s_suppkey) else null end").alias("slug")).where("slug is not null").unionByName(t.nation.where("n_nationkey % 6 = 0").select(F.col("n_name").alias("slug")))), "select n_name slug, case when n_nationkey % 6 = 0 then 'retired' else 'kept' end state from nation union all select 'no-' || s_suppkey, 'unknown' from supplier where s_suppkey % 4 = 0")
add("u6_distinct_providers", lambda t: t.nation.select("n_nationkey", F.array_join(R.distinct_providers(F.expr("array(named_struct('name', n_name, 'roles', array('producer')), named_struct('name', 'host', 'roles', array('host')), named_struct('name', n_name, 'roles', array('licensor')), named_struct('name', 'L', 'roles', array('licensor', 'host')))"), ["producer", "licensor"]), "; ").alias("v")), "select n_nationkey, n_name || '; L' v from nation")
add("s4_event_log", lambda t: t.fx_event.select("k", "seq", F.expr("case when seq % 7 = 0 then substr(d, 1, 4) when seq % 11 = 0 then '2024-1' else d end").alias("date"), "status", F.expr("case when seq % 13 = 0 then '' else source end").alias("source")).withColumn("problem", F.when(~T.valid_partial_date("date"), "date").when(~F.col("source").startswith("http"), "source")).groupBy("problem").agg(F.count("*").alias("n")), "select case when seq % 7 <> 0 and seq % 11 = 0 then 'date' when seq % 13 = 0 then 'source' end problem, count(*) n from fx_event group by 1")
