"""Queries of joins, graphs and species reports (families J, K, and what combines them)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.functions import text as T
from terrane.operators import graph as K
from terrane.operators import joins as J
from terrane.operators import rows as R
from terrane.operators import species as S
from terrane.plans.base import Book

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql

_BOUNDS = lambda t: t.orders.where("o_orderstatus != 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("size"))
_BOUNDS_SQL = "(select o_custkey, sum(o_totalprice) size from orders where o_orderstatus <> 'P' group by o_custkey)"
add("j1_join_boundaries", lambda t: J.join_boundaries(t.customer, _BOUNDS(t), "c_custkey", F.col("size") < 400000).select("c_custkey", F.round("size", 2).alias("size")), f"select c_custkey, round(size, 2) size from customer join {_BOUNDS_SQL} on o_custkey = c_custkey where size >= 400000")
add("j1_boundary_misses", lambda t: J.boundary_misses(t.customer, _BOUNDS(t), "c_custkey", F.col("size") < 400000), f"select count(*) filter (where size >= 400000) matched, count(*) filter (where size is null) missing, count(*) filter (where size < 400000) \"empty\" from customer left join {_BOUNDS_SQL} on o_custkey = c_custkey")
_EVENTS = lambda t: t.fx_event.select(F.col("k").alias("key"), F.col("d").alias("date"), F.col("status").alias("value"), "source", "seq")
add("j2_apply_events", lambda t: J.apply_events(t.customer.withColumnRenamed("c_custkey", "key"), _EVENTS(t), "key", F.lit("designated"), F.lit("https://x.test"), F.lit("")).select("key", "status", "status_source", "status_date", "n_events"), "select c_custkey as key, coalesce(status, 'designated') status, coalesce(source, 'https://x.test') status_source, coalesce(d, '') status_date, coalesce(c, 0) n_events from customer left join (select *, count(*) over (partition by k) c, row_number() over (partition by k order by d desc, seq desc) r from fx_event) e on k = c_custkey and r = 1")
add("j3_unmatched_events", lambda t: J.unmatched_events(_EVENTS(t), t.customer.where("c_custkey % 3 = 0"), "c_custkey"), "select distinct k as key from fx_event where k not in (select c_custkey from customer where c_custkey % 3 = 0)")
add("j4_core_flag", lambda t: J.core_flag(t.customer.select("c_custkey"), t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey"), "select c_custkey, c_custkey in (select o_custkey from orders where o_totalprice > 400000) core from customer")
_MAP = lambda t: t.region.select(F.col("r_regionkey").cast("string").alias("from"), F.col("r_name").alias("to")).where("`from` != '3'")
add("j5_map_values", lambda t: J.map_values(t.nation.select("n_nationkey", F.col("n_regionkey").cast("string").alias("r")), "r", _MAP(t)), "select n_nationkey, coalesce(r_name, cast(n_regionkey as varchar)) r from nation left join region on r_regionkey = n_regionkey and r_regionkey <> 3")
add("j5_unmapped_values", lambda t: J.unmapped_values(t.nation.select(F.col("n_regionkey").cast("string").alias("r")), "r", _MAP(t)), "select '3' as \"from\"")
_MERGED_SQL = """by_id as (select place_id, coalesce(name_key, -aphiaid) as key, aphiaid, cast(sum(n) as bigint) n, max(n) as best_n, min(year_min) lo, max(year_max) hi from fx_species group by 1, 2, 3),
merged as (select place_id, key, cast(sum(n) as bigint) n, min(lo) year_min, max(hi) year_max, arg_min(aphiaid, -best_n * 1000000 + aphiaid) best, string_agg(cast(aphiaid as varchar), ',' order by n desc, aphiaid) ids from by_id group by 1, 2)"""
add("a3_merge_by_name", lambda t: S.merge_by_name(t.fx_species).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ",")), f"with {_MERGED_SQL} select * from merged")
_NAMED_SQL = f"""{_MERGED_SQL},
grp as (select place_id, key, arg_min(eov, -n * 1000000 + b.aphiaid) eov from by_id b join fx_lookup l on l.aphiaid = b.aphiaid where eov is not null group by 1, 2),
named as (select m.*, species as name, class, redlist, eov from merged m left join fx_lookup l on l.aphiaid = m.best left join grp g on g.place_id = m.place_id and g.key = m.key)"""
_NAMED_SQL = _NAMED_SQL.replace("class, redlist, eov from", "class, redlist, g.eov from")
_NAMED = lambda t: S.enrich_species(S.merge_by_name(t.fx_species), t.fx_lookup)
add("j6_enrich_species", lambda t: _NAMED(t).select("place_id", "key", "n", "best", "name", "class", "redlist", "eov"), f"with {_NAMED_SQL} select place_id, key, n, best, name, class, redlist, eov from named")
_LATEST_SQL = "(select code, max(yr) yr, arg_max(val, yr) val from fx_series group by code)"
_LATEST = lambda t: t.fx_series.groupBy("code").agg(F.max_by("val", "yr").alias("val"), F.max("yr").alias("yr"))
add("j7_assign_indicator", lambda t: J.assign_indicator(t.fx_zone, _LATEST(t)).withColumn("val", F.round("val", 2)), f"select zone_id, case when p then coalesce(a.yr, b.yr) end yr, round(case when p then coalesce(a.val, b.val) end, 2) val, case when p and a.yr is not null then 'territory' when p and b.yr is not null then 'sovereign' end basis from (select *, pol_type = '200NM' p from fx_zone) z left join {_LATEST_SQL} a on a.code = z.ter left join {_LATEST_SQL} b on b.code = z.sov")
_SAME_SQL = """ix as (select *, lower(name) nk, collection || '/' || place_id m from fx_index),
pr as (select a.m a, b.m b from ix a join ix b on a.nk = b.nk and a.geom_type = b.geom_type and a.m < b.m where case when a.geom_type = 'Polygon'
  then greatest(0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * greatest(0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin))
    >= 8e-1 * ((a.xmax - a.xmin) * (a.ymax - a.ymin) + (b.xmax - b.xmin) * (b.ymax - b.ymin) - greatest(0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * greatest(0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)))
  else a.xmin = b.xmin and a.ymin = b.ymin end)"""
add("j8_same_name_pairs", lambda t: J.same_name_pairs(t.fx_index).agg(F.count_distinct("b").alias("linked")), f"with {_SAME_SQL} select count(distinct b) linked from pr")
SAME_PLACE_SQL = f"with recursive {_SAME_SQL}, un as (select a, b from pr union select b, a from pr), reach as (select a, b from un union select r.a, u.b from reach r join un u on u.a = r.b) select collection, place_id, case when g is not null then least(g, m) end group_id from ix left join (select a, min(b) g from reach group by a) on a = m"
add("k1_same_place_groups", lambda t: K.same_place_groups(t.fx_index).select("collection", "place_id", "group_id"), SAME_PLACE_SQL)
add("k2_lineage_closure", lambda t: K.lineage_closure(t.fx_taxon).select("id", F.array_join(F.col("lineage").cast("array<string>"), ">").alias("path")), "with recursive up as (select id, parent, cast(id as varchar) path from fx_taxon union all select up.id, t.parent, up.path || '>' || cast(t.id as varchar) from up join fx_taxon t on t.id = up.parent) select id, path from up where parent is null")
add("p17_filter_subtree", lambda t: S.in_subtree(S.merge_by_name(t.fx_species), K.lineage_closure(t.fx_taxon), 5).select("place_id", "key"), "with recursive up as (select id, id anc from fx_taxon union all select up.id, t.parent from up join fx_taxon t on t.id = up.anc where t.parent is not null) select distinct place_id, coalesce(name_key, -aphiaid) as key from fx_species where aphiaid in (select id from up where anc = 5)")
_LAYERS = lambda t: t.nation.select(F.col("n_nationkey").alias("seq"), F.col("n_name").alias("layer"), F.expr("case when n_nationkey % 2 = 0 then 0 else 2 end").alias("source_rank"), F.expr("case when n_nationkey % 5 = 0 then -180D else n_nationkey * 14D - 170 end").alias("xmin"), F.expr("case when n_nationkey % 5 = 0 then -85D else -20D end").alias("ymin"), F.expr("case when n_nationkey % 5 = 0 then 180D else n_nationkey * 14D - 150 end").alias("xmax"), F.expr("case when n_nationkey % 5 = 0 then 88D else 25D end").alias("ymax"))
_LAYERS_SQL = "(select n_nationkey seq, n_name layer, case when n_nationkey % 2 = 0 then 0 else 2 end source_rank, n_nationkey % 5 = 0 g, case when n_nationkey % 5 = 0 then -180e0 else n_nationkey * 14e0 - 170 end lx0, case when n_nationkey % 5 = 0 then -85e0 else -20e0 end ly0, case when n_nationkey % 5 = 0 then 180e0 else n_nationkey * 14e0 - 150 end lx1, case when n_nationkey % 5 = 0 then 88e0 else 25e0 end ly1 from nation)"
add("j12_layers_covering", lambda t: J.layers_covering(t.fx_box, _LAYERS(t)), f"select place_id, layer, g \"global\", row_number() over (partition by place_id order by source_rank, g, seq) place from fx_box join {_LAYERS_SQL} on ymin <= ly1 and ly0 <= ymax and (lx1 - lx0 >= 360 or (xmin <= lx1 and lx0 <= xmax) or (xmin <= lx1 + 360 and lx0 + 360 <= xmax) or (xmin <= lx1 - 360 and lx0 - 360 <= xmax))")
add("a23_cover_counts", lambda t: J.layers_covering(t.fx_box, _LAYERS(t)).groupBy("place_id").agg(F.count("*").alias("n"), F.count_if("global").alias("n_global")), f"select place_id, count(*) n, count(*) filter (where g) n_global from fx_box join {_LAYERS_SQL} on ymin <= ly1 and ly0 <= ymax and (lx1 - lx0 >= 360 or (xmin <= lx1 and lx0 <= xmax) or (xmin <= lx1 + 360 and lx0 + 360 <= xmax) or (xmin <= lx1 - 360 and lx0 - 360 <= xmax)) group by place_id")
_PC = lambda t: t.lineitem.select(F.concat(F.lit("SUP:"), F.col("l_suppkey").cast("string")).alias("place_id"), (F.col("l_orderkey") % 500).alias("cell")).distinct()
_CV = lambda t: t.lineitem.select((F.col("l_orderkey") % 500).alias("cell"), (F.col("l_partkey") % 50).alias("species"), F.expr("l_quantity - 5").alias("suit"), F.expr("l_orderkey * 10 + l_linenumber").alias("seq"))
_CELLS_SQL = """pc as (select distinct 'SUP:' || l_suppkey place_id, l_orderkey % 500 cell from lineitem),
cv as (select l_orderkey % 500 cell, l_partkey % 50 species, arg_min(l_quantity - 5, (l_orderkey * 10 + l_linenumber) * 1000 + l_quantity) suit from lineitem where l_quantity > 5 group by 1, 2)"""
add("j13_cells_to_values", lambda t: _PC(t).join(S.first_values(_CV(t)), "cell").join(t.part.select(F.col("p_partkey").alias("species"), "p_name"), "species", "left").groupBy("place_id", "p_name").agg(F.count("*").alias("n"), F.sum("suit").alias("total")), f"with {_CELLS_SQL} select place_id, p_name, count(*) n, sum(suit) total from pc join cv using (cell) left join part on p_partkey = species group by 1, 2")
add("a6_cell_species", lambda t: S.cell_species(_PC(t), _CV(t)).withColumn("mean_suit", F.round("mean_suit", 6)).withColumn("share", F.round("share", 6)), f"with {_CELLS_SQL}, tot as (select place_id, count(*) total from pc group by 1) select place_id, species, count(*) cells, max(suit) max_suit, round(avg(suit), 6) mean_suit, round(count(*) / any_value(total), 6) share from pc join cv using (cell) join tot using (place_id) group by 1, 2")
_RANKED = lambda t: t.nation.select(F.col("n_name").alias("slug"), F.lit(3).alias("rank"), F.lit("published").alias("origin")).unionByName(t.nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("slug"), F.lit(2).alias("rank"), F.lit("internal").alias("origin"))).unionByName(t.nation.where("n_nationkey % 3 = 0").select(F.col("n_name").alias("slug"), F.lit(1).alias("rank"), F.lit("local").alias("origin")))
add("j14_merge_sources", lambda t: J.merge_sources(_RANKED(t)).select("slug", "origin"), "select n_name slug, case when n_nationkey % 3 = 0 then 'local' when n_nationkey % 2 = 0 then 'internal' else 'published' end origin from nation")
_ROWS = lambda t: t.nation.select(F.col("n_name").alias("slug"), F.sha2("n_name", 256).alias("sha"))
_MAN = lambda t: t.nation.where("n_nationkey % 3 != 0").select(F.col("n_name").alias("slug"), F.when(F.col("n_nationkey") % 2 == 0, F.sha2("n_name", 256)).otherwise("old").alias("sha"), F.col("n_nationkey").alias("cells"))
add("j15_attach_if_current", lambda t: J.attach_if_current(_ROWS(t), _MAN(t)).select("slug", "cells"), "select n_name slug, case when n_nationkey % 3 <> 0 and n_nationkey % 2 = 0 then n_nationkey end cells from nation")
add("j16_missing_or_stale", lambda t: J.missing_or_stale(_ROWS(t), _MAN(t)).select("slug"), "select n_name slug from nation where not (n_nationkey % 3 <> 0 and n_nationkey % 2 = 0)")
_PROBE = lambda t, new: t.supplier.where("s_suppkey % 13 != 0" if new else "s_suppkey % 11 != 0").select(F.col("s_nationkey").cast("string").alias("slug"), F.col("s_suppkey").alias("source_no"), F.expr(f"case when s_suppkey % 3 = 0 then {'s_suppkey % 2' if new else '0'} end").alias("last_edit"), F.expr(f"s_suppkey + {'(case when s_suppkey % 9 = 0 then 1 else 0 end)' if new else '0'}").alias("n"), F.expr(f"case when s_suppkey % 3 = 1 then {'s_suppkey % 5' if new else '1'} end").alias("checksum"), F.expr(f"{'s_suppkey % 7' if new else '2'}").alias("etag"))
add("j17_detect_changes", lambda t: J.detect_changes(_PROBE(t, False), _PROBE(t, True)), "with r as (select cast(s_nationkey as varchar) slug, s_suppkey source_no, case when s_suppkey % 11 = 0 and s_suppkey % 13 = 0 then null when s_suppkey % 11 = 0 then 'new source' when s_suppkey % 13 = 0 then 'source gone' when s_suppkey % 3 = 0 then case when s_suppkey % 2 <> 0 then 'last edit' when s_suppkey % 9 = 0 then 'count' end when s_suppkey % 3 = 1 then case when s_suppkey % 5 <> 1 then 'checksum' end when s_suppkey % 7 <> 2 then 'validators' end reason from supplier) select slug, min(source_no) source_no, arg_min(reason, source_no) reason from r where reason is not null group by slug")
add("j18_ledger_changes", lambda t: J.ledger_changes(t.part.where("p_partkey % 10 != 0").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("hash")), t.part.select(F.col("p_partkey").alias("key"), F.expr("case when p_partkey % 7 = 0 then p_type else p_brand end").alias("hash"))), "select p_partkey as key, case when p_partkey % 7 = 0 then p_type else p_brand end hash, case when p_partkey % 10 <> 0 then p_brand end was from part where p_partkey % 7 = 0 or p_partkey % 10 = 0")
add("j19_then_vs_now", lambda t: J.then_vs_now(t.fx_value.groupBy("place_id", "indicator", "t").agg(F.round(F.sum("v"), 2).alias("v")), ["place_id", "indicator"], 2), "with m as (select place_id, indicator, t, round(sum(v), 2) v from fx_value group by 1, 2, 3) select n.place_id, n.indicator, n.t, n.v as now, o.v as then from m n join m o on o.place_id = n.place_id and o.indicator = n.indicator and n.t = o.t + interval 24 month")
add("j20_name_collisions", lambda t: R.same_names(t.fx_name.where("collection = 'customers'").withColumn("place_type", F.expr("case when k % 2 = 0 then 'a' else 'b' end")), t.fx_name.where("collection = 'suppliers'").withColumn("place_type", F.lit("a"))).select("place_id"), "select place_id from fx_name c where collection = 'customers' and k % 2 = 0 and exists (select 1 from fx_name s where s.collection = 'suppliers' and lower(s.name) = lower(c.name))")
add("j22_display_via", lambda t: J.display_via(t.fx_value.select("place_id", "indicator", "t").withColumnRenamed("place_id", "parent"), t.fx_name.where("collection = 'suppliers'"), "parent").groupBy("parent", "drawn_by").agg(F.count("*").alias("n")), "select v.place_id parent, name drawn_by, count(*) n from fx_value v join fx_name p on p.place_id = v.place_id and p.collection = 'suppliers' group by 1, 2")
add("j23_layer_for_place", lambda t: J.layer_for_place(t.fx_name.select("place_id", F.expr("case when k % 5 = 0 then name else 'none' end").alias("collection"), F.expr("case when k % 3 = 0 then '9' else cast(k % 5 as string) end").alias("authority"), F.expr("concat('t', k % 2)").alias("place_type")), t.nation.select(F.col("n_nationkey").alias("seq"), F.col("n_name").alias("layer"), F.col("n_name").alias("collection"), F.col("n_regionkey").cast("string").alias("authority"), F.expr("concat('t', n_nationkey % 2)").alias("place_type"))), "with p as (select place_id, case when k % 5 = 0 then name else 'none' end c, case when k % 3 = 0 then '9' else cast(k % 5 as varchar) end a, 't' || (k % 2) ty from fx_name), l as (select n_nationkey seq, n_name layer, cast(n_regionkey as varchar) a, 't' || (n_nationkey % 2) ty from nation), r as (select place_id, layer, row_number() over (partition by place_id order by case when l.layer = c then 0 when l.a = p.a and l.ty = p.ty then 1 when l.a = p.a then 2 else 3 end, seq) rn from p cross join l) select place_id, layer from r where rn = 1")
add("j24_values_index", lambda t: J.values_index(t.fx_value.select("place_id", "indicator", "coll", F.expr("unix_date(t)").alias("seq")), t.lineitem.where("l_returnflag != 'N'").select(F.col("l_returnflag").alias("indicator"), F.concat(F.lit("f/"), "l_returnflag").alias("file")).distinct()), "select place_id, indicator, coll, 'f/' || indicator file, cast(min(t - date '1970-01-01') as integer) seq from fx_value where indicator <> 'N' group by 1, 2, 3")
add("j25_set_membership", lambda t: J.set_membership(t.fx_name.select("place_id", F.array("collection", "name").alias("colls")), t.region.select(F.col("r_name").alias("set_id"), F.expr("array('suppliers', 'x')").alias("groups")).where("set_id like 'A%'").unionByName(t.nation.where("n_nationkey < 6").select(F.col("n_name").alias("set_id"), F.array(F.lower("n_name")).alias("groups")))), "select place_id, r_name set_id from fx_name join region on r_name like 'A%' where collection = 'suppliers' union select place_id, n_name from fx_name join nation on n_nationkey < 6 and fx_name.name = lower(n_name)")
add("j26_search_sites", lambda t: J.search_sites(t.fx_index.withColumn("group_id", F.expr("case when k % 3 = 0 then concat('g', k % 20) end")), R.matches_text(F.col("name"), "a")).select("g", "place_id", F.array_join("also", ",").alias("also")), "with f as (select *, case when k % 3 = 0 then 'g' || (k % 20) else collection || '/' || place_id end g from fx_index where contains(lower(name), 'a')), r as (select *, row_number() over (partition by g order by collection, place_id) rn from f) select g, min(place_id) filter (where rn = 1) place_id, coalesce(string_agg(place_id, ',' order by rn) filter (where rn > 1), '') also from r group by g")

# reports over species ----
_DEC = lambda t: S.decade_rows(t.lineitem.join(t.fx_lookup, F.expr("l_partkey = aphiaid")).select(F.concat(F.lit("SUP:"), F.col("l_suppkey").cast("string")).alias("place_id"), F.coalesce("eov", F.lit("none")).alias("eov"), F.expr("year(l_shipdate) - 20 + l_linenumber * 4").alias("year"), F.col("l_quantity").cast("bigint").alias("n"), F.col("l_partkey").alias("species")))
_DEC_SQL = "base as (select 'SUP:' || l_suppkey place_id, coalesce(eov, 'none') eov, cast(floor((year(l_shipdate) - 20 + l_linenumber * 4) / 10e0) * 10 as bigint) as decade, cast(l_quantity as bigint) n, l_partkey species from lineitem join fx_lookup on aphiaid = l_partkey), dec as (select place_id, eov, decade, cast(sum(n) as bigint) n, count(distinct species) sp from base group by 1, 2, 3 union all select place_id, eov, null, sum(n), count(distinct species) from base group by 1, 2 union all select place_id, 'all', decade, sum(n), count(distinct species) from base group by 1, 3 union all select place_id, 'all', null, sum(n), count(distinct species) from base group by 1)"
add("a2_decade_rows", _DEC, f"with {_DEC_SQL} select * from dec")
add("a2_decade_summary", lambda t: S.decade_summary(_DEC(t)), f"with {_DEC_SQL} select place_id, max(n) filter (where eov = 'all' and decade is null) n, max(sp) filter (where eov = 'all' and decade is null) sp, count(*) filter (where eov = 'all' and decade is not null and n > 0) n_decades, max(decade) filter (where eov = 'all' and n > 0) latest, arg_max(sp, decade) filter (where eov = 'all' and decade is not null and n > 0) latest_sp, string_agg(eov, ',' order by sp desc, eov) filter (where eov <> 'all' and decade is null and sp > 0) groups from dec group by place_id")
add("a4_species_counts", lambda t: S.species_counts(S.merge_by_name(t.fx_species), t.fx_species.groupBy("place_id").agg((F.max("year_max") - 1).alias("latest"))), f"with {_MERGED_SQL}, l as (select place_id, max(year_max) - 1 latest from fx_species group by 1) select place_id, count(*) all_names, count(*) filter (where year_max >= latest) latest_names from merged join l using (place_id) group by 1")
add("a5_group_chips", lambda t: S.group_chips(_NAMED(t), "fish", ["Brand#22", "Brand#11"]), f"with {_NAMED_SQL}, c as (select place_id, eov, count(*) n from named where eov is not null group by 1, 2 union all select distinct place_id, 'fish', 0 from named union all select place_id, 'all', count(*) from named group by 1) select place_id, eov, n, row_number() over (partition by place_id order by case when eov = 'all' then 0 else 1 end, n desc, case eov when 'Brand#22' then 1 when 'Brand#11' then 2 else 3 end, eov) place from c")
add("a26_place_species_sql", lambda t: t.spark.sql("select s.name_key, any_value(l.class) is not null known, sum(s.n) records, min(s.year_min) year_min, max(s.year_max) year_max from {s} s left join {l} l using (aphiaid) where s.place_id = 'SUP:5' and array_contains(l.lineage, 5L) group by s.name_key", s=t.fx_species, l=t.fx_lookup.join(K.lineage_closure(t.fx_taxon).withColumnRenamed("id", "aphiaid"), "aphiaid")), "with recursive up as (select id, id anc from fx_taxon union all select up.id, t.parent from up join fx_taxon t on t.id = up.anc where t.parent is not null) select name_key, true known, cast(sum(n) as bigint) records, min(year_min) year_min, max(year_max) year_max from fx_species where place_id = 'SUP:5' and aphiaid in (select id from up where anc = 5) group by name_key")
add("b7_place_species_report", lambda t: _NAMED(t).groupBy("place_id").agg(F.count("*").alias("names"), F.sum("n").alias("records"), F.count_if(F.col("redlist").isNotNull()).alias("listed"), F.max("year_max").alias("last")).join(S.decade_summary(_DEC(t)).select("place_id", "latest", "latest_sp"), "place_id", "left").withColumn("line", S.summary_line(F.col("records"), F.col("names"), F.col("latest"), F.col("latest_sp"))), f"with {_NAMED_SQL}, {_DEC_SQL}, a as (select place_id, count(*) as names, cast(sum(n) as bigint) records, count(redlist) listed, max(year_max) as last from named group by 1), d as (select place_id, max(decade) latest, arg_max(sp, decade) latest_sp from dec where eov = 'all' and decade is not null and n > 0 group by 1) select *, format('{{:,}}', records) || ' records of ' || format('{{:,}}', names) || ' species in every year; in the ' || latest || 's, ' || format('{{:,}}', latest_sp) || ' species.' line from a left join d using (place_id)")
add("f35_summary_text", lambda t: t.part.select("p_partkey", S.summary_line(F.expr("p_partkey * 1000"), F.col("p_partkey"), F.expr("case when p_size % 2 = 0 then 2020 end"), F.col("p_size")).alias("line")), "select p_partkey, format('{:,}', p_partkey * 1000) || ' records of ' || format('{:,}', p_partkey) || ' species in every year' || case when p_size % 2 = 0 then '; in the 2020s, ' || p_size || ' species' else '' end || '.' line from part")
_C = F.expr
add("f35_records_line", lambda t: t.part.select("p_partkey", T.records_line(_C("case when p_size % 7 > 0 then p_partkey * 1000 end"), F.col("p_partkey"), _C("case when p_size > 5 then p_size + 0.5D end"), _C("case when p_size % 2 = 0 then 2020 end"), F.col("p_partkey"), F.col("p_size"), _C("cast(null as double)")).alias("line")), "select p_partkey, case when p_size % 7 > 0 then format('{:,}', p_partkey * 1000) || ' records of ' || format('{:,}', p_partkey) || ' species (' || case when p_size > 5 then 'ES(50) ' || p_size || '.5' else 'ES(50) not defined (under 50 records)' end || ') in every year' else 'No records in every year' end || case when p_size % 2 = 0 then '; in the 2020s, ' || format('{:,}', p_partkey) || ' records of ' || p_size || ' species (ES(50) not defined (under 50 records))' else '' end || '.' line from part")
add("f35_species_line", lambda t: t.part.select("p_partkey", T.species_line(_C("p_partkey * 1000"), _C("case when p_size % 2 = 0 then 2020 end"), F.col("p_partkey")).alias("line")), "select p_partkey, format('{:,}', p_partkey * 1000) || ' species with records in the place (exact)' || case when p_size % 2 = 0 then ', ' || format('{:,}', p_partkey) || ' in the latest decade (the 2020s)' else '' end || '.' line from part")
add("f35_suited_line", lambda t: t.part.groupBy("p_brand", F.col("p_size").alias("label")).agg(F.count("*").alias("n")).where("n > 1").groupBy("p_brand").agg(F.collect_list(F.struct(F.concat(F.lit("g"), F.lpad(F.col("label").cast("string"), 2, "0")).alias("label"), "n")).alias("groups")).select("p_brand", T.suited_line(F.col("groups"), F.lit(1234), F.lit(0.05)).alias("line")), "select p_brand, format('{:,}', cast(sum(n) as bigint)) || ' species (' || string_agg('g' || lpad(cast(p_size as varchar), 2, '0') || ' ' || n, ', ' order by n desc, p_size) || ') suitable in at least one of the place''s 1,234 cells of 0.05°.' line from (select p_brand, p_size, count(*) n from part group by 1, 2 having count(*) > 1) group by 1")
add("f35_indicators_line", lambda t: t.part.select("p_partkey", T.indicators_line(F.col("p_size"), F.lit(2), F.lit(3), _C("p_size % 3"), _C("p_size % 4"), _C("p_size % 5"), _C("case when p_size % 2 = 0 then '2025-07' end")).alias("line")), "select p_partkey, case when p_size % 5 > p_size % 4 then (p_size % 5 - p_size % 4) || case when p_size % 5 - p_size % 4 = 1 then ' indicator' else ' indicators' end || ' with a value: ' || p_size || ' above, 2 within, 3 below the place''s own record' || case when p_size % 3 > 0 then ', ' || (p_size % 3) || ' without a status' else '' end || case when p_size % 2 = 0 then '; latest 2025-07' else '' end || '.' end line from part")
