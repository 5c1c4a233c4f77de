"""Views over the driver's tables that give place-shaped inputs, as SQL that Spark and DuckDB both run.

The driver's tables have no geometry, so each family of operators gets a deterministic view: suppliers become polygons,
orders become points, events become status logs. ``frame`` builds a view in Spark; ``oracle`` puts the same SQL in front of an
oracle query as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FX = {
    "fx_place": """
select concat('SUP:', cast(s_suppkey as varchar(20))) place_id, s_suppkey k,
       case when s_suppkey % 10 = 0 then 1795e-1 else ((s_suppkey*7919) % 34000)/1e2 - 170e0 end cx,
       ((s_suppkey*104729) % 12000)/1e2 - 60e0 cy, 3e0 + (s_suppkey % 5) * 2e0 r from {supplier}""",
    "fx_vertex": """
select place_id, 1 part, 0 ring, seq, cast(cx+dx*r as double) x, cast(cy+dy*r as double) y from {fx_place}
  cross join (values (1,-1,-1),(2,1,-1),(3,1,1),(4,0,0),(5,-1,1),(6,-1,-1)) o(seq,dx,dy)""",
    "fx_mixed": """
select v.place_id, v.part, ring, seq, x, y, 'polygon' kind from {fx_vertex} v join {fx_place} p on p.place_id = v.place_id where k % 4 = 0
union all
select v.place_id, 2, 0, seq, case when k % 8 = 1 then cx else x + 2e1 end, case when k % 8 = 1 then cy else y end, 'line' from {fx_vertex} v join {fx_place} p on p.place_id = v.place_id where k % 4 < 2
union all
select v.place_id, 10 + seq, 0, 1, case when k % 32 = 2 then x + 4e2 else x end, y, 'point' from {fx_vertex} v join {fx_place} p on p.place_id = v.place_id where k % 4 < 3
union all
select place_id, 3, 0, 1, cast(null as double), cast(null as double), 'point' from {fx_place} where k % 5 = 3""",
    "fx_edge": """
select * from (select place_id, part, ring, seq, x xa, y ya,
  lead(x) over (partition by place_id,part,ring order by seq) xb, lead(y) over (partition by place_id,part,ring order by seq) yb
  from {fx_vertex}) e where xb is not null""",
    "fx_box": """
select place_id, k, cx - r xmin, cy - r ymin, cx + r xmax, cy + r ymax from {fx_place}""",
    "fx_point": """
select o_orderkey point_id, cast(((o_orderkey*7919) % 36000)/1e2 - 17999e-2 + 3e-3 as double) lon,
       cast(((o_orderkey*104729) % 16000)/1e2 - 80e0 + 7e-3 as double) lat, o_totalprice v from {orders}""",
    "fx_event": """
select user_id k, cast(cast(ts as date) as varchar(10)) d, event_type status,
       concat('https://x.test/', cast(event_id as varchar(20))) source, event_id seq from {events}""",
    "fx_species": """
select concat('SUP:', cast(l_suppkey as varchar(20))) place_id, l_partkey aphiaid,
       case when l_partkey % 97 = 0 then null else l_partkey % 500 + 1 end name_key, cast(sum(l_quantity) as bigint) n,
       min(year(l_shipdate)) year_min, max(year(l_shipdate)) year_max from {lineitem} group by l_suppkey, l_partkey""",
    "fx_lookup": """
select p_partkey aphiaid, p_name species, p_type class, case when p_size % 3 = 0 then null else p_brand end eov,
       case when p_size % 4 = 0 then 'EN' else null end redlist from {part}""",
    "fx_taxon": """
select p_partkey id, case when p_partkey < 2 then null else cast(floor(p_partkey / 2) as bigint) end parent from {part}""",
    "fx_series": """
select c_nationkey code, year(o_orderdate) yr, sum(o_totalprice) val from {orders} join {customer} on o_custkey = c_custkey
 group by c_nationkey, year(o_orderdate)""",
    "fx_zone": """
select c_custkey zone_id, case when c_custkey % 7 = 0 then 'Joint regime' else '200NM' end pol_type,
       case when c_custkey % 3 = 0 then 900 + c_nationkey else c_nationkey end ter, c_nationkey sov from {customer}""",
    "fx_name": """
select concat('SUP:', cast(s_suppkey as varchar(20))) place_id, 'suppliers' collection, upper(n_name) name, s_suppkey k
  from {supplier} join {nation} on s_nationkey = n_nationkey
union all
select concat('CUS:', cast(c_custkey as varchar(20))), 'customers', lower(n_name), c_custkey
  from {customer} join {nation} on c_nationkey = n_nationkey""",
    "fx_index": """
select place_id, collection, name, case when k % 11 = 0 then 'Point' else 'Polygon' end geom_type, k,
       cast(k % 40 as double) xmin, cast(k % 7 as double) ymin,
       case when k % 11 = 0 then cast(k % 40 as double) else k % 40 + 2e0 + (k % 2) * 1e-2 end xmax,
       case when k % 11 = 0 then cast(k % 7 as double) else k % 7 + 3e0 end ymax from {fx_name}""",
    "fx_metric": """
select user_id api_key, event_type cls, ts, cast(floor(value*1000) as bigint) bytes,
       case when event_type = 'error' then 404 else 200 end status from {events}""",
    "fx_listing": """
select replace(replace(url, 'https://', ''), 'http://', '') key, cast(length(html) as bigint) size, page_id from {pages}""",
    "fx_value": """
select concat('SUP:', cast(l_suppkey as varchar(20))) place_id, 'suppliers' coll, l_returnflag indicator, 'month' time_grain,
       cast(date_trunc('month', l_shipdate) as date) t, l_linestatus class, round(sum(l_extendedprice), 2) v, count(*) n
  from {lineitem} group by l_suppkey, l_returnflag, date_trunc('month', l_shipdate), l_linestatus""",
    "fx_coverage": """
select place_id, coll, indicator, max(t) last_time, min(t) first_time, count(*) n_periods,
       case when count(*) % 5 = 0 then 'nodata' when sum(n) % 4 = 0 then 'above' when sum(n) % 4 = 1 then 'within' when sum(n) % 4 = 2 then 'below' else 'none' end status
  from {fx_value} group by place_id, coll, indicator""",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a view built from them."""
    if name not in FX:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs = sorted(set(re.findall(r"\{(\w+)\}", FX[name])))
    return spark.sql(FX[name], **{n: frame(spark, sf_dir, n) for n in needs})


def _views(name: str, found: list[str]) -> None:
    for need in re.findall(r"\{(\w+)\}", FX[name]):
        if need in FX:
            _views(need, found)
    if name not in found:
        found.append(name)


def oracle(sql: str) -> str:
    """DuckDB SQL with the views that it names in front."""
    found: list[str] = []
    for name in re.findall(r"\bfx_\w+", sql):
        if name in FX:
            _views(name, found)
    sql = sql.strip()
    if not found:
        return sql
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    head = ",\n".join(f"{n} as ({plain(FX[n])})" for n in found)
    if re.match(r"with\s+recursive\b", sql, re.I):
        return f"with recursive {head},\n{re.sub(r'^with\s+recursive', '', sql, flags=re.I)}"
    return f"with {head},\n{sql[4:]}" if re.match(r"with\b", sql, re.I) else f"with {head}\n{sql}"
