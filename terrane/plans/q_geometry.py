"""Queries of relational geometry (families G and W-5, W-6, W-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.operators import geometry as G
from terrane.operators import mixed as X
from terrane.plans.base import Book

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql
_R6 = lambda df, *cs: df.withColumns({c: F.round(c, 6) for c in cs})
_JSON = lambda t: G.to_geojson(t.fx_vertex)
_WRAPPED = lambda t: t.fx_vertex.withColumn("x", F.when(F.col("x") > 180, F.col("x") - 360).otherwise(F.col("x")))

add("g1_explode_vertices", lambda t: _R6(G.explode_vertices(_JSON(t)), "x", "y").select("place_id", "part", "ring", "seq", "x", "y"), "select place_id, part, ring, seq, round(x, 6) x, round(y, 6) y from fx_vertex")
add("s2_geojson_round_trip", lambda t: G.bounds(G.explode_vertices(_JSON(t))).select("place_id", F.round("xmin", 6).alias("xmin"), F.round("ymax", 6).alias("ymax")), "select place_id, round(min(x), 6) xmin, round(max(y), 6) ymax from fx_vertex group by 1")
add("g3_bounds", lambda t: _R6(G.bounds(t.fx_vertex), "xmin", "ymin", "xmax", "ymax"), "select place_id, round(min(x), 6) xmin, round(min(y), 6) ymin, round(max(x), 6) xmax, round(max(y), 6) ymax from fx_vertex group by 1")
add("w6_edges", lambda t: _R6(G.edges(t.fx_vertex), "xa", "ya", "xb", "yb"), "select place_id, part, ring, seq, round(xa, 6) xa, round(ya, 6) ya, round(xb, 6) xb, round(yb, 6) yb from fx_edge")
_TURNED = lambda t: t.fx_vertex.withColumn("seq", F.expr("case when cast(substr(place_id, 5) as int) % 3 = 0 then 7 - seq else seq end"))
add("g4_orient", lambda t: _R6(G.orient(_TURNED(t)), "x", "y").select("place_id", "seq", "x", "y", "flipped"), "select place_id, seq, round(x, 6) x, round(y, 6) y, cast(place_id[5:] as integer) % 3 = 0 flipped from fx_vertex")
add("w5_unwrap_ring", lambda t: _R6(G.unwrap_ring(_WRAPPED(t)), "x", "y").select("place_id", "seq", "x", "y", "closed"), "select place_id, seq, round(x - case when max(case when seq = 1 then x end) over (partition by place_id) > 180 then 360 else 0 end, 6) x, round(y, 6) y, true closed from fx_vertex")
_HOLED = lambda t: t.fx_vertex.unionByName(t.fx_vertex.select("place_id", "part", F.lit(1).alias("ring"), (7 - F.col("seq")).alias("seq"), (F.col("x") - 360).alias("x"), F.col("y")))
add("w10_align_holes", lambda t: _R6(G.align_holes(_HOLED(t)), "x", "y").select("place_id", "ring", "seq", "x", "y"), "select place_id, 0 ring, seq, round(x, 6) x, round(y, 6) y from fx_vertex union all select place_id, 1, 7 - seq, round(x, 6), round(y, 6) from fx_vertex")
add("g5_split_antimeridian", lambda t: _R6(G.area_plane(G.edges(G.split_antimeridian(t.fx_vertex))), "area").join(_R6(G.bounds(G.split_antimeridian(t.fx_vertex)), "xmin", "xmax").select("place_id", "xmin", "xmax"), "place_id"), "select place_id, round(3 * r * r, 6) area, round(case when cx + r > 180 then -180 else cx - r end, 6) xmin, round(case when cx + r > 180 then 180 else cx + r end, 6) xmax from fx_place")
add("g6_snap", lambda t: _R6(G.snap(t.fx_vertex.withColumn("x", F.expr("case when seq % 2 = 0 then 179.99995D else -179.9998D end")).withColumn("y", F.expr("case when seq % 3 = 0 then 90.00005D else y end"))), "x", "y").select("place_id", "seq", "x", "y"), "select place_id, seq, case when seq % 2 = 0 then 180e0 else -1799998e-4 end x, round(case when seq % 3 = 0 then 90 else y end, 6) y from fx_vertex")
add("g7_area_plane", lambda t: _R6(G.area_plane(t.fx_edge), "area"), "select place_id, round(3 * r * r, 6) area from fx_place")
_Q = "(1 - 0.00669437999014) * (sin(radians({0})) / (1 - 0.00669437999014 * pow(sin(radians({0})), 2)) - ln((1 - sqrt(0.00669437999014) * sin(radians({0}))) / (1 + sqrt(0.00669437999014) * sin(radians({0})))) / (2 * sqrt(0.00669437999014)))"
add("g7_area_km2", lambda t: G.area_km2(t.fx_edge).withColumn("area_km2", F.round("area_km2", 1)), f"select place_id, round(sum((xa - xb) * ({_Q.format('ya')} + {_Q.format('yb')})) / 2 * radians(1) * 6378.137 * 6378.137 / 2, 1) area_km2 from fx_edge group by 1")
add("g8_centroid", lambda t: _R6(G.centroid(t.fx_edge), "lon", "lat"), "select place_id, round(sum((xa + xb) * (xa * yb - xb * ya)) / (3 * sum(xa * yb - xb * ya)), 6) lon, round(sum((ya + yb) * (xa * yb - xb * ya)) / (3 * sum(xa * yb - xb * ya)), 6) lat from fx_edge group by 1")
add("g8_line_centroid", lambda t: _R6(G.line_centroid(t.fx_edge), "lon", "lat"), "select place_id, round(sum((xa + xb) / 2 * n) / sum(n), 6) lon, round(sum((ya + yb) / 2 * n) / sum(n), 6) lat from (select *, sqrt(pow(xb - xa, 2) + pow(yb - ya, 2)) n from fx_edge) group by 1")
_HAV = "2 * 6371.0088 * asin(sqrt(pow(sin(radians(yb - ya) / 2), 2) + cos(radians(ya)) * cos(radians(yb)) * pow(sin(radians(xb - xa) / 2), 2)))"
add("g9_length_km", lambda t: G.length_km(t.fx_edge), f"select place_id, round(sum({_HAV}), 1) length_km from fx_edge group by 1")
add("g10_max_edge_span", lambda t: _R6(G.max_edge_span(G.edges(_WRAPPED(t))), "span"), "select place_id, round(max(abs(xb - xa)), 6) span from (select place_id, case when xa > 180 then xa - 360 else xa end xa, case when xb > 180 then xb - 360 else xb end xb from fx_edge) group by 1")
add("g11_densify", lambda t: G.densify(t.fx_edge, 0.7).groupBy("place_id").agg(F.count("*").alias("n"), F.round(F.sum("x"), 4).alias("sx")), "with n as (select *, greatest(1, cast(ceil(sqrt(pow(xb - xa, 2) + pow(yb - ya, 2)) / 7e-1) as integer)) n from fx_edge), p as (select place_id, xa + (xb - xa) * i / n x from n, lateral (select unnest(range(0, n)) i) union all select place_id, xb from fx_edge where seq = 5) select place_id, count(*) n, round(sum(x), 4) sx from p group by 1")
_PARTS_SQL = """mp as (select place_id, part, min(kind) kind, count(x) n, min(x) x0, max(x) x1, min(y) y0, max(y) y1 from fx_mixed group by 1, 2),
mq as (select *, case kind when 'polygon' then 1 when 'line' then 2 else 3 end r, min(case when n > 0 then case kind when 'polygon' then 1 when 'line' then 2 else 3 end end) over (partition by place_id) b, count(*) over (partition by place_id) parts from mp),
mr as (select place_id, part, kind, case when n = 0 then 'no coordinates' {rules} end problem from mq),
mg as (select place_id, part, problem from mr where problem is not null union all select place_id, null, 'empty' from mr group by 1 having count(*) = count(problem))"""
_MIXED_SQL = _PARTS_SQL.format(rules="when r > b then 'lower kind' when kind = 'line' and x0 = x1 and y0 = y1 then 'zero length'")
_POINT_SQL = _PARTS_SQL.format(rules="when kind <> 'point' then 'other kind' when parts > 1 then 'several parts' when x0 < -180 or x1 > 180 or y0 < -90 or y1 > 90 then 'range'")
add("g14_routed", lambda t: X.routed(t.fx_mixed)[0].groupBy("place_id", "part", "kind").agg(F.count("*").alias("n")), f"with {_MIXED_SQL} select m.place_id, m.part, m.kind, count(*) n from fx_mixed m join mr on mr.place_id = m.place_id and mr.part = m.part and problem is null group by 1, 2, 3")
add("g14_routed_problems", lambda t: X.routed(t.fx_mixed)[1], f"with {_MIXED_SQL} select * from mg")
add("g14_single_points", lambda t: X.routed(t.fx_mixed.where("part in (3, 11)"), "one point")[1], f"with {_POINT_SQL.replace('from fx_mixed', 'from fx_mixed where part in (3, 11)')} select * from mg")
add("g8_mixed_centroid", lambda t: _R6(X.centroids(X.routed(t.fx_mixed)[0]), "lon", "lat"), f"""with {_MIXED_SQL}, ke as (select m.place_id, m.kind, x xa, y ya, lead(x) over w xb, lead(y) over w yb from fx_mixed m join mr on mr.place_id = m.place_id and mr.part = m.part and problem is null window w as (partition by m.place_id, m.part, ring order by seq)),
ks as (select place_id, min(kind) kind, sum(xa * yb - xb * ya) a, sum((xa + xb) * (xa * yb - xb * ya)) ax, sum((ya + yb) * (xa * yb - xb * ya)) ay, sum(sqrt(pow(xb - xa, 2) + pow(yb - ya, 2))) l, sum((xa + xb) / 2 * sqrt(pow(xb - xa, 2) + pow(yb - ya, 2))) lx, sum((ya + yb) / 2 * sqrt(pow(xb - xa, 2) + pow(yb - ya, 2))) ly, avg(xa) px, avg(ya) py from ke group by 1)
select place_id, cast(case kind when 'polygon' then 2 when 'line' then 1 else 0 end as integer) dimension, round(case kind when 'polygon' then ax / (3 * a) when 'line' then lx / l else px end, 6) lon, round(case kind when 'polygon' then ay / (3 * a) when 'line' then ly / l else py end, 6) lat from ks""")
add("g14_clean_kind", lambda t: G.clean_kind(t.part.select((F.col("p_partkey") % 200).alias("place_id"), F.col("p_partkey").alias("part"), F.expr("case p_size % 3 when 0 then 'polygon' when 1 then 'line' else 'point' end").alias("kind"), F.expr("cast(p_size * 4 as double)").alias("x0"), F.lit(0.0).alias("y0"), F.expr("cast(case when p_size % 4 = 1 then p_size * 4 else p_size * 4 + 1 end as double)").alias("x1"), F.lit(0.0).alias("y1"))).groupBy("problem").agg(F.count("*").alias("n")), "select case when x1 > 180 then 'range' when k = 2 and x0 = x1 then 'zero length' when k > b then 'lower kind' end problem, count(*) n from (select *, min(k) over (partition by place) b from (select p_partkey % 200 place, p_size % 3 + 1 k, p_size * 4 x0, case when p_size % 4 = 1 then p_size * 4 else p_size * 4 + 1 end x1 from part)) group by 1")
add("g15_validity_audit", lambda t: G.validity_audit(t.fx_vertex.where("not (seq = 6 and cast(substr(place_id, 5) as int) % 7 = 0)").join(t.fx_place.select("place_id", "cx", "r"), "place_id").withColumn("x", F.expr("case when cast(substr(place_id, 5) as int) % 5 = 1 and seq = 4 then cx + 2 * r else x end"))).select("place_id", "open", "short", "crossing", "jumps"), "select place_id, case when k % 7 = 0 then 1 else 0 end \"open\", 0 short, case when k % 5 = 1 then 1 else 0 end crossing, 0 jumps from fx_place")
add("g18_make_line", lambda t: G.length_km(G.edges(G.make_line(t.fx_point.withColumn("line", F.col("point_id") % 500), "line", "point_id"))), f"select place_id, round(sum({_HAV}), 1) length_km from (select cast(point_id % 500 as varchar) place_id, lon xa, lat ya, lead(lon) over (partition by point_id % 500 order by point_id) xb, lead(lat) over (partition by point_id % 500 order by point_id) yb from fx_point) where xb is not null group by 1")
add("g19_dissolve", lambda t: _R6(G.area_plane(G.edges(G.dissolve(t.fx_vertex.withColumn("g", F.expr("cast(substr(place_id, 5) as int) % 20")), "g"))), "area"), "select cast(k % 20 as varchar) place_id, round(sum(3 * r * r), 6) area from fx_place group by 1")
_RINGS = lambda t: t.fx_place.select("place_id", F.explode(F.expr("array(struct(1 as ring, 1D as f, -1 as d), struct(2 as ring, 0.5D as f, 1 as d), struct(3 as ring, 0.7D as f, -1 as d))")).alias("q"), "cx", "cy", "r").select("place_id", "q.ring", F.explode(F.expr("array(struct(1 as s, -1 as dx, -1 as dy), struct(2 as s, 1 as dx, -1 as dy), struct(3 as s, 1 as dx, 1 as dy), struct(4 as s, -1 as dx, 1 as dy), struct(5 as s, -1 as dx, -1 as dy))")).alias("o"), F.col("q.d").alias("d"), (F.col("q.f") * F.col("r")).alias("h"), "cx", "cy").select("place_id", "ring", F.when(F.col("d") > 0, F.col("o.s")).otherwise(6 - F.col("o.s")).alias("seq"), (F.col("cx") + F.col("o.dx") * F.col("h")).alias("x"), (F.col("cy") + F.col("o.dy") * F.col("h")).alias("y"))
add("g2_assign_holes", lambda t: G.assign_holes(_RINGS(t)), "select place_id, ring, shell from fx_place, (values (1, 1), (2, 3), (3, 3)) v(ring, shell)")
