"""Queries of spatial joins and cell coverage (J-9..J-11, J-21, A-22, B-5, B-8, G-16, G-17, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.operators import cells as C
from terrane.operators import geometry as G
from terrane.operators import overlap as O
from terrane.operators import species as S
from terrane.plans.base import Book

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql

_BOX_A = lambda t: t.fx_box.where("k % 2 = 0").withColumnRenamed("place_id", "id")
_BOX_B = lambda t: t.fx_box.where("k % 2 = 1").withColumnRenamed("place_id", "id")
add("j9_bbox_join", lambda t: O.box_join(_BOX_A(t), _BOX_B(t)), "select a.place_id a_id, b.place_id b_id from fx_box a join fx_box b on a.k % 2 = 0 and b.k % 2 = 1 and a.xmin <= b.xmax and b.xmin <= a.xmax and a.ymin <= b.ymax and b.ymin <= a.ymax")
_ODD = lambda t, k: t.fx_edge.where(F.expr(f"cast(substr(place_id, 5) as int) % 2 = {k}"))
_PAIR_SQL = """ea as (select *, least(xa, xb) lo, greatest(xa, xb) hi, case when xb < xa then 1 else -1 end s, cast(place_id[5:] as integer) k from fx_edge where xa <> xb),
st as (select a.place_id a_id, b.place_id b_id, a.s * b.s s, greatest(a.lo, b.lo) x0, least(a.hi, b.hi) x1, a.xa axa, a.ya aya, a.xb axb, a.yb ayb, b.xa bxa, b.ya bya, b.xb bxb, b.yb byb
  from ea a join ea b on {on} and a.lo < b.hi and b.lo < a.hi),
yy as (select a_id, b_id, s, x1 - x0 len, 100 + aya + (ayb - aya) * (x0 - axa) / (axb - axa) a0, 100 + aya + (ayb - aya) * (x1 - axa) / (axb - axa) a1,
  100 + bya + (byb - bya) * (x0 - bxa) / (bxb - bxa) b0, 100 + bya + (byb - bya) * (x1 - bxa) / (bxb - bxa) b1 from st where x1 > x0),
ov as (select a_id, b_id, sum(s * case when a0 <= b0 and a1 <= b1 then (a0 + a1) / 2 * len when a0 >= b0 and a1 >= b1 then (b0 + b1) / 2 * len
  else ((a0 + a1 + b0 + b1) / 2 * len - len * (pow(a0 - b0, 2) + pow(a1 - b1, 2)) / (2 * abs((a0 - b0) - (a1 - b1)))) / 2 end) area from yy group by 1, 2)"""
_EVEN_ODD = _PAIR_SQL.format(on="a.k % 2 = 0 and b.k % 2 = 1")
add("j10_polygon_overlap", lambda t: O.polygon_overlap(_ODD(t, 0), _ODD(t, 1), tolerance=1e-6).withColumn("area", F.round("area", 5)), f"with {_EVEN_ODD} select a_id, b_id, round(area, 5) area from ov where area > 1e-6")
add("j21_carry", lambda t: O.polygon_overlap(_ODD(t, 0), _ODD(t, 1), tolerance=1e-6, left=t.fx_place.select("place_id", "k"), right=t.fx_place.select("place_id", "r")).drop("area"), f"with {_EVEN_ODD} select a_id, b_id, a.k a_k, b.r b_r from ov join fx_place a on a.place_id = a_id join fx_place b on b.place_id = b_id where area > 1e-6")
add("b5_derive_intersect", lambda t: O.derive_intersect(_ODD(t, 0), _ODD(t, 1), 5.0, 0.5).where("area is not null or lost > 1e-6").select("a_id", "b_id", F.round("area", 5).alias("area"), "reason"), f"with {_EVEN_ODD} select a_id, b_id, round(case when area >= 5e-1 then area end, 5) area, case when area < 5e-1 then 'fragments' when area < 5 then 'sliver' end reason from ov where area > 1e-6")
add("a22_derived_report", lambda t: O.derived_report(O.derive_intersect(_ODD(t, 0), _ODD(t, 1), 5.0, 0.5).where("area is not null or lost > 1e-6")).withColumn("area", F.round("area", 4)), f"with {_EVEN_ODD} select case when area < 5e-1 then 'fragments' when area < 5 then 'sliver' else 'kept' end reason, count(*) n, round(sum(area), 4) area from ov where area > 1e-6 group by 1")
_SPLIT = lambda t: G.edges(G.split_antimeridian(t.fx_vertex))
_PIP_SQL = """pp as (select p.point_id, b.place_id, v, x, lat from fx_box b, (select point_id, v, lat, lon + sh x from fx_point, (values (0), (360)) o(sh)) p where x between xmin and xmax and lat between ymin and ymax),
pip as (select point_id, e.place_id, any_value(v) v from pp join fx_edge e on e.place_id = pp.place_id and (ya > lat) <> (yb > lat) and x < (xb - xa) * (lat - ya) / (yb - ya) + xa group by 1, 2 having count(*) % 2 = 1)"""
add("j11_points_in_polygons", lambda t: O.points_in_polygons(t.fx_point, _SPLIT(t)), f"with {_PIP_SQL} select point_id, place_id from pip")
add("j11_point_summary", lambda t: O.points_in_polygons(t.fx_point, _SPLIT(t), carry=("v",)).groupBy("place_id").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total")), f"with {_PIP_SQL} select place_id, count(*) n, round(sum(v), 2) total from pip group by 1")


_RES = 7
_CELLS_TEMPLATE = f"""ce as (select place_id, xa, ya, xb, yb from fx_edge where not (xa - 180) * (xb - 180) < 0 union all select place_id, xa, ya, 180e0, ya + (yb - ya) * (180 - xa) / (xb - xa) from fx_edge where (xa - 180) * (xb - 180) < 0 union all select place_id, 180e0, ya + (yb - ya) * (180 - xa) / (xb - xa), xb, yb from fx_edge where (xa - 180) * (xb - 180) < 0),
lv as (select cast(l as integer) res, 360e0 / pow(2, l + 1) w, 2e0 / pow(2, l) h, cast(pow(2, l + 1) as bigint) n from range(0, {_RES + 1}) r(l)),
pe as (select place_id, xa, xb, sin(radians(ya)) ya, sin(radians(yb)) yb from ce),
pc as (select place_id, res, w, h, n, unnest(range(cast(floor((min(xa) + 180) / w) as bigint), cast(floor((max(xa) + 180) / w) as bigint) + 1)) ix, floor((min(ya) + 1) / h) y0, floor((max(ya) + 1) / h) y1 from pe, lv group by place_id, res, w, h, n),
cc as (select place_id, res, w, h, n, ix, unnest(range(cast(y0 as bigint), cast(y1 as bigint) + 1)) iy from pc),
cs as (select c.place_id, res, w, h, n, ix, iy, greatest(least(xa, xb), ix * w - 180) x0, least(greatest(xa, xb), ix * w - 180 + w) x1, xa, ya, xb, yb, iy * h - 1 s0, case when xb < xa then 1 else -1 end s from cc c join pe on pe.place_id = c.place_id and xa <> xb and greatest(xa, xb) > ix * w - 180 and least(xa, xb) < ix * w - 180 + w),
cy as (select place_id, res, w, h, n, ix, iy, s, x1 - x0 len, s0, ya + (yb - ya) * (x0 - xa) / (xb - xa) y0, ya + (yb - ya) * (x1 - xa) / (xb - xa) y1 from cs where x1 > x0),
sh as (select place_id, res, any_value(w * h) as size, ix % n ix, iy, sum(s * (m1 - m0)) / any_value(w * h) share from (select *, {{low1}} m1, {{low0}} m0 from cy) group by place_id, res, ix % n, iy)"""


def _low(level: str) -> str:
    f, g = "(y0 + y1 + 2) / 2 * len", f"({level} + 1) * len"
    return f"case when y0 <= {level} and y1 <= {level} then {f} when y0 >= {level} and y1 >= {level} then {g} else ({f} + {g} - len * (pow(y0 - ({level}), 2) + pow(y1 - ({level}), 2)) / (2 * abs(y0 - y1))) / 2 end"


_CELLS_SQL = _CELLS_TEMPLATE.format(low1=_low("s0 + h"), low0=_low("s0"))
_SIZE_SQL = "sz as (select place_id, sum((xa - xb) * (sin(radians(ya)) + sin(radians(yb)))) / 2 place_size from ce group by 1)"
_KEPT_SQL = f"{_CELLS_SQL}, {_SIZE_SQL}, kept as (select sh.place_id, res, ix, iy, least(share, 1) share from sh join sz using (place_id) where share > 1e-9 and (share >= 1e-2 or share * size >= 1e-2 * place_size))"
_MEMBERS = lambda t, res=_RES: C.grid_membership(_SPLIT(t), res)
_RECT = lambda t: t.fx_place.select(F.explode(F.sequence(F.lit(0), F.lit(35))).alias("i")).distinct().select("i", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j")).select(F.concat_ws("|", F.col("i").cast("string"), F.col("j").cast("string")).alias("place_id"), F.lit(1).alias("part"), F.lit(0).alias("ring"), (F.col("i") * 10.0 - 180).alias("x0"), (F.col("j") * 20.0 - 60).alias("y0")).select("place_id", "part", "ring", F.posexplode(F.expr("array(struct(x0 as x, y0 as y), struct(x0 + 10 as x, y0 as y), struct(x0 + 10 as x, y0 + 20 as y), struct(x0 as x, y0 + 20 as y), struct(x0 as x, y0 as y))")).alias("seq", "p")).select("place_id", "part", "ring", "seq", "p.x", "p.y")
add("m1_cell_shares", lambda t: C.cell_shares(_SPLIT(t), G.edges(_RECT(t))).where("share > 1e-6").groupBy("place_id").agg(F.count("*").alias("n"), F.round(F.max("share"), 5).alias("largest")), f"""with {_CELLS_SQL.split('lv as')[0]}pe as (select place_id, xa, xb, sin(radians(ya)) ya, sin(radians(yb)) yb from ce),
rc as (select i, j, i * 10e0 - 180 wx, sin(radians(j * 20 - 60)) s0, sin(radians(j * 20 - 40)) s1 from range(0, 39) a(i), range(0, 6) b(j)),
rs as (select place_id, i % 36 i, j, s0, s1, greatest(least(xa, xb), wx) x0, least(greatest(xa, xb), wx + 10) x1, xa, ya, xb, yb, case when xb < xa then 1 else -1 end s from rc join pe on xa <> xb and greatest(xa, xb) > wx and least(xa, xb) < wx + 10),
ry as (select place_id, i, j, s, s0, s1, x1 - x0 len, ya + (yb - ya) * (x0 - xa) / (xb - xa) y0, ya + (yb - ya) * (x1 - xa) / (xb - xa) y1 from rs where x1 > x0),
rh as (select place_id, i, j, sum(s * (m1 - m0)) / any_value(10 * (s1 - s0)) share from (select *, {_low('s1')} m1, {_low('s0')} m0 from ry) group by 1, 2, 3)
select place_id, count(*) n, round(max(least(share, 1)), 5) largest from rh where share > 1e-6 group by 1""")
add("m2_grid_membership", lambda t: _MEMBERS(t).select("place_id", "res", "ix", "iy", F.round("share", 6).alias("share")), f"with {_KEPT_SQL} select place_id, res, ix, iy, round(share, 6) share from kept")
add("m3_keep_rule", lambda t: C.grid_membership(_SPLIT(t), _RES, 0.0, 0.0).join(G.edges(t.fx_vertex).groupBy("place_id").agg((F.sum((F.col("xa") - F.col("xb")) * (F.sin(F.radians("ya")) + F.sin(F.radians("yb")))) / 2).alias("size")), "place_id").groupBy("place_id", "res").agg(F.count_if(C.keep_rule(F.col("share"), 720 / F.pow(F.lit(2.0), 2 * F.col("res") + 1), F.col("size"))).alias("kept"), F.count("*").alias("n")), f"with {_CELLS_SQL}, {_SIZE_SQL} select place_id, res, count(*) filter (where share >= 1e-2 or share * size >= 1e-2 * place_size) kept, count(*) n from sh join sz using (place_id) where share > 1e-9 group by 1, 2")
add("m4_membership_parent", lambda t: _MEMBERS(t).where("res >= 2").select("place_id", "res", "ix", "iy", C.membership_parent(F.col("res"), F.col("ix"), F.col("iy"), 2).alias("parent")), f"with {_KEPT_SQL} select place_id, res, ix, iy, (cast(res - 2 as bigint) << 56) | (cast(ix // 4 as bigint) << 28) | cast(iy // 4 as bigint) parent from kept where res >= 2")
_BLOCK = lambda: (F.floor(F.col("ix") / 4).alias("px"), F.floor(F.col("iy") / 4).alias("py"))
add("m5_membership_manifest", lambda t: _MEMBERS(t).groupBy("res", *_BLOCK()).agg(F.count("*").alias("rows"), F.count_distinct("place_id").alias("sites")), f"with {_KEPT_SQL} select res, ix // 4 px, iy // 4 py, count(*) as rows, count(distinct place_id) sites from kept group by 1, 2, 3")
add("m6_place_parents", lambda t: _MEMBERS(t).select("place_id", "res", *_BLOCK()).distinct(), f"with {_KEPT_SQL} select distinct place_id, res, ix // 4 px, iy // 4 py from kept")
_AT = lambda per_turn, v: F.floor(v * F.pow(F.lit(2.0), F.col("res")) / per_turn)
_VALUES = lambda t: t.fx_point.withColumn("res", F.explode(F.sequence(F.lit(0), F.lit(_RES)))).select("res", _AT(180.0, F.col("lon") + 180).alias("ix"), _AT(2.0, F.sin(F.radians("lat")) + 1).alias("iy"), "v").groupBy("res", "ix", "iy").agg(F.avg("v").alias("v"))
add("m7_summarise_by_place", lambda t: C.summarise_by_place(_MEMBERS(t), _VALUES(t)).select("place_id", "res", F.round("mean", 4).alias("mean"), F.round("total", 3).alias("total"), "cells"), f"with {_KEPT_SQL}, vv as (select res, floor((lon + 180) * pow(2, res) / 180) ix, floor((sin(radians(lat)) + 1) * pow(2, res) / 2) iy, avg(v) v from fx_point, lv group by 1, 2, 3) select place_id, kept.res, round(sum(share * v) / sum(share), 4) mean, round(sum(share * v), 3) total, count(*) cells from kept join vv on vv.res = kept.res and vv.ix = kept.ix and vv.iy = kept.iy group by 1, 2")
add("m8_share_audit", lambda t: C.share_audit(C.grid_membership(_SPLIT(t), _RES, 0.0, 0.0), _SPLIT(t)).select("place_id", "res", (F.abs("loss") < 1e-6).alias("ok"), F.round("size", 4).alias("size")), f"with {_CELLS_SQL}, {_SIZE_SQL} select place_id, res, true ok, round(place_size, 4) size from sz, lv")
_PC = lambda t: C.place_cells(t.fx_edge, -180.0, 90.0, 0.5, 720, 360, 5.0)
_PC_SQL = """bx as (select place_id, min(xa) x0, max(xa) x1, min(ya) y0, max(ya) y1 from fx_edge group by 1),
rc as (select place_id, r, unnest(range(cast(floor((x0 + 180) / 5e-1 + 1e-9) as bigint), cast(floor((x1 + 180) / 5e-1 + 1e-9) as bigint) + 1)) c from (select *, unnest(range(cast(floor((90 - y1) / 5e-1 + 1e-9) as bigint), cast(floor((90 - y0) / 5e-1 + 1e-9) as bigint) + 1)) r from bx)),
ic as (select rc.place_id, r, c from rc join fx_edge e on e.place_id = rc.place_id and (ya > 90 - (r + 5e-1) * 5e-1) <> (yb > 90 - (r + 5e-1) * 5e-1) and -180 + (c + 5e-1) * 5e-1 < (xb - xa) * (90 - (r + 5e-1) * 5e-1 - ya) / (yb - ya) + xa group by 1, 2, 3 having count(*) % 2 = 1),
pcs as (select distinct place_id, r * 720 + c % 720 + 1 cell, (r // 10) * 72 + (c % 720) // 10 tile from ic)"""
add("g16_place_cells", lambda t: _PC(t), f"with {_PC_SQL} select place_id, cell, tile, true listed from pcs")
_FEW = 300
add("g16_refused", lambda t: C.place_cells(t.fx_edge, -180.0, 90.0, 0.5, 720, 360, 5.0, most=_FEW), f"with {_PC_SQL}, big as (select place_id from bx where (floor((90 - y0) / 5e-1 + 1e-9) - floor((90 - y1) / 5e-1 + 1e-9) + 1) * (floor((x1 + 180) / 5e-1 + 1e-9) - floor((x0 + 180) / 5e-1 + 1e-9) + 1) > 4 * {_FEW}), few as (select place_id from pcs where place_id not in (from big) group by 1 having count(*) <= {_FEW}) select place_id, cell, tile, true listed from pcs where place_id in (from few) union all select place_id, null, null, false from bx where place_id not in (from few)")
add("g16_place_runs", lambda t: C.place_runs(t.fx_edge, -180.0, 90.0, 0.5, 720, 360)[0].groupBy("place_id", "r").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("cells"), F.min("c0").alias("first"), F.max("c1").alias("last")), f"with {_PC_SQL} select place_id, (cell - 1) // 720 r, count(*) cells, min((cell - 1) % 720) as first, max((cell - 1) % 720) as last from pcs group by 1, 2")
add("g17_tiles_of", lambda t: C.tiles_of(_PC(t)), f"with {_PC_SQL} select place_id, tile, count(*) n, min(cell) as first, max(cell) as last from pcs group by 1, 2")
add("b8_suitability_report", lambda t: S.cell_species(_PC(t).select("place_id", "cell"), t.fx_point.select(F.expr("cast(floor((90 - lat) / 0.5) * 720 + floor((lon + 180) / 0.5) + 1 as bigint)").alias("cell"), (F.col("point_id") % 20).alias("species"), F.col("v").alias("suit"), F.col("point_id").alias("seq"))).select("place_id", "species", "cells", F.round("max_suit", 2).alias("max_suit"), F.round("share", 6).alias("share")), f"with {_PC_SQL}, vv as (select cast(floor((90 - lat) / 5e-1) * 720 + floor((lon + 180) / 5e-1) + 1 as bigint) cell, point_id % 20 species, arg_min(v, point_id) suit from fx_point where v > 0 group by 1, 2), n as (select place_id, count(*) n from pcs group by 1) select p.place_id, species, count(*) cells, round(max(suit), 2) max_suit, round(count(*) / any_value(n), 6) share from pcs p join vv on vv.cell = p.cell join n on n.place_id = p.place_id group by 1, 2")
