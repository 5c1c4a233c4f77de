"""Geometry as relations: vertices (place_id, part, ring, seq, x, y) and edges (..., xa, ya, xb, yb).

Ring 0 is a part's shell, counter-clockwise; others are holes, clockwise; the first vertex is repeated at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RING = ("place_id", "part", "ring")
#: WGS84.
A_KM = 6378.137
E2 = 0.00669437999014


def _by_ring():
    return Window.partitionBy(*RING).orderBy("seq")


# vertices and edges ----
def explode_vertices(df: DataFrame) -> DataFrame:
    """Vertices of GeoJSON text (place_id, geometry): Polygon and MultiPolygon; other types give none."""
    kind = F.get_json_object("geometry", "$.type")
    raw = F.get_json_object("geometry", "$.coordinates")
    parts = F.when(kind == "MultiPolygon", F.from_json(raw, "array<array<array<array<double>>>>")).when(kind == "Polygon", F.array(F.from_json(raw, "array<array<array<double>>>")))
    p = df.select("place_id", F.posexplode(parts).alias("part", "rings"))
    r = p.select("place_id", (F.col("part") + 1).alias("part"), F.posexplode("rings").alias("ring", "points"))
    return r.select(*RING, F.posexplode("points").alias("seq", "p")).select(*RING, (F.col("seq") + 1).alias("seq"), F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y"))


def to_geojson(v: DataFrame) -> DataFrame:
    """(place_id, geometry): MultiPolygon text from vertices; one group is one place's vertices."""
    num = lambda c: F.regexp_replace(F.format_string("%.9f", c), r"\.?0+$", "")
    point = F.concat(F.lit("["), num(F.col("x")), F.lit(","), num(F.col("y")), F.lit("]"))
    ring = v.groupBy(*RING).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", point.alias("p")))), lambda s: s["p"]), ",").alias("t"))
    part = ring.groupBy("place_id", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ring", "t"))), lambda s: F.concat(F.lit("["), s["t"], F.lit("]"))), ",").alias("t"))
    place = part.groupBy("place_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "t"))), lambda s: F.concat(F.lit("["), s["t"], F.lit("]"))), ",").alias("t"))
    return place.select("place_id", F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), "t", F.lit("]}")).alias("geometry"))


def edges(v: DataFrame) -> DataFrame:
    lead = lambda c: F.lead(c).over(_by_ring())
    return v.select(*RING, "seq", F.col("x").alias("xa"), F.col("y").alias("ya"), lead("x").alias("xb"), lead("y").alias("yb")).where("xb is not null")


def bounds(v: DataFrame, *keys: str) -> DataFrame:
    return v.groupBy(*(keys or ("place_id",))).agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))


def steps(e: DataFrame, axis: str, *keys: str) -> DataFrame:
    """(keys, step): the mean extent of a group's edges along x or y, at least 1/65536 of the group's own.

    Bands of that size hold about two rows for each edge on average and never over three, however many edges a group has.
    """
    lo, hi = F.least(f"{axis}a", f"{axis}b"), F.greatest(f"{axis}a", f"{axis}b")
    return e.groupBy(*keys).agg(F.greatest(F.avg(hi - lo), (F.max(hi) - F.min(lo)) / 65536, F.lit(1e-9)).alias("step"))


def deal(e: DataFrame, axis: str, sized: DataFrame, *keys: str) -> DataFrame:
    """Edges once for each band that they touch; ``sized`` is from ``steps`` of the same keys."""
    lo, hi = F.least(f"{axis}a", f"{axis}b"), F.greatest(f"{axis}a", f"{axis}b")
    return e.join(sized, list(keys)).withColumn("band", F.explode(F.sequence(F.floor(lo / F.col("step")), F.floor(hi / F.col("step")))))


def ring_areas(e: DataFrame) -> DataFrame:
    """Signed planar area of each ring, positive counter-clockwise."""
    return e.groupBy(*RING).agg((F.sum((F.col("xa") - F.col("xb")) * (F.col("ya") + F.col("yb"))) / 2).alias("area"))


def orient(v: DataFrame) -> DataFrame:
    """Shells counter-clockwise, holes clockwise; ``flipped`` says which rings were turned."""
    a = ring_areas(edges(v)).select(*RING, "area")
    n = v.groupBy(*RING).agg(F.max("seq").alias("n"))
    turned = ((F.col("ring") == 0) & (F.col("area") < 0)) | ((F.col("ring") > 0) & (F.col("area") > 0))
    d = v.join(a, list(RING)).join(n, list(RING))
    return d.select(*RING, F.when(turned, F.col("n") + 1 - F.col("seq")).otherwise(F.col("seq")).alias("seq"), "x", "y", turned.alias("flipped"))


def snap(v: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Longitudes near 180 degrees moved onto it, latitudes just past a pole moved onto that."""
    x = F.when(F.abs(F.col("x") - 180) <= tolerance, 180.0).when(F.abs(F.col("x") + 180) <= tolerance, -180.0).otherwise(F.col("x"))
    y = F.when((F.col("y") > 90) & (F.col("y") <= 90 + tolerance), 90.0).when((F.col("y") < -90) & (F.col("y") >= -90 - tolerance), -90.0).otherwise(F.col("y"))
    return v.withColumn("x", x).withColumn("y", y)


# the antimeridian ----
def unwrap_ring(v: DataFrame, pole: float = 89.999) -> DataFrame:
    """Longitudes made continuous: a step over 180 degrees turns by 360, edges at a pole are exempt. ``closed`` is false for a ring that does not come back."""
    before = lambda c: F.lag(c).over(_by_ring())
    step = F.col("x") - before("x")
    exempt = (F.abs("y") >= pole) & (F.abs(before("y")) >= pole)
    turn = F.when(exempt | step.isNull(), 0).when(step > 180, -360).when(step < -180, 360).otherwise(0)
    d = v.withColumn("turn", turn).withColumn("x", F.col("x") + F.sum("turn").over(_by_ring().rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*RING)
    return d.withColumn("closed", F.abs(F.min_by("x", "seq").over(whole) - F.max_by("x", "seq").over(whole)) < 1e-9).drop("turn")


def align_holes(v: DataFrame) -> DataFrame:
    """Holes moved by whole turns to lie by their shell; halves round to even."""
    rings = bounds(v, *RING).select(*RING, ((F.col("xmin") + F.col("xmax")) / 2).alias("mid"))
    shells = rings.where("ring = 0").select("place_id", "part", F.col("mid").alias("shell"))
    shift = rings.join(shells, ["place_id", "part"]).select(*RING, (360 * F.rint((F.col("shell") - F.col("mid")) / 360)).alias("shift"))
    return v.join(shift, list(RING)).withColumn("x", F.col("x") + F.col("shift")).drop("shift")


def split_antimeridian(v: DataFrame) -> DataFrame:
    """Rings (already unwrapped) cut at every odd multiple of 180 degrees and moved back to -180..180.

    Each strip keeps the ring's points clamped into it, with the crossing points of each edge, so a cut ring runs
    along the meridian where it leaves the strip. Areas, bounds and even-odd tests of the pieces are those of the
    polygon; a piece of a concave ring may hold bridges along the meridian. ``part`` becomes part * 8 + strip + 4.
    """
    lead = lambda c: F.lead(c).over(_by_ring())
    span = bounds(v, "place_id", "part").select("place_id", "part", F.floor((F.col("xmin") + 180) / 360).alias("lo"), F.greatest(F.floor((F.col("xmin") + 180) / 360), F.ceil((F.col("xmax") + 180) / 360) - 1).alias("hi"))
    d = v.select(*RING, "seq", "x", "y", lead("x").alias("xb"), lead("y").alias("yb")).join(span, ["place_id", "part"])
    d = d.withColumn("k", F.explode(F.sequence("lo", "hi"))).withColumn("w", F.col("k") * 360.0 - 180)
    clamp = lambda x: F.least(F.greatest(x, F.col("w")), F.col("w") + 360)
    at = lambda m: F.struct(((m - F.col("x")) / (F.col("xb") - F.col("x"))).alias("t"), m.alias("x"), (F.col("y") + (F.col("yb") - F.col("y")) * (m - F.col("x")) / (F.col("xb") - F.col("x"))).alias("y"))
    crosses = lambda m: (F.col("x") - m) * (F.col("xb") - m) < 0
    west, east = F.col("w"), F.col("w") + 360
    points = F.array_compact(F.array(F.struct(F.lit(0.0).alias("t"), clamp(F.col("x")).alias("x"), F.col("y").alias("y")), F.when(crosses(west), at(west)), F.when(crosses(east), at(east))))
    each = d.select("place_id", (F.col("part") * 8 + F.col("k") + 4).alias("part"), "ring", "seq", "k", F.explode(points).alias("p"))
    order = Window.partitionBy(*RING).orderBy("seq", "p.t")
    return each.select(*RING, F.row_number().over(order).cast("int").alias("seq"), (F.col("p.x") - 360 * F.col("k")).alias("x"), F.col("p.y").alias("y"))


# measures ----
def area_plane(e: DataFrame) -> DataFrame:
    """Planar area of each place; holes count against it by their direction."""
    return e.groupBy("place_id").agg((F.sum((F.col("xa") - F.col("xb")) * (F.col("ya") + F.col("yb"))) / 2).alias("area"))


def authalic_q(lat: Column) -> Column:
    """q of WGS84: areas between parallels are a²/2 · dlon · dq. ``lat`` in degrees."""
    s, e = F.sin(F.radians(lat)), math.sqrt(E2)
    return (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))


def equal_area(e: DataFrame, ellipsoid: bool = False) -> DataFrame:
    """Edges in the equal-area plane (longitude in degrees, sin of latitude or q); they stay straight there."""
    f = authalic_q if ellipsoid else (lambda y: F.sin(F.radians(y)))
    return e.withColumn("ya", f(F.col("ya"))).withColumn("yb", f(F.col("yb")))


def area_km2(e: DataFrame) -> DataFrame:
    """Area on the ellipsoid, edges straight in the equal-area plane; densify long edges first."""
    plane = area_plane(equal_area(e, ellipsoid=True))
    return plane.select("place_id", (F.col("area") * math.radians(1) * A_KM * A_KM / 2).alias("area_km2"))


def centroid(e: DataFrame) -> DataFrame:
    """Area-weighted centre of polygons."""
    cross = F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")
    s = e.groupBy("place_id").agg(F.sum(cross).alias("a"), F.sum((F.col("xa") + F.col("xb")) * cross).alias("sx"), F.sum((F.col("ya") + F.col("yb")) * cross).alias("sy"))
    return s.select("place_id", (F.col("sx") / (3 * F.col("a"))).alias("lon"), (F.col("sy") / (3 * F.col("a"))).alias("lat"))


def line_centroid(e: DataFrame) -> DataFrame:
    """Length-weighted centre of lines."""
    n = F.sqrt(F.pow(F.col("xb") - F.col("xa"), 2) + F.pow(F.col("yb") - F.col("ya"), 2))
    return e.groupBy("place_id").agg((F.sum((F.col("xa") + F.col("xb")) / 2 * n) / F.sum(n)).alias("lon"), (F.sum((F.col("ya") + F.col("yb")) / 2 * n) / F.sum(n)).alias("lat"))


def haversine_km(xa: Column, ya: Column, xb: Column, yb: Column) -> Column:
    h = F.pow(F.sin(F.radians(yb - ya) / 2), 2) + F.cos(F.radians(ya)) * F.cos(F.radians(yb)) * F.pow(F.sin(F.radians(xb - xa) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(h))


def length_km(e: DataFrame) -> DataFrame:
    return e.groupBy("place_id").agg(F.round(F.sum(haversine_km(F.col("xa"), F.col("ya"), F.col("xb"), F.col("yb"))), 1).alias("length_km"))


def max_edge_span(e: DataFrame, pole: float = 89.999) -> DataFrame:
    """Longest step in longitude of each place, edges at a pole exempt."""
    exempt = (F.abs("ya") >= pole) & (F.abs("yb") >= pole)
    return e.groupBy("place_id").agg(F.max(F.when(exempt, 0.0).otherwise(F.abs(F.col("xb") - F.col("xa")))).alias("span"))


def densify(e: DataFrame, step: float) -> DataFrame:
    """Vertices with points along edges, at most ``step`` degrees apart; each ring closes again."""
    n = F.greatest(F.lit(1), F.ceil(F.sqrt(F.pow(F.col("xb") - F.col("xa"), 2) + F.pow(F.col("yb") - F.col("ya"), 2)) / step).cast("int"))
    last = F.col("seq") == F.max("seq").over(Window.partitionBy(*RING))
    d = e.withColumn("n", n).withColumn("end", F.when(last, F.col("n")).otherwise(F.col("n") - 1)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("end"))))
    at = lambda a, b: F.when(F.col("i") == F.col("n"), F.col(b)).otherwise(F.col(a) + (F.col(b) - F.col(a)) * F.col("i") / F.col("n"))
    order = Window.partitionBy(*RING).orderBy("edge", "i")
    return d.select(*RING, F.col("seq").alias("edge"), "i", at("xa", "xb").alias("x"), at("ya", "yb").alias("y")).select(*RING, F.row_number().over(order).alias("seq"), "x", "y")


def make_line(points: DataFrame, key: str, *order: str) -> DataFrame:
    """Lines through ordered points (lon, lat); keys with one point give none."""
    w = Window.partitionBy(key)
    d = points.withColumn("seq", F.row_number().over(w.orderBy(*order))).withColumn("n", F.count("*").over(w)).where("n > 1")
    return d.select(F.col(key).cast("string").alias("place_id"), F.lit(1).alias("part"), F.lit(0).alias("ring"), "seq", F.col("lon").alias("x"), F.col("lat").alias("y"))


def clean_kind(parts: DataFrame) -> DataFrame:
    """Of each place's parts only those of the highest kind: polygons before lines before points. ``parts`` has (place_id, part, kind, x0, y0, x1, y1).

    Adds ``problem``: out of range, zero length, or lower kind; null for parts that stay.
    """
    rank = F.when(F.col("kind") == "polygon", 1).when(F.col("kind") == "line", 2).otherwise(3)
    best = F.min("rank").over(Window.partitionBy("place_id"))
    outside = (F.abs("x0") > 180) | (F.abs("x1") > 180) | (F.abs("y0") > 90) | (F.abs("y1") > 90)
    flat = (F.col("kind") == "line") & (F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1"))
    d = parts.withColumn("rank", rank).withColumn("best", best)
    return d.withColumn("problem", F.when(outside, "range").when(flat, "zero length").when(F.col("rank") > F.col("best"), "lower kind")).drop("rank", "best")


def dissolve(v: DataFrame, key: str) -> DataFrame:
    """Several rows of one key as one place: parts are numbered anew."""
    parts = v.select(key, "place_id", "part").distinct()
    numbered = parts.withColumn("new", F.row_number().over(Window.partitionBy(key).orderBy("place_id", "part")))
    return v.join(numbered, [key, "place_id", "part"]).select(F.col(key).cast("string").alias("place_id"), F.col("new").alias("part"), "ring", "seq", "x", "y")


# audit ----
def crossings(e: DataFrame) -> DataFrame:
    """Pairs of edges of one ring that cross properly, found through shared bands of longitude as wide as the ring's mean edge."""
    s = deal(e, "x", steps(e, "x", *RING), *RING)
    p, q = s.alias("p"), s.alias("q")
    same = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in (*RING, "band")]
    side = lambda o, a, b: (F.col(f"{a}.xb") - F.col(f"{a}.xa")) * (F.col(f"{b}.y{o}") - F.col(f"{a}.ya")) - (F.col(f"{a}.yb") - F.col(f"{a}.ya")) * (F.col(f"{b}.x{o}") - F.col(f"{a}.xa"))
    hit = (side("a", "p", "q") * side("b", "p", "q") < 0) & (side("a", "q", "p") * side("b", "q", "p") < 0)
    return p.join(q, same + [F.col("p.seq") < F.col("q.seq")]).where(hit).select(*[F.col(f"p.{c}").alias(c) for c in RING], F.col("p.seq").alias("a"), F.col("q.seq").alias("b")).distinct()


def validity_audit(v: DataFrame, vertex_cap: int = 100_000) -> DataFrame:
    """(place_id, closed, short, flat, outside, broken, jumps, crossing, large): what is wrong with each place, as counts of rings or points."""
    whole = Window.partitionBy(*RING)
    p = v.withColumn("n", F.count("*").over(whole)).withColumn("open", (F.min_by("x", "seq").over(whole) != F.max_by("x", "seq").over(whole)) | (F.min_by("y", "seq").over(whole) != F.max_by("y", "seq").over(whole)))
    bad = F.isnan("x") | F.isnan("y") | F.col("x").isNull() | F.col("y").isNull()
    points = p.groupBy("place_id").agg(F.count_if((F.col("seq") == 1) & F.col("open")).alias("open"), F.count_if((F.col("seq") == 1) & (F.col("n") < 4)).alias("short"), F.count_if((F.abs("x") > 180) | (F.abs("y") > 90)).alias("outside"), F.count_if(bad).alias("broken"), (F.count("*") > vertex_cap).alias("large"))
    e = edges(v)
    flat = ring_areas(e).groupBy("place_id").agg(F.count_if(F.abs("area") < 1e-12).alias("flat"))
    jumps = e.groupBy("place_id").agg(F.count_if(F.abs(F.col("xb") - F.col("xa")) > 180).alias("jumps"))
    cross = crossings(e).groupBy("place_id").agg(F.count("*").alias("crossing"))
    return points.join(flat, "place_id", "left").join(jumps, "place_id", "left").join(cross, "place_id", "left").fillna(0, ["flat", "jumps", "crossing"])


def assign_holes(v: DataFrame) -> DataFrame:
    """Rings of unknown role (place_id, ring, seq, x, y): clockwise ones are shells, others holes of the smallest shell around them.

    A hole lies in a shell that holds its first vertex; rings under four points are dropped. Gives (place_id, ring, shell).
    A vertex meets only the shell edges in its band of latitude.
    """
    n = v.groupBy("place_id", "ring").agg(F.count("*").alias("n")).where("n >= 4").select("place_id", "ring")
    d = v.join(n, ["place_id", "ring"]).withColumn("part", F.lit(1))
    e = edges(d)
    areas = ring_areas(e).select("place_id", "ring", "area")
    shells = areas.where("area < 0").select("place_id", F.col("ring").alias("shell"), F.abs("area").alias("size"))
    first = d.where("seq = 1").join(areas.where("area > 0"), ["place_id", "ring"]).select("place_id", "ring", "x", "y")
    se = e.join(shells.withColumnRenamed("shell", "ring"), ["place_id", "ring"]).select("place_id", F.col("ring").alias("shell"), "size", "xa", "ya", "xb", "yb")
    passes = ((F.col("ya") > F.col("y")) != (F.col("yb") > F.col("y"))) & (F.col("x") < (F.col("xb") - F.col("xa")) * (F.col("y") - F.col("ya")) / (F.col("yb") - F.col("ya")) + F.col("xa"))
    sized = steps(se, "y", "place_id")
    at = first.join(sized, "place_id").withColumn("band", F.floor(F.col("y") / F.col("step"))).drop("step")
    inside = at.join(deal(se, "y", sized, "place_id"), ["place_id", "band"]).groupBy("place_id", "ring", "shell", "size").agg((F.count_if(passes) % 2 == 1).alias("in")).where("in")
    holes = inside.groupBy("place_id", "ring").agg(F.min_by("shell", F.struct("size", "shell")).alias("shell"))
    return holes.unionByName(shells.select("place_id", F.col("shell").alias("ring"), "shell"))
