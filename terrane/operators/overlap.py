"""Spatial joins of polygons and points by buckets and closed forms.

Candidates come from an equi-join on coarse grid cells of the boxes; overlap areas are sums over pairs of edges that share
a stretch of longitude. Nothing is joined without an equality. What decides a pair lies in the two rows that meet, so pairs
are not shuffled, however many there are; only places of very many edges meet edge by edge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.operators.geometry import bounds, deal, steps

#: A place of up to this many edges meets others as one row. Larger ones are dealt to strips, edge by edge.
PACKED = 32
#: Bands of latitude are this many mean edges high; up to ``FEW`` edges of a band are written out as columns.
BAND = 4
FEW = 6


def buckets(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def _meeting(a: DataFrame, b: DataFrame, size: float = 10.0) -> DataFrame:
    """Rows of ``a`` as p and of ``b`` as q whose boxes meet. A pair is taken in the one bucket that holds its boxes' lower left common corner, so none comes twice."""
    spread = lambda df: df.withColumn("gx", F.explode(buckets(F.col("xmin"), F.col("xmax"), size))).withColumn("gy", F.explode(buckets(F.col("ymin"), F.col("ymax"), size)))
    p, q = spread(a).alias("p"), spread(b).alias("q")
    c = lambda s: F.col(s)
    meet = (c("p.xmin") <= c("q.xmax")) & (c("q.xmin") <= c("p.xmax")) & (c("p.ymin") <= c("q.ymax")) & (c("q.ymin") <= c("p.ymax"))
    once = (c("p.gx") == F.floor(F.greatest("p.xmin", "q.xmin") / size)) & (c("p.gy") == F.floor(F.greatest("p.ymin", "q.ymin") / size))
    return p.join(q, (c("p.gx") == c("q.gx")) & (c("p.gy") == c("q.gy")) & meet & once)


def box_join(a: DataFrame, b: DataFrame, size: float = 10.0) -> DataFrame:
    """(a_id, b_id) whose boxes (id, xmin, ymin, xmax, ymax) meet."""
    return _meeting(a, b, size).select(F.col("p.id").alias("a_id"), F.col("q.id").alias("b_id"))


def _y(e: str, x: Column) -> Column:
    c = lambda n: F.col(f"{e}.{n}")
    return c("ya") + (c("yb") - c("ya")) * (x - c("xa")) / (c("xb") - c("xa"))


def min_integral(length: Column, f: Column, g: Column, d0: Column, d1: Column) -> Column:
    """The integral of the lower of two lines over a stretch, from their own integrals and the differences at its ends."""
    crossed = (f + g - length * (d0 * d0 + d1 * d1) / (2 * F.abs(d0 - d1))) / 2
    return F.when((d0 <= 0) & (d1 <= 0), f).when((d0 >= 0) & (d1 >= 0), g).otherwise(crossed)


def _sized(e: DataFrame) -> DataFrame:
    """(id, xmin, ymin, xmax, ymax, n, step): box, edges that are not upright and their mean width; places without any are left out."""
    level = e.where("xa != xb")
    n = level.groupBy("place_id").agg(F.count("*").alias("n"))
    box = bounds(e.select("place_id", F.col("xa").alias("x"), F.col("ya").alias("y")))
    return box.join(n, "place_id").join(steps(level, "x", "place_id"), "place_id").withColumnRenamed("place_id", "id")


def _packed(e: DataFrame, sized: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The small places of ``sized`` with ``parts``: an array of (keys, edges), where an edge runs east from (lo, at) to hi with a slope and a sign."""
    east = F.col("xa") < F.col("xb")
    edge = F.struct(
        F.least("xa", "xb").alias("lo"), F.greatest("xa", "xb").alias("hi"), F.when(east, F.col("ya")).otherwise(F.col("yb")).alias("at"),
        ((F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa"))).alias("slope"), F.when(east, -1.0).otherwise(1.0).alias("sign"),
    )
    small = sized.where(F.col("n") <= PACKED)
    one = e.where("xa != xb").join(small.select(F.col("id").alias("place_id")), "place_id", "left_semi").groupBy("place_id", *keys).agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    places = one.groupBy("place_id").agg(F.sort_array(F.collect_list(F.struct(*keys, "edges"))).alias("parts"))
    return small.join(places.withColumnRenamed("place_id", "id"), "id").select("id", "xmin", "ymin", "xmax", "ymax", "parts")


def _shared_area(p: Column, q: Column, base: Column) -> Column:
    """The area that two arrays of edges have in common, from what each pair of edges bounds above ``base``."""

    def piece(a: Column, b: Column) -> Column:
        x0, x1 = F.greatest(a["lo"], b["lo"]), F.least(a["hi"], b["hi"])
        y = lambda e, x: e["at"] + e["slope"] * (x - e["lo"]) - base
        return F.struct((a["sign"] * b["sign"]).alias("sign"), (x1 - x0).alias("w"), y(a, x0).alias("a0"), y(a, x1).alias("a1"), y(b, x0).alias("b0"), y(b, x1).alias("b1"))

    pieces = F.flatten(F.transform(p, lambda a: F.transform(F.filter(q, lambda b: (b["lo"] < a["hi"]) & (a["lo"] < b["hi"])), lambda b: piece(a, b))))
    below = lambda t: min_integral(t["w"], (t["a0"] + t["a1"]) / 2 * t["w"], (t["b0"] + t["b1"]) / 2 * t["w"], t["a0"] - t["b0"], t["a1"] - t["b1"])
    return F.aggregate(pieces, F.lit(0.0), lambda total, t: total + t["sign"] * below(t))


def _beside(df: DataFrame, side: str, frame: DataFrame | None) -> DataFrame:
    """``df`` with the columns of ``frame`` (place_id, ...) by its ``side``'s id, named ``side``_column."""
    if frame is None:
        return df
    named = frame.select(F.col("place_id").alias(f"{side}_id"), *[F.col(c).alias(f"{side}_{c}") for c in frame.columns if c != "place_id"])
    return df.join(named, f"{side}_id")


def _small_pairs(a: DataFrame, b: DataFrame, tolerance: float, keys: tuple[str, ...], left: DataFrame | None, right: DataFrame | None) -> tuple[DataFrame, Column]:
    """Pairs of packed places whose boxes meet (a_id, b_id, columns of left and right), and the array of (a_key, b_key, area) over the tolerance. Each pair is one row, so it is decided where it is found."""
    p, q = (_beside(x.withColumn(f"{s}_id", F.col("id")), s, frame) for x, s, frame in ((a, "a", left), (b, "b", right)))
    named = lambda s, x: [x[k].alias(f"{s}_{k}") for k in keys]
    base = F.least(F.col("p.ymin"), F.col("q.ymin"))
    area = lambda x, y: F.struct(*named("a", x), *named("b", y), _shared_area(x["edges"], y["edges"], base).alias("area"))
    each = F.flatten(F.transform(F.col("p.parts"), lambda x: F.transform(F.col("q.parts"), lambda y: area(x, y))))
    return _meeting(p, q), F.filter(each, lambda x: x["area"] > tolerance)


def _carried(frame: DataFrame | None, side: str) -> list[str]:
    return [] if frame is None else [f"{side}_{c}" for c in frame.columns if c != "place_id"]


def polygon_overlap(a: DataFrame, b: DataFrame, pairs: DataFrame | None = None, tolerance: float = 1e-9, keys: tuple[str, ...] = (), left: DataFrame | None = None, right: DataFrame | None = None) -> DataFrame:
    """(a_id, b_id, area): pairs of polygons, as edges, with positive overlap.

    Two places of up to ``PACKED`` edges each meet as two rows, and what they share is known there. If one has more, edges are
    dealt to strips of longitude, so a place with very many edges is worked on in many tasks. A pair's strips are
    a power of two of degrees, at least the mean edge of both, and only those in the longitudes that the two share: rows grow
    with the edges near the pair. With ``keys``, such as ("part",), areas are given for those parts too. ``left`` and ``right``
    (place_id, ...) have more columns of the places of ``a`` and ``b``: they come as a_column and b_column, and only places with a row there count.
    """
    ab, bb = _sized(a), _sized(b)
    out = [f"{s}_{'id' if k == 'place_id' else k}" for s in "ab" for k in ("place_id", *keys)] + _carried(left, "a") + _carried(right, "b") + ["area"]
    if pairs is not None:
        return _beside(_beside(_by_strips(a, b, ab, bb, pairs, tolerance, keys), "a", left), "b", right).select(*out)
    near, areas = _small_pairs(_packed(a, ab, keys), _packed(b, bb, keys), tolerance, keys, left, right)
    far = _by_strips(a, b, ab, bb, _large_pairs(ab, bb), tolerance, keys)
    return near.select("a_id", "b_id", *_carried(left, "a"), *_carried(right, "b"), F.inline(areas)).select(*out).unionByName(_beside(_beside(far, "a", left), "b", right).select(*out))


def _large_pairs(ab: DataFrame, bb: DataFrame) -> DataFrame:
    """Pairs (a_id, b_id) of sized places whose boxes meet and of which one at least is large."""
    large = F.col("n") > PACKED
    return box_join(ab.where(large), bb).unionByName(box_join(ab.where(~large), bb.where(large)))


def _by_strips(a: DataFrame, b: DataFrame, ab: DataFrame, bb: DataFrame, pairs: DataFrame, tolerance: float, keys: tuple[str, ...]) -> DataFrame:
    """:func:`polygon_overlap` of given pairs, edge by edge."""
    ids = ("place_id", *keys)
    name = lambda s: [F.col(k).alias(f"{s}_{'id' if k == 'place_id' else k}") for k in ids]
    side = lambda d, s: d.select(F.col("id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in ("xmin", "xmax", "ymin", "step")])
    level = F.ceil(F.log2(F.greatest("a_step", "b_step"))).cast("int")
    west, east = F.greatest("a_xmin", "b_xmin"), F.least("a_xmax", "b_xmax")
    base = pairs.select("a_id", "b_id").join(side(ab, "a"), "a_id").join(side(bb, "b"), "b_id").where(west < east)
    base = base.select("a_id", "b_id", level.alias("level"), F.least("a_ymin", "b_ymin").alias("base"), west.alias("west"), east.alias("east"))
    size = F.pow(F.lit(2.0), "level")
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size))).alias("strip")
    lo, hi = F.least("xa", "xb"), F.greatest("xa", "xb")

    def cut(e: DataFrame, s: str) -> DataFrame:
        edge = F.struct("xa", "ya", "xb", "yb", lo.alias("lo"), hi.alias("hi"), F.when(F.col("xb") < F.col("xa"), 1).otherwise(-1).alias("s")).alias(s)
        wanted = base.select(F.col(f"{s}_id").alias("place_id"), "level").distinct()
        return e.where("xa != xb").join(wanted, "place_id").select(*name(s), "level", edge, cells(lo, hi))

    shared = base.select("a_id", "b_id", "level", "base", cells(F.col("west"), F.col("east")))
    d = shared.join(cut(a, "a"), ["a_id", "level", "strip"]).join(cut(b, "b"), ["b_id", "level", "strip"])
    x0, x1 = F.greatest("a.lo", "b.lo"), F.least("a.hi", "b.hi")
    d = d.withColumn("x0", x0).withColumn("x1", x1).where((F.col("x1") > F.col("x0")) & (F.col("strip") == F.floor(F.col("x0") / size)))
    length = F.col("x1") - F.col("x0")
    ya0, ya1, yb0, yb1 = (_y(e, F.col(x)) - F.col("base") for e in "ab" for x in ("x0", "x1"))
    term = F.col("a.s") * F.col("b.s") * min_integral(length, (ya0 + ya1) / 2 * length, (yb0 + yb1) / 2 * length, ya0 - yb0, ya1 - yb1)
    out = [f"{s}_{'id' if k == 'place_id' else k}" for s in "ab" for k in ids]
    return d.groupBy(*out).agg(F.sum(term).alias("area")).where(F.col("area") > tolerance)


def points_in_polygons(points: DataFrame, e: DataFrame, size: float = 5.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """(point_id, place_id, carried columns) of points (point_id, lon, lat) inside polygons, as edges, by the even-odd rule; holes count.

    Edges are dealt to bands of latitude, some mean edges high, and those of one band travel together to each bucket that the
    band meets. So a point meets a place once, with all the edges that decide it, and pairs of points and places are not shuffled.
    """
    sized = steps(e, "y", "place_id").withColumn("step", F.col("step") * BAND)
    bands = deal(e.where("ya != yb").select("place_id", "xa", "ya", "xb", "yb"), "y", sized, "place_id").groupBy("place_id", "band", "step").agg(F.flatten(F.collect_list(F.array("xa", "ya", "xb", "yb"))).alias("edges"))
    box = bounds(e.select("place_id", F.col("xa").alias("x"), F.col("ya").alias("y")))
    # a little wider than the band, as the band of a latitude comes from a division
    low, high = F.greatest("ymin", (F.col("band") - 1e-6) * F.col("step")), F.least("ymax", (F.col("band") + 1 + 1e-6) * F.col("step"))
    spread = bands.join(box, "place_id").withColumn("gx", F.explode(buckets(F.col("xmin"), F.col("xmax"), size))).withColumn("gy", F.explode(F.when(low <= high, buckets(low, high, size))))
    p = points.select("point_id", "lon", "lat", *carry, F.floor(F.col("lon") / size).alias("gx"), F.floor(F.col("lat") / size).alias("gy"))
    def passes(xa: Column, ya: Column, xb: Column, yb: Column) -> Column:
        return ((ya > F.col("lat")) != (yb > F.col("lat"))) & (F.col("lon") < (xb - xa) * (F.col("lat") - ya) / (yb - ya) + xa)

    def inside(pieces: DataFrame, odd: Column) -> DataFrame:
        near = p.join(pieces, ["gx", "gy"]).where("lon between xmin and xmax and lat between ymin and ymax")
        return near.where(F.floor(F.col("lat") / F.col("step")) == F.col("band")).where(odd).select("point_id", "place_id", *carry)

    few = F.size("edges") <= 4 * FEW
    # an edge that is not there has ends at one latitude and so is passed by no point
    wide = spread.where(few).select("*", *[F.coalesce(F.get("edges", F.lit(k)), F.lit(0.0)).alias(f"e{k}") for k in range(4 * FEW)]).drop("edges")
    flags = [passes(*[F.col(f"e{i + k}") for k in range(4)]) for i in range(0, 4 * FEW, 4)]
    odd = F.aggregate(F.sequence(F.lit(0), F.size("edges") - 4, F.lit(4)), F.lit(False), lambda odd, i: odd != passes(*[F.get("edges", i + k) for k in range(4)]))
    return inside(wide, reduce(lambda x, y: x != y, flags)).unionByName(inside(spread.where(~few), odd))


def derive_intersect(a: DataFrame, b: DataFrame, min_area: float, min_part: float) -> DataFrame:
    """Pieces (a_id, b_id, area, fragments, lost, reason): overlaps of two collections. Fragments of parts under ``min_part`` go first, then slivers under ``min_area``; ``reason`` is null for pieces that stay."""
    ab, bb, keys = _sized(a), _sized(b), ("part",)
    near, areas = _small_pairs(_packed(a, ab, keys), _packed(b, bb, keys), 1e-9, keys, None, None)
    none = F.lit(None).cast("double")
    # one more part: of the pieces of a pair, the areas that stay, how many go, and the areas that go
    add = lambda so, x: F.struct(
        F.when(x["area"] >= min_part, F.coalesce(so["area"], F.lit(0.0)) + x["area"]).otherwise(so["area"]).alias("area"), (so["fragments"] + (x["area"] < min_part).cast("bigint")).alias("fragments"),
        F.when(x["area"] < min_part, F.coalesce(so["lost"], F.lit(0.0)) + x["area"]).otherwise(so["lost"]).alias("lost"),
    )
    start = F.struct(none.alias("area"), F.lit(0).cast("bigint").alias("fragments"), none.alias("lost"))
    summed = near.select("a_id", "b_id", F.inline(F.array(F.aggregate(areas, start, add)))).where("area is not null or lost is not null")
    far = _by_strips(a, b, ab, bb, _large_pairs(ab, bb), 1e-9, keys).groupBy("a_id", "b_id").agg(F.sum(F.when(F.col("area") >= min_part, F.col("area"))).alias("area"), F.count_if(F.col("area") < min_part).alias("fragments"), F.sum(F.when(F.col("area") < min_part, F.col("area"))).alias("lost"))
    return summed.unionByName(far).withColumn("reason", F.when(F.col("area").isNull(), "fragments").when(F.col("area") < min_area, "sliver"))


def derived_report(pieces: DataFrame) -> DataFrame:
    """What ``derive_intersect`` drops, as counts and areas."""
    return pieces.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), F.sum(F.coalesce("area", "lost")).alias("area"))

