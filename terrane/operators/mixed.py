"""Places of mixed geometry as one relation of vertices with kinds: routing to one kind and reduction by dimension.

Vertices are (place_id, part, ring, seq, x, y, kind), kind being polygon, line or point. A place may have parts of all
three. Polygons count before lines and lines before points, both in what a place keeps and in where its centre is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("polygon", "line", "point")


def part_problems(v: DataFrame, wanted: str = "mixed") -> DataFrame:
    """(place_id, part, kind, problem) of each part; the problem is null for parts that stay.

    ``wanted`` is the kind of the collection. ``mixed`` keeps of each place the parts of its highest kind. ``polygon`` and
    ``line`` keep parts of that kind. ``one point`` and ``one line`` keep places of a single part of that kind within the
    range of longitudes and latitudes. Lines without length and parts without coordinates never stay.
    """
    real = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))
    seen = F.when(real("x").isNotNull() & real("y").isNotNull(), F.lit(1))
    of = v.groupBy("place_id", "part").agg(F.min("kind").alias("kind"), F.count(seen).alias("n"), F.min(real("x")).alias("xmin"), F.max(real("x")).alias("xmax"), F.min(real("y")).alias("ymin"), F.max(real("y")).alias("ymax"))
    place = Window.partitionBy("place_id")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    d = of.withColumn("rank", rank).withColumn("best", F.min(F.when(F.col("n") > 0, F.col("rank"))).over(place)).withColumn("parts", F.count("*").over(place))
    bare = F.when(F.col("n") == 0, "no coordinates").when(F.col("rank") == 0, "unknown kind")
    flat = (F.col("kind") == "line") & (F.col("xmin") == F.col("xmax")) & (F.col("ymin") == F.col("ymax"))
    if wanted == "mixed":
        problem = bare.when(F.col("rank") > F.col("best"), "lower kind").when(flat, "zero length")
    elif wanted in ("polygon", "line"):
        problem = bare.when(F.col("kind") != wanted, "other kind").when(flat, "zero length")
    elif wanted in ("one point", "one line"):
        outside = (F.col("xmin") < -180) | (F.col("xmax") > 180) | (F.col("ymin") < -90) | (F.col("ymax") > 90)
        problem = bare.when(F.col("kind") != wanted.split()[1], "other kind").when(F.col("parts") > 1, "several parts").when(outside, "range").when(flat, "zero length")
    else:
        raise ValueError(f"unknown kind {wanted}")
    return d.select("place_id", "part", "kind", problem.alias("problem"))


def routed(v: DataFrame, wanted: str = "mixed") -> tuple[DataFrame, DataFrame]:
    """Vertices that stay, and (place_id, part, problem) of what goes: each part with its problem, and each place of which nothing stays, with a null part."""
    parts = part_problems(v, wanted)
    kept = v.join(parts.where("problem is null").select("place_id", "part"), ["place_id", "part"], "left_semi")
    gone = parts.where("problem is not null").select("place_id", "part", "problem")
    empty = parts.groupBy("place_id").agg(F.count_if(F.col("problem").isNull()).alias("n")).where("n = 0")
    return kept, gone.unionByName(empty.select("place_id", F.lit(None).cast(v.schema["part"].dataType).alias("part"), F.lit("empty").alias("problem")))


def centroids(v: DataFrame) -> DataFrame:
    """(place_id, dimension, lon, lat): the centre of each place by its highest dimension that has a measure.

    Polygons weigh by area, holes against it (rings are oriented), else lines and the borders of flat polygons by length, else points alike.
    One reduction over all vertices. Sums run from the place's lower left corner, so that a small place far from 0 keeps its
    digits: the products cancel to its own size and not to its distance.
    """
    corner = v.groupBy("place_id").agg(F.min("x").alias("ox"), F.min("y").alias("oy"))
    ring = Window.partitionBy("place_id", "part", "ring").orderBy("seq")
    local = v.join(corner, "place_id").withColumn("xa", F.col("x") - F.col("ox")).withColumn("ya", F.col("y") - F.col("oy"))
    e = local.withColumn("xb", F.lead("xa").over(ring)).withColumn("yb", F.lead("ya").over(ring))
    cross = F.when(F.col("kind") == "polygon", F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya"))
    length = F.when(F.col("kind") != "point", F.sqrt(F.pow(F.col("xb") - F.col("xa"), 2) + F.pow(F.col("yb") - F.col("ya"), 2)))
    middle: list[Column] = [(F.col(f"{c}a") + F.col(f"{c}b")) / 2 for c in "xy"]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    s = e.groupBy("place_id", "ox", "oy").agg(
        total(cross).alias("a"), *[total(2 * m * cross).alias(f"a{c}") for m, c in zip(middle, "xy", strict=True)],
        total(length).alias("l"), *[total(m * length).alias(f"l{c}") for m, c in zip(middle, "xy", strict=True)],
        F.avg("xa").alias("px"), F.avg("ya").alias("py"),
    )
    solid, long = F.col("a") != 0, F.col("l") > 0
    at = lambda c: F.col(f"o{c}") + F.when(solid, F.col(f"a{c}") / (3 * F.col("a"))).when(long, F.col(f"l{c}") / F.col("l")).otherwise(F.col(f"p{c}"))
    return s.select("place_id", F.when(solid, 2).when(long, 1).otherwise(0).alias("dimension"), at("x").alias("lon"), at("y").alias("lat"))
