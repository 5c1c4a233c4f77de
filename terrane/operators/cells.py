"""Coverage of sites by grid cells: shares of cells inside sites, hierarchical membership, cell lists of a regular grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.boxes import cell_at
from terrane.operators.geometry import bounds, equal_area
from terrane.operators.graph import cut
from terrane.operators.overlap import min_integral, polygon_overlap

TOLERANCE = 1e-9


def cell_shares(sites: DataFrame, cells: DataFrame) -> DataFrame:
    """(place_id, cell, share): the share of each cell's area inside each place, for any cells given as edges."""
    p, c = equal_area(sites), equal_area(cells)
    areas = c.groupBy("place_id").agg((F.sum((F.col("xa") - F.col("xb")) * (F.col("ya") + F.col("yb"))) / 2).alias("size")).withColumnRenamed("place_id", "b_id")
    both = polygon_overlap(p, c, tolerance=TOLERANCE).join(areas, "b_id")
    return both.select(F.col("a_id").alias("place_id"), F.col("b_id").alias("cell"), F.least(F.lit(1.0), F.col("area") / F.col("size")).alias("share"))


def cell_code(res: Column, ix: Column, iy: Column) -> Column:
    """Resolution in the top bits, then column and row of 28 bits each."""
    return F.shiftleft(res.cast("bigint"), 56).bitwiseOR(F.shiftleft(ix.cast("bigint"), 28)).bitwiseOR(iy.cast("bigint"))


def width(res: int) -> tuple[float, float]:
    """Cell width in degrees and height in the sine of latitude; 2^(res+1) by 2^res cells."""
    return 360 / 2 ** (res + 1), 2 / 2**res


def _below(e: Column, level: Column) -> Column:
    """The integral over a stretch x0..x1 of the lower of an edge and a level, above -1."""
    y = lambda x: F.col("ya") + (F.col("yb") - F.col("ya")) * (x - F.col("xa")) / (F.col("xb") - F.col("xa"))
    length = F.col("x1") - F.col("x0")
    y0, y1 = y(F.col("x0")), y(F.col("x1"))
    return min_integral(length, (y0 + y1 + 2) / 2 * length, (level + 1) * length, y0 - level, y1 - level)


def _shares(e: DataFrame, candidates: DataFrame, res: int) -> DataFrame:
    """Shares of candidate cells (place_id, ix, iy) at one resolution. ``e`` are edges in the equal-area plane."""
    w, h = width(res)
    west, south = F.col("ix") * w - 180, F.col("iy") * h - 1
    lo, hi = F.least("xa", "xb"), F.greatest("xa", "xb")
    strips = e.where("xa != xb").withColumn("ix", F.explode(F.sequence(F.floor((lo + 180) / w), F.floor((hi + 180) / w))))
    d = candidates.join(strips, ["place_id", "ix"]).withColumn("x0", F.greatest(lo, west)).withColumn("x1", F.least(hi, west + w)).where("x1 > x0")
    sign = F.when(F.col("xb") < F.col("xa"), 1).otherwise(-1)
    area = F.sum(sign * (_below(F.col("ya"), south + h) - _below(F.col("ya"), south)))
    return d.groupBy("place_id", "ix", "iy").agg((area / (w * h)).alias("share"))


def grid_membership(e: DataFrame, res_max: int, min_share: float = 0.01, min_part: float = 0.01) -> DataFrame:
    """(place_id, res, ix, iy, share) of the equal-area quad grid for all resolutions to ``res_max``.

    Only cells that the border passes are refined; a cell inside passes share 1 to its descendants. A cell stays if its
    share is at least ``min_share`` or it holds at least ``min_part`` of the place. ``e`` are edges within -180..180.
    What a cell may lack or hold and still count as full or empty is measured by the finest cells, as a sliver of a coarse
    cell may be a good part of a fine one.
    """
    plane = cut(equal_area(e).select("place_id", "xa", "ya", "xb", "yb"))
    size = plane.groupBy("place_id").agg((F.sum((F.col("xa") - F.col("xb")) * (F.col("ya") + F.col("yb"))) / 2).alias("size"))
    box = bounds(plane.select("place_id", F.col("xa").alias("x"), F.col("ya").alias("y")))
    children = F.explode(F.array(*[F.struct((F.col("ix") * 2 + i).alias("ix"), (F.col("iy") * 2 + j).alias("iy")) for i in (0, 1) for j in (0, 1)]))
    down = lambda df: df.select("place_id", children.alias("c")).select("place_id", "c.ix", "c.iy")
    candidates = box.select("place_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("ix"), F.lit(0).alias("iy"))
    inside, levels = None, []
    for res in range(res_max + 1):
        w, h = width(res)
        least = TOLERANCE / 4 ** (res_max - res)
        found = cut(_shares(plane, candidates, res).where(F.col("share") > least))
        full = found.where(F.col("share") >= 1 - least).select("place_id", "ix", "iy")
        border = found.where(F.col("share") < 1 - least)
        inside = full if inside is None else cut(full.unionByName(down(inside)))
        level = border.unionByName(inside.withColumn("share", F.lit(1.0))).join(size, "place_id")
        keep = (F.col("share") >= min_share) | (F.col("share") * (w * h) >= min_part * F.col("size"))
        levels.append(level.where(keep & (F.col("share") > TOLERANCE)).select("place_id", F.lit(res).alias("res"), "ix", "iy", F.least("share", F.lit(1.0)).alias("share")))
        candidates = down(border)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def keep_rule(share: Column, cell_area: Column, place_area: Column, min_share: float = 0.01, min_part: float = 0.01) -> Column:
    return (share > 0) & ((share >= min_share) | (share * cell_area >= min_part * place_area))


def membership_parent(res: Column, ix: Column, iy: Column, up: int) -> Column:
    """The coarse cell that a fine one is stored under."""
    return cell_code(res - up, F.floor(ix / 2**up), F.floor(iy / 2**up))


def summarise_by_place(membership: DataFrame, values: DataFrame) -> DataFrame:
    """Share-weighted mean and sum of a cell table's values per place. ``values`` has (res, ix, iy, v)."""
    d = membership.join(values, ["res", "ix", "iy"])
    return d.groupBy("place_id", "res").agg((F.sum(F.col("share") * F.col("v")) / F.sum("share")).alias("mean"), F.sum(F.col("share") * F.col("v")).alias("total"), F.count("*").alias("cells"))


def share_audit(membership: DataFrame, e: DataFrame) -> DataFrame:
    """Per place and resolution, the area of its cells' shares against its own."""
    plane = equal_area(e)
    size = plane.groupBy("place_id").agg((F.sum((F.col("xa") - F.col("xb")) * (F.col("ya") + F.col("yb"))) / 2).alias("size"))
    cell = F.lit(720.0) / F.pow(F.lit(2.0), 2 * F.col("res") + 1)
    s = membership.groupBy("place_id", "res").agg(F.sum(F.col("share") * cell).alias("covered"))
    return s.join(size, "place_id").withColumn("loss", 1 - F.col("covered") / F.col("size"))


def _first_at(x: Column, x0: float, res: float) -> Column:
    """The first column whose centre is at ``x`` or east of it. The division may be off by one, so the centres themselves decide."""
    centre = lambda c: x0 + (c + 0.5) * res
    c = F.ceil((x - x0) / res - 0.5)
    return F.when(centre(c - 1) >= x, c - 1).when(centre(c) < x, c + 1).otherwise(c)


def _merged(runs: DataFrame, ncol: int) -> DataFrame:
    """Runs (place_id, r, c0, c1) of columns, wrapped onto the grid's columns and cut so that no cell is in two of them."""
    start, n = F.pmod("c0", F.lit(ncol)), F.least(F.lit(ncol), F.col("c1") - F.col("c0") + 1)
    end = start + n - 1
    piece = lambda a, b: F.struct(a.cast("bigint").alias("c0"), b.cast("bigint").alias("c1"))
    wrapped = F.when(end < ncol, F.array(piece(start, end))).otherwise(F.array(piece(start, F.lit(ncol - 1)), piece(F.lit(0), end - ncol)))
    w = runs.select("place_id", "r", F.inline(wrapped))
    before = F.max("c1").over(Window.partitionBy("place_id", "r").orderBy("c0", "c1").rowsBetween(Window.unboundedPreceding, -1))
    return w.withColumn("c0", F.greatest("c0", F.coalesce(before + 1, F.lit(0)))).where("c0 <= c1")


def place_runs(e: DataFrame, x0: float, y0: float, res: float, ncol: int, nrow: int, most: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Runs of columns (place_id, r, c0, c1) of the grid cells whose centre is inside, and (place_id, cells, listed) of all places.

    Scanlines: each edge meets the rows whose centre line it crosses; crossings of a part and row in order pair up to runs. So
    rows grow with edges and the rows that they cross, not with areas. A part without any centre counts the cell under its
    box's centre. Longitudes past 180 wrap. A place is refused, and has no runs, if the box of one of its parts holds more than
    four times ``most`` cells, which is told before any crossing is made (``cells`` is null then), or if it has more than
    ``most`` cells, which are counted from the runs.
    """
    row = lambda y: F.floor((y0 - y) / res + 1e-9)
    column = lambda x: F.floor((x - x0) / res + 1e-9)
    outer = e.where("ring = 0").select("place_id", "part", F.inline(F.array(*[F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in "ab"])))
    box = cut(bounds(outer, "place_id", "part"))
    rows = F.least(F.lit(nrow - 1), row(F.col("ymin"))) - F.greatest(F.lit(0), row(F.col("ymax"))) + 1
    held = rows * (column(F.col("xmax")) - column(F.col("xmin")) + 1)
    refused = box.where(held > 4 * most).select("place_id").distinct()
    parts = box.join(refused, "place_id", "left_anti")
    line = y0 - (F.col("r") + 0.5) * res
    reach = lambda y, d: F.floor((y0 - y) / res - 0.5) + d
    low, high = F.greatest(F.lit(0), reach(F.greatest("ya", "yb"), -1)), F.least(F.lit(nrow - 1), reach(F.least("ya", "yb"), 2))
    met = e.where("ya != yb").join(refused, "place_id", "left_anti").withColumn("r", F.explode(F.when(low <= high, F.sequence(low, high)))).where((F.col("ya") > line) != (F.col("yb") > line))
    crossings = met.select("place_id", "part", "r", ((F.col("xb") - F.col("xa")) * (line - F.col("ya")) / (F.col("yb") - F.col("ya")) + F.col("xa")).alias("x"))
    order = Window.partitionBy("place_id", "part", "r").orderBy("x")
    pairs = crossings.withColumn("to", F.lead("x").over(order)).withColumn("k", F.row_number().over(order)).where("k % 2 = 1")
    runs = pairs.select("place_id", "part", "r", _first_at(F.col("x"), x0, res).alias("c0"), (_first_at(F.col("to"), x0, res) - 1).alias("c1")).where("c0 <= c1")
    runs = cut(runs)
    bare = parts.join(runs.select("place_id", "part").distinct(), ["place_id", "part"], "left_anti")
    centre = column((F.col("xmin") + F.col("xmax")) / 2)
    bare = bare.select("place_id", row((F.col("ymin") + F.col("ymax")) / 2).alias("r"), centre.alias("c0"), centre.alias("c1"))
    merged = _merged(runs.drop("part").unionByName(bare), ncol)
    counts = merged.groupBy("place_id").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("cells"))
    status = cut(counts.withColumn("listed", F.col("cells") <= most).unionByName(refused.select("place_id", F.lit(None).cast("bigint").alias("cells"), F.lit(False).alias("listed"))))
    return merged.join(status.where("not listed").select("place_id"), "place_id", "left_anti"), status


def place_cells(e: DataFrame, x0: float, y0: float, res: float, ncol: int, nrow: int, tile_deg: float, most: int = 200_000) -> DataFrame:
    """(place_id, cell, tile, listed): the cells of :func:`place_runs`, each once. A refused place has one row, without a cell, that is not listed."""
    runs, status = place_runs(e, x0, y0, res, ncol, nrow, most)
    each = runs.withColumn("c", F.explode(F.sequence("c0", "c1"))).select("place_id", cell_at(F.col("r"), F.col("c"), ncol, res, tile_deg).alias("k"))
    none = status.where("not listed").select("place_id", F.lit(None).cast("bigint").alias("cell"), F.lit(None).cast("bigint").alias("tile"), "listed")
    return each.select("place_id", "k.cell", "k.tile", F.lit(True).alias("listed")).unionByName(none)


def tiles_of(cells: DataFrame) -> DataFrame:
    """The tiles of listed cells."""
    return cells.where("cell is not null").groupBy("place_id", "tile").agg(F.count("*").alias("n"), F.min("cell").alias("first"), F.max("cell").alias("last"))
