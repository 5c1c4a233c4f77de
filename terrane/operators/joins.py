"""Joins of place tables: boundaries, events, lookups, indicators, manifests, layers. Sizes decide broadcasts, not hints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions import boxes as B
from terrane.functions.text import norm_name, search_rank


# attributes and boundaries ----
def join_boundaries(attrs: DataFrame, bounds: DataFrame, key: str, empty: Column) -> DataFrame:
    """Rows with a boundary that is not empty."""
    return attrs.join(bounds.where(~empty), key)


def boundary_misses(attrs: DataFrame, bounds: DataFrame, key: str, empty: Column) -> DataFrame:
    """Matched rows, rows without a boundary, rows with an empty one, in one pass."""
    found = bounds.select(key, empty.alias("empty"))
    return attrs.join(found, key, "left").agg(F.count_if(~F.col("empty")).alias("matched"), F.count_if(F.col("empty").isNull()).alias("missing"), F.count_if(F.col("empty")).alias("empty"))


# status events ----
def histories(events: DataFrame) -> DataFrame:
    """(key, history, latest): events by date, those of one day in file order. ``events`` has (key, date, value, source, seq)."""
    event = F.struct("date", "seq", "value", "source")
    return events.groupBy("key").agg(F.array_sort(F.collect_list(event)).alias("history"), F.max(event).alias("latest"))


def apply_events(df: DataFrame, events: DataFrame, key: str, value: Column, source: Column, date: Column) -> DataFrame:
    """The latest event overrides status, source and date together; the history is attached."""
    h = histories(events).withColumnRenamed("key", key)
    hit = F.col("latest").isNotNull()
    return df.join(h, key, "left").withColumns({
        "status": F.when(hit, F.col("latest.value")).otherwise(value), "status_source": F.when(hit, F.col("latest.source")).otherwise(source),
        "status_date": F.when(hit, F.col("latest.date")).otherwise(date), "n_events": F.coalesce(F.size("history"), F.lit(0)),
    }).drop("latest")


def unmatched_events(events: DataFrame, df: DataFrame, key: str) -> DataFrame:
    return events.select("key").distinct().join(df.select(F.col(key).alias("key")), "key", "left_anti")


# lookups ----
def core_flag(stations: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return stations.join(keys.select(key, F.lit(True).alias("core")).distinct(), key, "left").withColumn("core", F.coalesce("core", F.lit(False)))


def map_values(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """The table's value (from, to); a missing key keeps the value."""
    t = table.select(F.col("from").alias("_from"), F.col("to").alias("_to"))
    return df.join(t, F.col(column) == F.col("_from"), "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def unmapped_values(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """What the strict form objects to."""
    return df.select(F.col(column).alias("from")).distinct().join(table.select("from"), "from", "left_anti")


def assign_indicator(zones: DataFrame, latest: DataFrame) -> DataFrame:
    """The territory's value, else the sovereign's, for 200NM zones; ``basis`` says which. ``latest`` has (code, yr, val)."""
    one = latest.select(F.col("code").alias("ter"), F.struct("yr", "val").alias("a"))
    two = latest.select(F.col("code").alias("sov"), F.struct("yr", "val").alias("b"))
    d = zones.join(one, "ter", "left").join(two, "sov", "left")
    ok = F.col("pol_type") == "200NM"
    hit = F.when(ok, F.coalesce("a", "b"))
    return d.select("zone_id", hit["yr"].alias("yr"), hit["val"].alias("val"), F.when(ok & F.col("a").isNotNull(), "territory").when(ok & F.col("b").isNotNull(), "sovereign").alias("basis"))


# same sites ----
def same_place(a: str, b: str, least_iou: float = 0.8, tolerance: float = 1e-3) -> Column:
    """Whether two index rows (aliases) of one kind cover the same ground: boxes by overlap, points by position."""
    box = lambda x: B.box(*[F.col(f"{x}.{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    p, q = box(a), box(b)
    near = F.lit(True)
    for c in ("xmin", "ymin", "xmax", "ymax"):
        near = near & (F.abs(p[c] - q[c]) <= tolerance)
    return F.when((B.area(p) > 0) & (B.area(q) > 0), B.iou(p, q) >= least_iou).otherwise(near)


def box_runs(index: DataFrame) -> DataFrame:
    """Index rows with their name key, kind and member key; placeholders and rows without a box left out."""
    from terrane.functions.text import geom_kind, is_placeholder

    d = index.withColumn("name_key", norm_name("name")).withColumn("kind", geom_kind("geom_type")).withColumn("member", F.concat_ws("/", "collection", "place_id"))
    return d.where((F.col("name_key") != "") & ~is_placeholder("name") & F.col("xmin").isNotNull())


def same_name_pairs(index: DataFrame, cell: float = 2.0) -> DataFrame:
    """Pairs (a, b), a < b by member key, that are the same place: equal names and kinds, then the box rule.

    Rows with one exact box are one node here (their smallest member), joined to it by links, so a name held by
    many copies gives links and not all pairs. Boxes that may match share the cell of their lower left corner or a
    neighbour's, as boxes that overlap by four fifths have corners within a quarter of their width.
    """
    d = box_runs(index)
    exact = ["name_key", "kind", "xmin", "ymin", "xmax", "ymax"]
    first = d.groupBy(*exact).agg(F.min("member").alias("first"))
    links = d.join(first, exact).where("member != first").select(F.col("first").alias("a"), F.col("member").alias("b"))
    scale = F.greatest(F.lit(cell), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("xmax") - F.col("xmin"), F.lit(1e-9))))))
    # a width's power of two may differ by one between partners, so each row stands in its own scale and the next
    placed = first.withColumn("scale", F.explode(F.array(scale, scale * 2))).withColumn("gx", F.floor(F.col("xmin") / F.col("scale")))
    around = placed.withColumn("gx", F.explode(F.array(F.col("gx") - 1, F.col("gx"), F.col("gx") + 1)))
    p, q = placed.alias("p"), around.alias("q")
    same = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("name_key", "kind", "scale", "gx")]
    pairs = p.join(q, same + [F.col("p.first") < F.col("q.first")]).where(same_place("p", "q")).select(F.col("p.first").alias("a"), F.col("q.first").alias("b"))
    return links.unionByName(pairs).distinct()


# layers ----
def layers_covering(sites: DataFrame, layers: DataFrame, cell: float = 60.0) -> DataFrame:
    """(place_id, layer, global, place): layers whose box meets the place's, by source, global ones last, then in order.

    Both have (xmin, ymin, xmax, ymax); layers also (layer, source_rank, seq). Boxes meet in shared longitude cells.
    """
    n = round(360 / cell)
    cells = lambda b: F.explode(F.array_distinct(F.transform(F.sequence(F.floor(b["xmin"] / cell), F.floor(F.least(F.when(b["xmin"] <= b["xmax"], b["xmax"]).otherwise(b["xmax"] + 360), b["xmin"] + 359.999) / cell)), lambda c: F.pmod(c, F.lit(n)))))
    box = B.box(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    p = sites.select("place_id", box.alias("pb")).withColumn("cell", cells(F.col("pb")))
    q = layers.select("layer", "source_rank", "seq", box.alias("lb"), B.is_global(box).alias("global")).withColumn("cell", cells(F.col("lb")))
    hits = p.join(q, "cell").where(B.meet(F.col("pb"), F.col("lb"))).select("place_id", "layer", "source_rank", "seq", "global").distinct()
    order = Window.partitionBy("place_id").orderBy("source_rank", F.col("global").cast("int"), "seq")
    return hits.select("place_id", "layer", "global", F.row_number().over(order).alias("place"))


def layer_for_place(sites: DataFrame, layers: DataFrame) -> DataFrame:
    """One layer per place: of its collection, else of its authority (its own place type first), else the first of all."""
    exact = sites.join(layers.select(F.col("collection"), F.col("layer").alias("own")), "collection", "left")
    by_auth = layers.groupBy("authority", "place_type").agg(F.min(F.struct("seq", "layer")).alias("typed"))
    any_auth = layers.groupBy("authority").agg(F.min(F.struct("seq", "layer")).alias("any"))
    first = layers.agg(F.min(F.struct("seq", "layer")).alias("first"))
    d = exact.join(by_auth, ["authority", "place_type"], "left").join(any_auth, "authority", "left").crossJoin(first)  # one row
    return d.select("place_id", F.coalesce("own", "typed.layer", "any.layer", "first.layer").alias("layer"))


def display_via(pieces: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    return pieces.join(parents.select(F.col("place_id").alias(column), F.col("name").alias("drawn_by")), column)


# catalog ----
def merge_sources(ranked: DataFrame) -> DataFrame:
    """One row per slug, the lowest rank wins. ``ranked`` has (slug, rank, ...)."""
    w = Window.partitionBy("slug").orderBy("rank")
    return ranked.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def attach_if_current(rows: DataFrame, manifests: DataFrame) -> DataFrame:
    return rows.join(manifests, ["slug", "sha"], "left")


def missing_or_stale(rows: DataFrame, manifests: DataFrame) -> DataFrame:
    return rows.join(manifests, ["slug", "sha"], "left_anti")


def change_reason(old: str, new: str) -> Column:
    """Why a source counts as changed, null if it does not: presence, last edit, count, checksum, validators, in this order."""
    o, n = (lambda c: F.col(f"{old}.{c}")), (lambda c: F.col(f"{new}.{c}"))
    differs = lambda c: o(c).isNotNull() & n(c).isNotNull() & (o(c) != n(c))
    dated = o("last_edit").isNotNull() & n("last_edit").isNotNull()
    summed = o("checksum").isNotNull() & n("checksum").isNotNull()
    tokens = F.when(differs("last_edit"), "last edit").when(dated & differs("n"), "count")
    return F.when(o("source_no").isNull(), "new source").when(n("source_no").isNull(), "source gone").when(dated, tokens).when(summed, F.when(differs("checksum"), "checksum")).otherwise(F.when(differs("etag"), "validators"))


def detect_changes(published: DataFrame, probes: DataFrame) -> DataFrame:
    """(slug, source_no, reason): the first source of each slug that changed. Both have (slug, source_no, last_edit, n, checksum, etag)."""
    o, n = published.alias("o"), probes.alias("n")
    both = o.join(n, (F.col("o.slug") == F.col("n.slug")) & (F.col("o.source_no") == F.col("n.source_no")), "full")
    each = both.select(F.coalesce("o.slug", "n.slug").alias("slug"), F.coalesce("o.source_no", "n.source_no").alias("source_no"), change_reason("o", "n").alias("reason")).where("reason is not null")
    return each.groupBy("slug").agg(F.min(F.struct("source_no", "reason")).alias("m")).select("slug", "m.source_no", "m.reason")


def ledger_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Keys whose hash differs from the version before, or that are new."""
    p = previous.select("key", F.col("hash").alias("was"))
    return current.join(p, "key", "left").where(~F.col("hash").eqNullSafe(F.col("was"))).select("key", "hash", "was")


# time ----
def then_vs_now(values: DataFrame, keys: list[str], years: int = 8) -> DataFrame:
    """Each month's value beside that of the same month ``years`` before. ``values`` has keys, t, v."""
    then = values.select(*keys, F.add_months("t", 12 * years).alias("t"), F.col("v").alias("then"))
    return values.join(then, [*keys, "t"]).select(*keys, "t", F.col("v").alias("now"), "then")


# search and sets ----
def search_sites(index: DataFrame, hit: Column) -> DataFrame:
    """Hits, one per group of copies: the copy whose collection ranks first, the others in ``also``."""
    group = F.coalesce("group_id", F.concat_ws("/", "collection", "place_id"))
    rank = F.struct(search_rank("collection").alias("rank"), F.col("collection"), F.col("place_id"))
    found = index.where(hit).groupBy(group.alias("g")).agg(F.array_sort(F.collect_list(rank)).alias("copies"))
    return found.select("g", F.get("copies", F.lit(0))["place_id"].alias("place_id"), F.transform(F.slice("copies", F.lit(2), F.size("copies") - 1), lambda c: c["place_id"]).alias("also"))


def values_index(coverage: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct (place, indicator, coll) with a known file, first seen first. ``coverage`` has seq."""
    seen = coverage.join(manifest, "indicator").groupBy("place_id", "indicator", "coll", "file").agg(F.min("seq").alias("seq"))
    return seen


def set_membership(sites: DataFrame, sets: DataFrame) -> DataFrame:
    """(place_id, set_id): sets any of whose groups is among the place's collections."""
    p = sites.select("place_id", F.explode("colls").alias("g"))
    return p.join(sets.select("set_id", F.explode("groups").alias("g")), "g").select("place_id", "set_id").distinct()


def carry(pairs: DataFrame, left: DataFrame, right: DataFrame, left_columns: list[str], right_columns: list[str]) -> DataFrame:
    """Pairs (a_id, b_id) with carried columns, left first; a column that does not exist is an error."""
    for df, columns in ((left, left_columns), (right, right_columns)):
        if missing := [c for c in columns if c not in df.columns]:
            raise ValueError(f"no such column to carry: {missing}")
    one = left.select(F.col("place_id").alias("a_id"), *[F.col(c).alias(f"a_{c}") for c in left_columns])
    two = right.select(F.col("place_id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in right_columns])
    rest = [c for c in pairs.columns if c not in ("a_id", "b_id")]
    return pairs.join(one, "a_id").join(two, "b_id").select("a_id", "b_id", *[f"a_{c}" for c in left_columns], *[f"b_{c}" for c in right_columns], *rest)
