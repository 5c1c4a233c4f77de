"""Aggregates: latest values, roll-ups, audits, checksums, box unions, domains, directory totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.text import squash
from terrane.operators.graph import cut


# latest values and indicators ----
def finite(c: Column) -> Column:
    """The number a text holds; NaN, infinities and other text are null."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def latest_by(series: DataFrame) -> DataFrame:
    """(code, yr, val): the latest year with a finite value, the first record of equal years. ``series`` has (code, yr, value, seq)."""
    d = series.withColumn("val", finite(F.col("value").cast("string"))).where("val is not null")
    return d.groupBy("code").agg(F.max(F.struct("yr", (-F.col("seq")).alias("minus"), "val")).alias("m")).select("code", "m.yr", "m.val")


def order_statistics(values: DataFrame, key: str, value: str, quantiles: list[float], bins: int = 1024) -> DataFrame:
    """(key, i, n, v): for the i-th quantile q the value at place floor(q * (n - 1)) of each key's sorted values, exact with ties.

    Nothing is sorted. Each round counts the values of a range in bins, with the least and the largest of each bin; the
    bin that holds the place is the next range, until its values are all one. Counts are partial in each task, so a key with
    all rows is no task's own, and a range shrinks by the number of bins a round. Rounds take bins of equal width and
    of equal ratio in turn, so that values of many magnitudes take few rounds too. Null and non-finite values are left out.
    """
    real = F.col(value).cast("double")
    d = values.where(real.isNotNull() & ~F.isnan(real) & (F.abs(real) < float("inf"))).select(F.col(key).alias("key"), F.col(value).alias("v"))
    sizes = d.groupBy("key").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(quantiles)]))
    state = cut(sizes.select("*", asked).select("key", "i", "n", F.floor(F.col("q") * (F.col("n") - 1)).alias("place"), "lo", "hi"))
    magnitude = lambda c: F.when(c == 0, F.lit(0.0)).otherwise(F.signum(c.cast("double")) * (F.ln(F.abs(c.cast("double"))) + 745))  # the least double is exp(-744.4)
    even = True
    while state.where("lo < hi").limit(1).count():
        wide = state.where("lo < hi").withColumnRenamed("key", "of")
        inside = d.join(wide, F.col("key").eqNullSafe(F.col("of"))).where("v between lo and hi")
        v, lo, hi = (F.col(c) if even else magnitude(F.col(c)) for c in ("v", "lo", "hi"))
        share = F.coalesce((v - lo).cast("double") / F.nullif((hi - lo).cast("double"), F.lit(0.0)), F.lit(0.0))
        counted = inside.groupBy("key", "i", "n", "place", F.floor(share * bins).alias("bin")).agg(F.count("*").alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = F.coalesce(F.sum("m").over(Window.partitionBy("key", "i").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hit = counted.withColumn("before", before).where("before <= place and place < before + m").select("key", "i", "n", (F.col("place") - F.col("before")).alias("place"), "lo", "hi")
        state = cut(state.where("lo = hi").unionByName(hit))
        even = not even
    return state.select(F.col("key").alias(key), "i", "n", F.col("lo").alias("v"))


def colour_domain(values: DataFrame, key: str, value: str, low: float = 0.05, high: float = 0.95, declared: DataFrame | None = None) -> DataFrame:
    """(key, lo, hi): the declared domain of a key, else its values at the lower index floor(q * (n - 1)), found by :func:`order_statistics`."""
    at = lambda i: F.max(F.when(F.col("i") == i, F.col("v")))
    found = order_statistics(values, key, value, [low, high]).groupBy(key).agg(at(0).alias("lo"), at(1).alias("hi"))
    if declared is None:
        return found
    d = declared.select(F.col(key).alias("of"), F.col("lo").alias("lo_"), F.col("hi").alias("hi_"))
    return found.join(d, F.col(key).eqNullSafe(F.col("of")), "left").select(key, F.coalesce("lo_", "lo").alias("lo"), F.coalesce("hi_", "hi").alias("hi"))


# roll-ups ----
def status_rollup(coverage: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    return coverage.groupBy("place_id").agg(*[count(s).alias(s) for s in ("above", "within", "below", "none", "nodata")], F.count("*").alias("cells"), F.max(F.when(F.col("status") != "nodata", F.col("last_time"))).alias("latest"))


def usage_rollup(metrics: DataFrame, interval: str = "interval") -> DataFrame:
    """Sampled bytes per key and month; requests without a key are left out."""
    return metrics.where("api_key is not null").groupBy("api_key", F.date_trunc("month", "ts").alias("month")).agg(F.sum(F.col(interval) * F.col("bytes")).alias("bytes"), F.count("*").alias("requests"))


def cap_state(usage: DataFrame, caps: DataFrame, soft: float = 0.8) -> DataFrame:
    """ok, soft or hard, and the percentage to one decimal. ``caps`` has (api_key, cap)."""
    part = F.col("bytes") / F.col("cap")
    return usage.join(caps, "api_key").withColumn("state", F.when(part >= 1, "hard").when(part >= soft, "soft").otherwise("ok")).withColumn("percent", F.round(part * 100, 1))


def directory_rollup(listing: DataFrame, skip: str = r"(^|/)index\.html$") -> DataFrame:
    """Objects, bytes, oldest and newest of each directory at every level. ``listing`` has (key, size, modified)."""
    steps = F.split("key", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/")))
    own = F.when(F.size(steps) > 1, F.concat(F.array(F.lit("/")), ancestors)).otherwise(F.array(F.lit("/")))
    each = listing.where(~F.col("key").rlike(skip)).select(F.explode(own).alias("directory"), "size", "modified")
    return each.groupBy("directory").agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"), F.min("modified").alias("oldest"), F.max("modified").alias("newest"))


def group_layers(layers: DataFrame) -> DataFrame:
    """Titles by authority, sorted; blank authorities are Other and come last."""
    name = F.coalesce(squash("authority"), F.lit("Other"))
    g = layers.groupBy(name.alias("authority")).agg(F.array_sort(F.collect_list("title")).alias("titles"))
    return g.withColumn("last", F.col("authority") == "Other")


def line_stats(stations: DataFrame, length: Column | None = None) -> DataFrame:
    """Per line: stations, core ones, first and last, and with ``length`` (each station's distance from the one before) its kilometres to one decimal. ``stations`` has (line, station, core)."""
    return stations.groupBy("line").agg(F.count("*").alias("n"), F.count_if("core").alias("n_core"), F.max("core").alias("any_core"), F.min("station").alias("first"), F.max("station").alias("last"), *([] if length is None else [F.round(F.sum(length), 1).alias("length_km")])).withColumn("too_short", F.col("n") < 2)


# audits ----
def infer_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, type): int if all values are whole numbers, float if all are numbers, else string; without values string."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("string")
        aggs += [F.count(c).alias(f"{c}_n"), F.count_if(v.rlike(r"^[+-]?\d+$")).alias(f"{c}_i"), F.count_if(v.try_cast("double").isNotNull()).alias(f"{c}_f")]
    row = df.agg(*aggs)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_n").alias("n"), F.col(f"{c}_i").alias("i"), F.col(f"{c}_f").alias("f")) for c in columns])
    kind = F.when(F.col("x.n") == 0, "string").when(F.col("x.i") == F.col("x.n"), "int").when(F.col("x.f") == F.col("x.n"), "float").otherwise("string")
    return row.select(F.explode(each).alias("x")).select("x.column", kind.alias("type"))


def problems(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): rows that break each rule, in one pass."""
    row = df.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])).alias("x")).select("x.*")


def empties(df: DataFrame, columns: list[str]) -> DataFrame:
    return problems(df, {c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in columns})


def content_checksum(df: DataFrame, key: str) -> DataFrame:
    """A checksum per key over its rows, whatever their order: four 60-bit words of each row's hash are summed, in partial sums, and the sums hashed."""
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]), 256)
    words = [F.sum(F.conv(F.substring("hash", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"w{i}") for i in range(4)]
    sums = df.select(key, row.alias("hash")).groupBy(key).agg(*words)
    return sums.select(key, F.sha2(F.concat_ws("|", *[f"w{i}" for i in range(4)]), 256).alias("checksum"))


def expected_count(df: DataFrame, key: str, expected: DataFrame) -> DataFrame:
    """(key, n, expected, problem): warn or fail where the count differs. ``expected`` has (key, expected, mode)."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    d = expected.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return d.where("n != expected").select(key, "n", "expected", F.when(F.col("mode") == "fail", "fail").otherwise("warn").alias("problem"))


def collection_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("collection").agg(F.count("*").alias("sites"), F.count("name").alias("named"), F.count_distinct("place_id").alias("ids"))


def shared_ids(index: DataFrame) -> DataFrame:
    """Ids in more than one collection."""
    return index.groupBy("place_id").agg(F.count_distinct("collection").alias("collections")).where("collections > 1")


def provenance(sources: DataFrame, key: str) -> DataFrame:
    """One record per build: sources in order, blank extras dropped, total rows. ``sources`` has (key, source_no, url, extra, n)."""
    one = F.struct("source_no", "url", F.nullif(F.trim("extra"), F.lit("")).alias("extra"), "n")
    return sources.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(one))).alias("sources"), F.sum("n").alias("rows"))


def source_date(sources: Column) -> Column:
    """The latest edit day in an array of sources."""
    return F.array_max(F.transform(sources, lambda s: F.substring(s["last_edit"].cast("string"), 1, 10)))


def layer_status(events: DataFrame) -> DataFrame:
    """The latest event of each layer with its label. ``events`` has (layer, date, value, seq)."""
    last = events.groupBy("layer").agg(F.max(F.struct("date", "seq", "value")).alias("m"))
    return last.select("layer", "m.date", "m.value", F.concat_ws(" ", F.replace("m.value", F.lit("_"), F.lit(" ")), "m.date").alias("label"))


# longitude circle ----
def union_bbox(boxes: DataFrame, *keys: str) -> DataFrame:
    """The smallest box on the longitude circle that holds a group's boxes; a tie keeps the one that does not cross.

    Boxes that cross 180 degrees are split, intervals merge to islands by a running maximum, and the widest gap
    between islands, or round the back, is left out. ``boxes`` has keys and (xmin, ymin, xmax, ymax).
    """
    crossing = F.col("xmin") > F.col("xmax")
    span = lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"))
    spans = F.when(crossing, F.array(span(F.col("xmin"), F.lit(180.0)), span(F.lit(-180.0), F.col("xmax")))).otherwise(F.array(span(F.col("xmin"), F.col("xmax"))))
    lats = boxes.groupBy(*keys).agg(F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"))
    s = boxes.select(*keys, F.explode(spans).alias("s")).select(*keys, "s.a", "s.b").groupBy(*keys, "a").agg(F.max("b").alias("b"))
    w = Window.partitionBy(*keys).orderBy("a")
    s = s.withColumn("before", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    gaps = s.withColumn("gap", F.col("a") - F.col("before"))
    whole = gaps.groupBy(*keys).agg(F.min("a").alias("west"), F.max("b").alias("east"), F.max(F.when(F.col("gap") > 0, F.struct("gap", (-F.col("a")).alias("minus"), "before"))).alias("_widest"))
    back = F.col("west") + 360 - F.col("east")
    inner = F.coalesce(F.col("_widest.gap") > back, F.lit(False))
    return whole.withColumn("xmin", F.when(inner, -F.col("_widest.minus")).otherwise(F.col("west"))).withColumn("xmax", F.when(inner, F.col("_widest.before")).otherwise(F.col("east"))).join(lats, list(keys)).select(*keys, "xmin", "ymin", "xmax", "ymax")


def place_bbox(parts: DataFrame, key: str) -> DataFrame:
    """One box per place: parts that span more than 180 degrees are grouped by side of the meridian first."""
    spread = Window.partitionBy(key)
    wide = F.max("xmax").over(spread) - F.min("xmin").over(spread) > 180
    side = F.when(wide, F.when((F.col("xmin") + F.col("xmax")) / 2 < 0, 1).otherwise(2)).otherwise(0)
    grouped = parts.withColumn("side", side).groupBy(key, "side").agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    return union_bbox(grouped, key)


def unwrap_crossing(parts: DataFrame, key: str, edge: float = 1e-4) -> DataFrame:
    """Parts of sites that touch both sides of 180 degrees, western ones moved by 360, if the whole then spans less than 360."""
    w = Window.partitionBy(key)
    touches = (F.min("xmin").over(w) <= -180 + edge) & (F.max("xmax").over(w) >= 180 - edge)
    west = (F.col("xmin") + F.col("xmax")) / 2 < 0
    moved = parts.withColumn("touches", touches).withColumn("shift", F.when(F.col("touches") & west, 360.0).otherwise(0.0))
    span = F.max(F.col("xmax") + F.col("shift")).over(w) - F.min(F.col("xmin") + F.col("shift")).over(w)
    moved = moved.withColumn("shift", F.when(span < 360, F.col("shift")).otherwise(0.0))
    return moved.withColumn("xmin", F.col("xmin") + F.col("shift")).withColumn("xmax", F.col("xmax") + F.col("shift")).drop("touches", "shift")
