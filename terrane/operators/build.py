"""Building a collection: several sources to one table of places, with notes on all that was dropped.

Each source is filtered in one pass: its kept rows are written once, and how many each rule dropped is observed in the same
pass. Vertices are routed to the collection's kind, features without any are dropped and counted, natives are renamed and
read by their types, ids and common columns are stamped, events set status and history, equal ids are told apart by component.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrane.functions.boxes import morton
from terrane.functions.text import template
from terrane.operators import rows as R
from terrane.operators.geometry import bounds
from terrane.operators.graph import scratch
from terrane.operators.joins import apply_events
from terrane.operators.mixed import KINDS, routed

_STORED = ("MultiPolygon", "MultiLineString", "MultiPoint")


@dataclass(frozen=True)
class Source:
    """One layer: ``rows`` of native attributes and ``vertices`` (feature, part, ring, seq, x, y, kind), joined by ``feature``, a native column."""

    component: str
    rows: DataFrame
    vertices: DataFrame
    feature: str
    kinds: dict[str, str] = field(default_factory=dict)
    include: dict[str, list] = field(default_factory=dict)
    exclude: dict[str, list] = field(default_factory=dict)
    edit_day: str | None = None
    retrieved: str | None = None


@dataclass(frozen=True)
class Built:
    """``places`` by place_id, their ``vertices``, ``dropped`` (component, reason, n) and ``problems`` (place_id, problem)."""

    places: DataFrame
    vertices: DataFrame
    dropped: DataFrame
    problems: DataFrame


def observed_filter(df: DataFrame, include: dict[str, list], exclude: dict[str, list]) -> tuple[DataFrame, Observation]:
    """Rows that match every include rule and no exclude rule, and an observation with the number of rows, of rows left out, and of
    rows that each excluded value dropped, a row counting for the first. The counts are there once the rows have been written."""
    values = [(f, str(v)) for f, vs in exclude.items() for v in vs]
    hit = F.coalesce(*[F.when(F.col(f).cast("string") == v, F.lit(f"{f}={v}")) for f, v in values]) if values else F.lit(None).cast("string")
    inside = R.matches_all(include)
    seen = Observation()
    counts = [F.count_if(inside & (F.col("_hit") == f"{f}={v}")).alias(f"{f}={v}") for f, v in values]
    marked = df.withColumn("_hit", hit).observe(seen, F.count("*").alias("rows"), F.count_if(~inside).alias("not included"), *counts)
    return marked.where(inside & F.col("_hit").isNull()).drop("_hit"), seen


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    folder = scratch(df.sparkSession.range(0))  # of its own plan: an observation ends with the first action over it
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _layer(source: Source, config: dict) -> tuple[DataFrame, DataFrame, list[tuple[str, str, int]]]:
    """A source's kept features and vertices, and its notes."""
    kept, seen = observed_filter(source.rows, source.include, source.exclude)
    kept = written(kept)
    notes = [(source.component, reason, n) for reason, n in seen.get.items() if reason != "rows" and n]
    own = source.vertices.join(kept.select(F.col(source.feature).alias("feature")), "feature", "left_semi").withColumnRenamed("feature", "place_id")
    vertices, _ = routed(own, config.get("geometry", "mixed"))
    vertices = written(vertices.withColumnRenamed("place_id", "feature"))
    kinds = vertices.groupBy("feature").agg(F.min(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))).cast("int").alias("_rank"))
    rows = kept.join(kinds.withColumnRenamed("feature", "_feature"), F.col(source.feature) == F.col("_feature"), "left")
    stored = F.coalesce(*[F.when(F.col("_rank") == i, F.lit(kind)) for i, kind in enumerate(_STORED, 1)])
    # the templates read native names; natives that are named like a common column are renamed after
    stamped = {c: template(config[c]) for c in ("place_id", "source_id", "name") if c in config}
    rows = rows.withColumns({f"_new_{c}": v for c, v in stamped.items()}).withColumn("_type", stored)
    rows = R.rename_natives(R.coerce(rows, source.kinds)).withColumnsRenamed({f"_new_{c}": c for c in stamped} | {"_type": "geom_type"})
    day = lambda v: F.lit(v).cast("date")
    rows = rows.withColumn("source_date", F.coalesce(day(source.edit_day), day(source.retrieved)))
    return rows.drop("_feature", "_rank"), vertices, notes


def build_collection(config: dict, sources: list[Source], events: DataFrame | None = None, event_key: str | None = None) -> Built:
    """Builds a collection of ``sources``. ``config`` has templates ``place_id``, ``name`` and perhaps ``source_id``; texts ``authority``, ``place_type``,
    ``license``, ``attribution``, ``version``; ``status`` and ``status_source``; ``geometry`` (a kind of :func:`routed`, mixed if absent),
    ``pattern`` of ids, and ``order``, ``id`` or ``space``. ``events`` has (key, date, value, source, seq) by the native column ``event_key``.
    """
    layers = [_layer(s, config) for s in sources]
    rows = R.union_sources({s.component: r for s, (r, _, _) in zip(sources, layers, strict=True)})
    feature = F.coalesce(*[F.when(F.col("component") == s.component, F.col(s.feature).cast("string")) for s in sources])
    rows = written(rows.withColumn("_feature", feature))
    bare = rows.where("geom_type is null").groupBy("component").agg(F.count("*").alias("n")).select("component", F.lit("no geometry").alias("reason"), "n")
    spark = rows.sparkSession
    notes = [n for _, _, ns in layers for n in ns]
    dropped = spark.createDataFrame(notes, "component string, reason string, n long").unionByName(bare)
    rank = F.array_position(F.array(*[F.lit(s.component) for s in sources]), F.col("component"))
    rows = rows.where("geom_type is not null")
    rows = R.suffixed(rows, "place_id", F.col("component"), rank, F.col("_feature")).drop("place_id").withColumnRenamed("unique_id", "place_id")
    constants: dict[str, Column] = {c: F.lit(config.get(c)) for c in ("authority", "place_type", "license", "version")}
    rows = rows.withColumns(constants | {"attribution": F.trim(F.regexp_replace(F.lit(config.get("attribution", "")), r"\s+", " "))})
    status, source, day = F.lit(config.get("status")), F.lit(config.get("status_source")), F.lit(config.get("status_date", ""))
    if events is None:
        rows = rows.withColumns({"status": status, "status_source": source, "status_date": day})
    else:
        rows = apply_events(rows, events, event_key, status, source, day)
    rows = written(rows)
    key = rows.select("component", "_feature", "place_id")
    parts = [v.withColumn("component", F.lit(s.component)).withColumn("_feature", F.col("feature").cast("string")).drop("feature") for s, (_, v, _) in zip(sources, layers, strict=True)]
    vertices = parts[0]
    for more in parts[1:]:
        vertices = vertices.unionByName(more)
    vertices = vertices.join(key, ["component", "_feature"]).drop("component", "_feature")
    places = rows.drop("_feature")
    if config.get("order") == "id":
        places = places.repartitionByRange("place_id").sortWithinPartitions("place_id")
    elif config.get("order") == "space":
        box = bounds(vertices).select("place_id", morton((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2).alias("_at"))
        places = places.join(box, "place_id").repartitionByRange("_at", "place_id").sortWithinPartitions("_at", "place_id").drop("_at")
    wrong = places.where(~F.coalesce(F.col("place_id").rlike(config.get("pattern", ".")), F.lit(False))).select("place_id", F.lit("pattern").alias("problem"))
    twice = R.duplicate_ids(places).select("place_id", F.lit("not unique").alias("problem"))
    return Built(places, vertices, dropped, wrong.unionByName(twice))
