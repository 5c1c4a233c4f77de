"""The index of all places and the crosswalk of their external ids, from the layers of a catalogue.

A layer's row comes first, then what its collection declares, then what the place id implies. Boxes, centres, kinds and areas
come from the vertices, unwrapped where a place touches both sides of 180 degrees; a layer without vertices may have a box.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions import boxes as B
from terrane.functions import text as T
from terrane.operators import aggregates as A
from terrane.operators import geometry as G
from terrane.operators import rows as R
from terrane.operators.graph import same_place_groups
from terrane.operators.mixed import KINDS, centroids

#: Columns of sources that hold external ids, lower-cased, and the crosswalk column of each; of several the last counts.
CROSSWALK_COLUMNS = {
    "mrgid": "mrgid", "psgid": "psgid", "proseasid": "psgid", "wdpa_cd": "wdpa_id", "wdpa_id": "wdpa_id",
    "wdpaid": "wdpa_id", "mpainv_site_id": "mpainv_site_id", "mpatlas_id": "mpatlas_id",
    "wikidata_qid": "wikidata_qid", "gers_id": "gers_id",
}
IDS = tuple(dict.fromkeys(CROSSWALK_COLUMNS.values()))
EDGE = 1e-6


@dataclass(frozen=True)
class Layer:
    """``rows`` with place_id and native columns; ``vertices`` (place_id, part, ring, seq, x, y, kind) or none; what the collection declares.

    ``declared`` may have geometry_type, authority, place_type, license, attribution, providers (name, roles), updated and access;
    ``usual_types`` are place types by id prefix; ``authority_field`` is the native column that names the authority.
    """

    slug: str
    rows: DataFrame
    vertices: DataFrame | None = None
    declared: dict = field(default_factory=dict)
    version: str | None = None
    place_url: str | None = None
    area_field: str | None = None
    search_fields: tuple[str, ...] = ()
    usual_types: dict[str, str] = field(default_factory=dict)
    authority_field: str = "authority"


@dataclass(frozen=True)
class Index:
    """``places`` with group_id, which are found when first asked for, the ``crosswalk``, rows of each collection (``counts``), ids in more than one (``shared``), and the ``extent`` of all boxes."""

    rows: DataFrame
    crosswalk: DataFrame
    counts: DataFrame
    crosswalk_counts: DataFrame
    shared: DataFrame
    extent: DataFrame

    @cached_property
    def places(self) -> DataFrame:
        return same_place_groups(self.rows)


def unwrapped(vertices: DataFrame) -> DataFrame:
    """Vertices with the western parts of places that touch both sides of 180 degrees moved east by 360."""
    parts = A.unwrap_crossing(G.bounds(vertices, "place_id", "part").withColumn("was", F.col("xmin")), "place_id", EDGE)
    moved = parts.where("xmin != was").select("place_id", "part", (F.col("xmin") - F.col("was")).alias("shift"))
    return vertices.join(moved, ["place_id", "part"], "left").withColumn("x", F.col("x") + F.coalesce("shift", F.lit(0.0))).drop("shift")


def shapes(vertices: DataFrame) -> DataFrame:
    """(place_id, computed, xmin, ymin, xmax, ymax, lon, lat, km2): kind, box, centre and area of each place."""
    v = unwrapped(vertices)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    kinds = v.groupBy("place_id").agg(F.min(rank).alias("rank"), F.count_distinct("part").alias("parts"))
    single = [F.when(F.col("rank") == i, F.lit(name)) for i, name in enumerate(("Polygon", "LineString", "Point"), 1)]
    computed = F.concat(F.when(F.col("parts") > 1, "Multi").otherwise(""), F.coalesce(*single))
    areas = G.area_km2(G.edges(vertices.where("kind = 'polygon'"))).select("place_id", F.round(F.abs("area_km2"), 3).alias("km2"))
    d = kinds.select("place_id", computed.alias("computed")).join(G.bounds(v), "place_id").join(centroids(v).drop("dimension"), "place_id")
    return d.join(areas, "place_id", "left")


def _without_shapes(rows: DataFrame) -> DataFrame:
    """Boxes that the rows have themselves, with their centres."""
    have = {"xmin", "ymin", "xmax", "ymax"} <= {c.lower() for c in rows.columns}
    side = lambda c: F.col(c).cast("double") if have else F.lit(None).cast("double")
    d = rows.select("place_id", F.lit(None).cast("string").alias("computed"), *[side(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    return d.select("*", ((F.col("xmin") + F.col("xmax")) / 2).alias("lon"), ((F.col("ymin") + F.col("ymax")) / 2).alias("lat"), F.lit(None).cast("double").alias("km2"))


def layer_index(layer: Layer) -> DataFrame:
    """A layer's rows of the index, without groups."""
    rows, said = layer.rows, layer.declared
    own = lambda *names: T.squash(R.pick_col(rows, list(names)))
    told = lambda name: T.squash(F.lit(said.get(name)).cast("string"))
    kinds = {c.lower(): t for c, t in rows.dtypes}
    prefix = F.when(F.col("place_id").contains(":"), F.split_part("place_id", F.lit(":"), F.lit(1)))
    usual = F.coalesce(*[F.when(prefix == p, F.lit(t)) for p, t in layer.usual_types.items()], F.lit(None).cast("string"))
    makers = list(dict.fromkeys(p["name"] for p in said.get("providers", []) if p.get("name") and {"producer", "licensor"} & set(p.get("roles", []))))
    credit = T.attribution_text(told("attribution"), F.array(*map(F.lit, makers)).cast("array<string>"), said.get("processor", "the catalogue"))
    name = own("name")
    linked: dict[str, Column] = {}
    for f in re.findall(r"\{([^{}|]+)", layer.place_url or ""):
        value = R.pick_col(rows, [f])
        linked[f] = T.clean_id(value) if kinds.get(f.lower()) in ("double", "float") else value
    no_text = F.lit(None).cast("string")
    area = R.pick_col(rows, [c for c in (layer.area_field, "area_km2") if c and c.lower() in kinds][:1]).try_cast("double")
    picked = rows.select(
        "place_id", name.alias("name"), F.coalesce(own(layer.authority_field), told("authority"), prefix).alias("authority"),
        F.coalesce(own("place_type"), told("place_type"), usual).alias("place_type"), own("geom_type").alias("_row_type"), F.when(~F.isnan(area), area).alias("_area"),
        F.coalesce(own("license"), told("license")).alias("license"), F.coalesce(own("attribution"), credit).alias("attribution"),
        F.coalesce(own("version"), F.lit(layer.version)).alias("version"), told("updated").alias("updated"),
        T.clean_id(R.pick_col(rows, ["source_id"])).alias("source_id"), (T.place_link(layer.place_url, linked) if layer.place_url else no_text).alias("url"),
        (T.keywords([R.pick_col(rows, [f]) for f in layer.search_fields], name) if layer.search_fields else no_text).alias("keywords"),
    )
    shape = _without_shapes(rows) if layer.vertices is None else shapes(layer.vertices)
    d = picked.join(shape.withColumnRenamed("place_id", "_id"), F.col("place_id") == F.col("_id"), "left")
    return d.select(
        "place_id", "name", "authority", "place_type", R.pick_geom_type(F.col("_row_type"), told("geometry_type"), F.col("computed")).alias("geom_type"), F.lit(layer.slug).alias("collection"),
        "xmin", "ymin", "xmax", "ymax", F.col("lon").alias("centroid_lon"), F.col("lat").alias("centroid_lat"), F.coalesce("_area", "km2").alias("area_km2"),
        "license", "attribution", "version", "updated", "source_id", "url", "keywords",
    )


def layer_crosswalk(rows: DataFrame) -> DataFrame:
    """(place_id, external ids) of rows that have any: from the source's columns, else implied by the place id."""
    have = {c.lower(): c for c in rows.columns}
    column = {to: have[name] for name, to in CROSSWALK_COLUMNS.items() if name in have}
    given = lambda to: T.clean_id(column[to]) if to in column else F.lit(None).cast("string")
    d = rows.select("place_id", *[F.coalesce(given(to), T.prefix_id("place_id", to)).alias(to) for to in IDS])
    return d.where(F.coalesce(*IDS).isNotNull())


def build_index(layers: list[Layer]) -> Index:
    """The index and crosswalk of all layers that are not unlisted, by slug."""
    public = sorted((x for x in layers if x.declared.get("access", "public") != "unlisted"), key=lambda x: x.slug)
    places, crosswalk = layer_index(public[0]), layer_crosswalk(public[0].rows)
    for layer in public[1:]:
        places, crosswalk = places.unionByName(layer_index(layer)), crosswalk.unionByName(layer_crosswalk(layer.rows))
    ids = crosswalk.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in IDS])
    wrapped = B.wrap_bbox(F.struct("xmin", "ymin", "xmax", "ymax"))
    extent = A.union_bbox(places.where("xmin is not null").select(F.lit(1).alias("all"), wrapped.alias("b")).select("all", "b.*"), "all").drop("all")
    return Index(places, crosswalk, places.groupBy("collection").agg(F.count("*").alias("n")), ids, A.shared_ids(places), extent)
