"""The check of a built collection: all its problems in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators import geometry as G
from terrane.operators import rows as R
from terrane.operators.aggregates import problems

BOX = ("xmin", "ymin", "xmax", "ymax")


def check_collection(sites: DataFrame, vertices: DataFrame, patterns: list[str], license_: str, kind: str, filled: tuple[str, ...] = ("name", "status", "license"), tolerance: float = 1e-6) -> DataFrame:
    """(rule, n): how many rows break each rule; a rule that none breaks has n 0.

    ``sites`` has (place_id, geom_type, xmin, ymin, xmax, ymax), ``license`` and the columns of ``filled``; ``vertices`` are
    their geometries. If columns are missing, only these are told, as rules ``missing <column>``. ``repeated_id`` counts ids,
    all other rules rows, so a repeated row counts twice. A null id matches no pattern and has no geometry; null texts are
    empty; an empty table breaks no rule. Measures are taken over edges, and sites meet them in one join on ``place_id``.
    """
    missing = [c for c in ("place_id", "geom_type", *BOX, "license", *filled) if c not in sites.columns]
    if missing:
        return sites.sparkSession.createDataFrame([(f"missing {c}", 1) for c in dict.fromkeys(missing)], "rule string, n bigint")
    found = G.validity_audit(vertices).select("place_id", (F.col("open") + F.col("short") + F.col("flat") + F.col("broken") + F.col("crossing") > 0).alias("__invalid"), (F.col("jumps") > 0).alias("__jumps"))
    bounds = vertices.groupBy("place_id").agg(F.min("x").alias("__xmin"), F.min("y").alias("__ymin"), F.max("x").alias("__xmax"), F.max("y").alias("__ymax"))
    own = sites.select(*dict.fromkeys(("place_id", "geom_type", *BOX, "license", *filled)))
    d = own.join(bounds.join(found, "place_id"), "place_id", "left")
    off = [F.coalesce(F.abs(F.col(c) - F.col(f"__{c}")) > tolerance, F.col(f"__{c}").isNotNull()) for c in BOX]
    rules = {
        "bad_id": ~R.matches_ids(F.col("place_id"), patterns),
        **{f"empty_{c}": F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in filled},
        "other_license": ~F.col("license").eqNullSafe(license_),
        "other_kind": ~F.col("geom_type").eqNullSafe(kind),
        "no_geometry": F.col("__xmin").isNull(),
        "invalid": F.coalesce("__invalid", F.lit(False)),
        "jumps": F.coalesce("__jumps", F.lit(False)),
        "outside": F.coalesce((F.col("__xmin") < -180) | (F.col("__xmax") > 180) | (F.col("__ymin") < -90) | (F.col("__ymax") > 90), F.lit(False)),
        "other_box": off[0] | off[1] | off[2] | off[3],
    }
    repeated = R.duplicate_ids(own.select("place_id")).agg(F.count("*").alias("n")).select(F.lit("repeated_id").alias("rule"), "n")
    return problems(d, rules).unionByName(repeated)


def check_contributions(new: DataFrame, vertices: DataFrame, existing: DataFrame, kinds: list[str], licences: list[str], vertex_cap: int = 100_000) -> DataFrame:
    """(dir, errors, warnings, ok): one row for each of ``new``, which is accepted if it has no error.

    ``new`` has (dir, name, place_type, license, attribution, contributor_orcid, source_url), ``vertices`` the polygons with
    ``dir`` as ``place_id``, ``existing`` (name, place_type). Null and blank texts are missing; orcid and URL may be missing.
    A geometry has one error at most, the first of no_geometry, no_numbers, vertices, degrees, flat, and warnings only if it
    has none. A name collides with an existing one of its type or with any other row of ``new``. A null dir is an error and
    has no geometry; extra columns are left out.
    """
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    same = F.regexp_replace(F.lower(text("name")), r"\s+", " ").alias("__name")
    bad = F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y")
    reach = vertices.where("place_id is not null").groupBy("place_id").agg(F.count("*").alias("n"), F.max(bad).alias("bad"), F.max(F.abs("x")).alias("lon"), F.max(F.abs("y")).alias("lat"))
    fault = F.when(F.col("bad"), "no_numbers").when(F.col("n") > vertex_cap, "vertices").when((F.col("lat") > 90) | (F.col("lon") > 360), "degrees")
    measured = reach.select("place_id", fault.alias("fault"), (F.col("lon") > 180).alias("far"))
    sound = vertices.join(measured.where("fault is null").select("place_id"), "place_id", "left_semi")
    e = G.edges(sound)
    turned = ((F.col("ring") == 0) & (F.col("area") < 0)) | ((F.col("ring") > 0) & (F.col("area") > 0))
    rings = G.ring_areas(e).groupBy("place_id").agg(F.max(turned).alias("turned"), (F.max(F.abs("area")) < 1e-12).alias("flat"))
    spans = e.groupBy("place_id").agg((F.max(F.abs(F.col("xb") - F.col("xa"))) > 180).alias("jumps"))
    crossed = G.crossings(e).select("place_id", F.lit(True).alias("crossed")).distinct()
    shapes = measured.join(rings, "place_id", "left").join(spans, "place_id", "left").join(crossed, "place_id", "left")
    geometry = F.when(F.col("found").isNull(), "no_geometry").otherwise(F.coalesce("fault", F.when(F.coalesce("flat", F.lit(True)), "flat")))
    shapes = shapes.select(F.col("place_id").alias("dir"), F.lit(True).alias("found"), "fault", "flat", "turned", "crossed", (F.col("far") | F.col("jumps")).alias("split"))

    rows = new.select("dir", "name", "place_type", "license", "attribution", "contributor_orcid", "source_url", same)
    keys = rows.select("place_type", "__name").unionByName(existing.select("place_type", same))
    used = keys.groupBy("place_type", "__name").agg((F.count("*") > 1).alias("__used"))
    d = rows.join(used, ["place_type", "__name"], "left").join(shapes, "dir", "left").withColumn("geometry", geometry)

    def listed(rules):
        return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))

    unfit = lambda c, pattern: (text(c) != "") & ~text(c).rlike(pattern)
    errors = {
        "dir": ~F.coalesce(F.col("dir").rlike("^OM-[0-7][0-9A-HJKMNP-TV-Z]{25}$"), F.lit(False)),
        "name": text("name") == "",
        "place_type": ~text("place_type").isin(kinds),
        "license": ~text("license").isin(licences),
        "attribution": text("attribution") == "",
        "orcid": unfit("contributor_orcid", r"^\d{4}-\d{4}-\d{4}-\d{3}[\dX]$"),
        "source_url": unfit("source_url", r"^https?://\S+$"),
    }
    fit = F.col("geometry").isNull()
    warnings = {"winding": fit & F.col("turned"), "repair": fit & F.col("crossed"), "split": fit & F.col("split"), "name_used": (F.col("__name") != "") & F.col("__used")}
    told = d.select("dir", F.array_compact(F.concat(listed(errors), F.array("geometry"))).alias("errors"), listed(warnings).alias("warnings"))
    return told.withColumn("ok", F.size("errors") == 0)
