"""Row operators of a place table: filters with counts, renaming, coercion, ids, order, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.text import lease_number, norm_name, slug, squash, template, text

#: The common columns of a place table, in order.
COMMON = ("place_id", "name", "authority", "source_id", "place_type", "geom_type", "status", "status_source", "status_date", "status_history", "upstream_status", "source_url", "source_date", "retrieved", "license", "attribution", "version")
RESERVED = {*COMMON, "component", "bbox", "geometry"}


# filters ----
def first_rule(rules: dict[str, list]) -> Column:
    """The first rule, in order, whose field holds one of its values as text; null if none."""
    whens = [F.when(F.col(f).cast("string").isin([str(v) for v in values]), F.lit(f)) for f, values in rules.items()]
    return F.coalesce(*whens) if whens else F.lit(None).cast("string")


def exclude(df: DataFrame, rules: dict[str, list]) -> DataFrame:
    return df.where(first_rule(rules).isNull())


def exclude_counts(df: DataFrame, rules: dict[str, list]) -> DataFrame:
    """Rows that each rule drops; a row counts for its first rule."""
    return df.select(first_rule(rules).alias("rule")).where("rule is not null").groupBy("rule").agg(F.count("*").alias("n"))


def matches_all(rules: dict[str, list]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(f).cast("string").isin([str(v) for v in values]), F.lit(False)) for f, values in rules.items()], F.lit(True))


def include(df: DataFrame, rules: dict[str, list]) -> DataFrame:
    return df.where(matches_all(rules))


def include_left_out(df: DataFrame, rules: dict[str, list]) -> DataFrame:
    return df.agg(F.count_if(~matches_all(rules)).alias("left_out"), F.count_if(matches_all(rules)).alias("kept"))


def is_marine(kind: Column, percent: Column) -> Column:
    """Unknown kind, kinds 0 and 2, or any marine share."""
    return kind.isNull() | kind.isin(0, 2) | F.coalesce(percent > 0, F.lit(False))


def marine_filter(df: DataFrame, kind: str, percent: str) -> DataFrame:
    return df.where(is_marine(F.col(kind), F.col(percent)))


def marine_counts(df: DataFrame, kind: str, percent: str) -> DataFrame:
    keep = is_marine(F.col(kind), F.col(percent))
    return df.agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("inland"))


def listed(df: DataFrame, access: str = "access") -> DataFrame:
    return df.where(F.coalesce(F.col(access), F.lit("public")) != "unlisted")


def polygon_layers(df: DataFrame) -> DataFrame:
    return df.where(F.lower("geom_type").contains("polygon") & F.col("place_type").isNotNull())


def bbox_window(df: DataFrame, w: float, s: float, e: float, n: float) -> DataFrame:
    return df.where((F.col("xmin") <= e) & (F.col("xmax") >= w) & (F.col("ymin") <= n) & (F.col("ymax") >= s))


def place_lookup(df: DataFrame, place_id: str) -> DataFrame:
    return df.where(F.col("place_id") == place_id)


def matches_text(hay: Column, query: str) -> Column:
    """Every word of the query is somewhere in the text, in any case."""
    return reduce(lambda a, w: a & F.lower(hay).contains(w), query.lower().split(), F.lit(True))


def matches_ids(c: Column, patterns: list[str]) -> Column:
    return F.coalesce(reduce(lambda a, p: a | c.rlike(f"^(?:{p})$"), patterns, F.lit(False)), F.lit(False))


def over_budget(df: DataFrame, cell: float, per_part: int, total: int) -> DataFrame:
    """Sites whose boxes need too many grid cells, for one part or in all. ``df`` has (place_id, xmin, ymin, xmax, ymax)."""
    cells = F.ceil((F.col("xmax") - F.col("xmin")) / cell) * F.ceil((F.col("ymax") - F.col("ymin")) / cell)
    sums = df.groupBy("place_id").agg(F.sum(cells).alias("cells"), F.max(cells).alias("largest"))
    return sums.withColumn("over", (F.col("cells") > total) | (F.col("largest") > per_part))


# columns ----
def rename_natives(df: DataFrame) -> DataFrame:
    """Columns whose names collide with a common one, ignoring case, get ``_src``."""
    return df.withColumnsRenamed({c: f"{c}_src" for c in df.columns if c.lower() in RESERVED})


def coerced(c: Column, kind: str) -> Column:
    """A native value as int, float, bool, date or string; what does not parse is null, as is NaN."""
    v = c.cast("string")
    if kind == "int":
        number = v.try_cast("double")
        return F.when(~F.isnan(number), number.try_cast("bigint"))
    if kind == "float":
        number = v.try_cast("double")
        return F.when(~F.isnan(number), number)
    if kind == "bool":
        return v.try_cast("boolean")
    if kind == "date":
        millis = F.when(v.rlike(r"^-?\d+$"), F.timestamp_millis(v.try_cast("bigint")))
        return F.coalesce(millis, F.try_to_timestamp(F.regexp_replace(v, "Z$", "+00:00")))
    return v


def coerce(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({name: coerced(F.col(name), kind) for name, kind in kinds.items()})


def stamp_common(df: DataFrame, config: dict, edit_day: Column, retrieved: Column) -> DataFrame:
    """Constant and templated common columns; the source date is the edit day, else the retrieval day."""
    return df.withColumns({
        "place_id": template(config["id"]), "name": template(config["name"]), "authority": F.lit(config["authority"]), "place_type": F.lit(config["place_type"]),
        "license": F.lit(config["license"]), "attribution": squash(F.lit(config["attribution"])), "version": F.lit(config.get("version")),
        "source_date": F.coalesce(edit_day.cast("date"), retrieved.cast("date")), "retrieved": retrieved.cast("timestamp"),
    })


def precedence(*columns: Column) -> Column:
    """The first that is not blank."""
    return F.coalesce(*map(squash, columns))


def pick_geom_type(row: Column, declared: Column, computed: Column) -> Column:
    """The row's own type, else the declared one if it is of the computed kind, else the computed one."""
    family = lambda t: F.when(t.contains("Point"), "point").when(t.contains("Line"), "line").otherwise("polygon")
    fits = declared.isNotNull() & (computed.isNull() | (family(computed) == family(declared)))
    return F.coalesce(row, F.when(fits, declared).otherwise(F.coalesce(computed, declared)))


def annotate(df: DataFrame, columns: dict[str, Column], drop: str | None = None) -> DataFrame:
    """New columns in front; a native column that one replaces goes."""
    rest = [c for c in df.columns if c != drop and c not in columns]
    return df.select(*[c.alias(n) for n, c in columns.items()], *rest)


def pick_col(df: DataFrame, candidates: list[str]) -> Column:
    """The first non-null of the columns that exist, ignoring case; null if none exists."""
    have = {c.lower(): c for c in df.columns}
    found = [F.col(have[c.lower()]).cast("string") for c in candidates if c.lower() in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def column_problems(df: DataFrame, required: list[str]) -> DataFrame:
    """(column, problem, n): required columns that are missing, names that collide ignoring case, and required columns that are null or blank in ``n`` rows. One scan."""
    lower = [c.lower() for c in df.columns]
    twice = {c for c in lower if lower.count(c) > 1}
    found = [(c, df.columns[lower.index(c.lower())]) for c in required if c.lower() in lower and c.lower() not in twice]
    lacking = [F.struct(F.lit(c).alias("column"), F.lit("blank").alias("problem"), F.count_if(squash(F.col(f"`{own}`").cast("string")).isNull()).alias("n")) for c, own in found]
    shape = [(c, "missing") for c in required if c.lower() not in lower] + [(c, "collides") for c in sorted(twice)]
    wrong = [F.struct(F.lit(c).alias("column"), F.lit(problem).alias("problem"), F.count("*").alias("n")) for c, problem in shape]
    return df.agg(F.array(*lacking, *wrong).alias("p")).select(F.inline("p")).where("problem != 'blank' or n > 0")


def legacy_fill(df: DataFrame, types: DataFrame) -> DataFrame:
    """Place types by (collection, id prefix) where they are missing, and titles that are missing or only a slug."""
    prefix = F.split_part("place_id", F.lit(":"), F.lit(1))
    filled = df.withColumn("prefix", prefix).join(types.select("collection", "prefix", F.col("place_type").alias("usual")), ["collection", "prefix"], "left")
    title = F.when(F.col("title").isNull() | (F.col("title") == slug("title")), F.initcap(F.regexp_replace("collection", "[_-]+", " "))).otherwise(F.col("title"))
    return filled.withColumn("place_type", F.coalesce("place_type", "usual")).withColumn("title", title).drop("usual", "prefix")


def grid_variables(collections: DataFrame) -> DataFrame:
    """One row per data variable of each gridded dataset, helpers left out. ``collections`` has (collection, title, variables map)."""
    each = collections.select("collection", "title", F.explode(F.map_entries("variables")).alias("v"))
    return each.where(~F.lower("v.key").rlike(r"(mask|count|error|quality|flag|_qc$|_n$)")).select("collection", "title", F.col("v.key").alias("variable"), F.col("v.value").alias("unit"))


# ids ----
def suffixed(df: DataFrame, id_: str, label: Column, *order: Column) -> DataFrame:
    """Adds ``unique_id``: the first row of an id keeps it, others get the label's slug, and its repeats a number."""
    by_id = Window.partitionBy(id_).orderBy(*order)
    base = F.concat(F.col(id_), F.lit(":"), F.coalesce(F.nullif(slug(label), F.lit("")), F.lit("part")))
    ranked = df.withColumn("_rank", F.row_number().over(by_id)).withColumn("_base", F.when(F.col("_rank") > 1, base).otherwise(F.col(id_)))
    again = F.row_number().over(Window.partitionBy(id_, "_base", F.col("_rank") > 1).orderBy("_rank"))
    name = F.when((F.col("_rank") == 1) | (again == 1), F.col("_base")).otherwise(F.concat("_base", F.lit("-"), again.cast("string")))
    return ranked.withColumn("unique_id", name).drop("_rank", "_base")


def lease_ids(df: DataFrame, number: str, kind: str, object_id: str) -> DataFrame:
    """Ids by lease number; of one lease the commercial polygon, then the lowest object id, keeps the bare id."""
    d = df.withColumn("lease_id", F.concat(F.lit("BOEM:"), lease_number(number)))
    commercial = F.when(F.lower(F.coalesce(F.col(kind), F.lit("commercial"))).contains("commercial"), 0).otherwise(1)
    return suffixed(d, "lease_id", F.coalesce(F.col(kind), F.lit("part")), commercial, F.coalesce(F.col(object_id), F.lit(0)))


def template_ids(df: DataFrame, pattern: str, lowest: str) -> DataFrame:
    """Ids by template; of equal ids the lowest ``lowest`` keeps it, nulls last."""
    return suffixed(df.withColumn("template_id", template(pattern)), "template_id", F.lit("part"), F.col(lowest).asc_nulls_last())


def assign_parts(df: DataFrame, id_: str, label: Column, *order: Column) -> DataFrame:
    """Only the suffix that W-1 adds, null for the first."""
    d = suffixed(df, id_, label, *order)
    return d.withColumn("part", F.nullif(F.expr(f"substring(unique_id, length({id_}) + 2)"), F.lit(""))).drop("unique_id")


def duplicate_ids(df: DataFrame, id_: str = "place_id") -> DataFrame:
    return df.groupBy(id_).agg(F.count("*").alias("n")).where("n > 1")


# unions and sets ----
def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """All source layers with a ``component`` column; a column with two types is an error."""
    types: dict[str, str] = {}
    for name, df in parts.items():
        for c, t in df.dtypes:
            if types.setdefault(c.lower(), t) != t:
                raise TypeError(f"{name}: column {c} is {t}, elsewhere {types[c.lower()]}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("component", F.lit(n)) for n, df in parts.items()])


def except_keys(reference: DataFrame, df: DataFrame, key: str) -> DataFrame:
    return reference.select(key).subtract(df.select(key))


def intersect_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def distinct_in_order(*columns: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(*columns)))


def retire(catalog: DataFrame, slugs: DataFrame) -> DataFrame:
    """Every child with whether it stays, and a row for each slug that is not in the catalog."""
    gone = slugs.select(F.col("slug").alias("gone")).distinct()
    both = catalog.join(gone, catalog["slug"] == gone["gone"], "full")
    return both.select(F.coalesce("slug", "gone").alias("slug"), F.when(F.col("slug").isNull(), "unknown").when(F.col("gone").isNotNull(), "retired").otherwise("kept").alias("state"))


def distinct_providers(providers: Column, roles: list[str]) -> Column:
    """Names of providers with one of the roles, first seen first."""
    some = F.filter(providers, lambda p: F.arrays_overlap(p["roles"], F.array(*map(F.lit, roles))))
    return F.array_distinct(F.transform(some, lambda p: p["name"]))


# order ----
def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(listing: DataFrame, cursor: str, size: int) -> DataFrame:
    """Keys after the cursor, one page of them."""
    return listing.where(F.col("key") > cursor).orderBy("key").limit(size)


def page_numbers(listing: DataFrame, size: int, key: str = "key", within: str = "folder") -> DataFrame:
    return listing.withColumn("page", F.floor((F.row_number().over(Window.partitionBy(within).orderBy(key)) - 1) / size))


def row_groups(df: DataFrame, groups: int, key: str, within: str) -> DataFrame:
    """The layout that ``groups`` row groups per part would give: rows, first and last key of each."""
    size = F.ceil(F.count("*").over(Window.partitionBy(within)) / groups)
    g = F.floor((F.row_number().over(Window.partitionBy(within).orderBy(key)) - 1) / size)
    return df.select(within, key, g.alias("row_group")).groupBy(within, "row_group").agg(F.count("*").alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def same_names(new: DataFrame, existing: DataFrame, name: str = "name", kind: str = "place_type") -> DataFrame:
    """Rows of ``new`` whose normalised name and type exist already."""
    keyed = lambda df: df.withColumn("_name", norm_name(name))
    return keyed(new).join(keyed(existing).select("_name", kind).distinct(), ["_name", kind], "left_semi").drop("_name")
