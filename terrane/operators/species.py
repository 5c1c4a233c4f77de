"""Species summaries of sites: names merged over ids, groups, subtrees, decades, suitability in cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_by_name(rows: DataFrame) -> DataFrame:
    """One row per place and name. ``rows`` has (place_id, aphiaid, name_key, n, year_min, year_max).

    A row without a name key stands for its own id. The best id is that of the row with most records, the smallest id
    of equal ones; ``ids`` come by summed records, then id.
    """
    keyed = rows.withColumn("key", F.coalesce("name_key", -F.col("aphiaid"))).withColumn("n", F.coalesce("n", F.lit(0)))
    by_id = keyed.groupBy("place_id", "key", "aphiaid").agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.min("year_min").alias("lo"), F.max("year_max").alias("hi"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "aphiaid")))
    return by_id.groupBy("place_id", "key").agg(
        F.sum("n").alias("n"), F.min("lo").alias("year_min"), F.max("hi").alias("year_max"),
        F.min(F.struct((-F.col("top")).alias("minus"), "aphiaid"))["aphiaid"].alias("best"), F.transform(ranked, lambda x: x["aphiaid"]).alias("ids"),
    )


def enrich_species(merged: DataFrame, lookup: DataFrame) -> DataFrame:
    """Name, class and red list code from the best id; the group from the first id, by records, that has one."""
    best = lookup.select(F.col("aphiaid").alias("best"), F.col("species").alias("name"), F.col("class"), "redlist")
    each = merged.select("place_id", "key", F.posexplode("ids").alias("pos", "aphiaid")).join(lookup.where("coalesce(eov, '') != ''").select("aphiaid", "eov"), "aphiaid")
    groups = each.groupBy("place_id", "key").agg(F.min_by("eov", "pos").alias("eov"))
    named = merged.join(best, "best", "left").join(groups, ["place_id", "key"], "left")
    return named.withColumn("name", F.coalesce("name", F.concat(F.lit("AphiaID "), F.col("best").cast("string"))))


def decade_rows(rows: DataFrame) -> DataFrame:
    """Rows by place, group and decade (null: all years) from (place_id, eov, year, n, species)."""
    d = rows.withColumn("decade", F.floor(F.col("year") / 10) * 10)
    grouped = d.groupingSets([["place_id", "eov", "decade"], ["place_id", "eov"], ["place_id", "decade"], ["place_id"]], "place_id", "eov", "decade")
    return grouped.agg(F.sum("n").alias("n"), F.count_distinct("species").alias("sp"), F.grouping("eov").alias("every"), F.grouping("decade").alias("whole")).select("place_id", F.when(F.col("every") == 1, "all").otherwise(F.col("eov")).alias("eov"), F.when(F.col("whole") == 0, F.col("decade")).alias("decade"), "n", "sp")


def decade_summary(rows: DataFrame) -> DataFrame:
    """One row per place: all years, decades with records, the latest of them, groups by species."""
    all_, dec = F.col("eov") == "all", F.col("decade")
    return rows.groupBy("place_id").agg(
        F.max(F.when(all_ & dec.isNull(), F.col("n"))).alias("n"), F.max(F.when(all_ & dec.isNull(), F.col("sp"))).alias("sp"),
        F.count_if(all_ & dec.isNotNull() & (F.col("n") > 0)).alias("n_decades"), F.max(F.when(all_ & (F.col("n") > 0), dec)).alias("latest"),
        F.max_by(F.when(all_, F.col("sp")), F.when(all_ & (F.col("n") > 0), dec)).alias("latest_sp"),
        F.array_sort(F.collect_list(F.when(~all_ & dec.isNull() & (F.col("sp") > 0), F.struct((-F.col("sp")).alias("minus"), "eov")))).alias("g"),
    ).withColumn("groups", F.array_join(F.transform("g", lambda x: x["eov"]), ",")).drop("g")


def species_counts(merged: DataFrame, latest: DataFrame) -> DataFrame:
    """Names of every year and of the latest decade. ``latest`` has (place_id, latest)."""
    return merged.join(latest, "place_id", "left").groupBy("place_id").agg(F.count("*").alias("all_names"), F.count_if(F.col("year_max") >= F.col("latest")).alias("latest_names"))


def counts_check(counts: DataFrame, summary: DataFrame) -> DataFrame:
    """Sites whose list and summary disagree."""
    return counts.join(summary, "place_id").where("all_names != sp").select("place_id", "all_names", "sp")


def group_chips(listed: DataFrame, selected: str, order: list[str]) -> DataFrame:
    """Names by group with a total first; the selected group stays at 0; equal counts in the fixed order, then by name."""
    sites = listed.select("place_id").distinct().withColumn("eov", F.lit(selected))
    counts = listed.where("coalesce(eov, '') != ''").groupBy("place_id", "eov").agg(F.count("*").alias("n"))
    total = listed.groupBy("place_id").agg(F.count("*").alias("n")).select("place_id", F.lit("all").alias("eov"), "n")
    every = counts.join(sites, ["place_id", "eov"], "full").withColumn("n", F.coalesce("n", F.lit(0)))
    fixed = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col("eov")), F.lit(0)), F.lit(len(order) + 1))
    w = Window.partitionBy("place_id").orderBy((F.col("eov") != "all").cast("int"), F.desc("n"), fixed, "eov")
    return total.unionByName(every).select("place_id", "eov", "n", F.row_number().over(w).alias("place"))


def in_subtree(merged: DataFrame, lineage: DataFrame, taxon: int) -> DataFrame:
    """Names any of whose ids has the taxon in its lineage. ``lineage`` has (id, lineage)."""
    ids = lineage.where(F.array_contains("lineage", taxon)).select("id")
    hit = merged.select("place_id", "key", F.explode("ids").alias("id")).join(ids, "id", "left_semi").select("place_id", "key").distinct()
    return merged.join(hit, ["place_id", "key"], "left_semi")


def first_values(values: DataFrame) -> DataFrame:
    """One positive value for each cell and species: the first by ``seq``, the lowest of equal ones."""
    return values.where("suit > 0").groupBy("cell", "species").agg(F.min(F.struct("seq", "suit"))["suit"].alias("suit"))


def cell_species(cells: DataFrame, values: DataFrame) -> DataFrame:
    """Per place and species: cells, share of the place's cells, highest and mean value. ``values`` has (cell, species, suit, seq).

    Of several values of one species in a cell the first by ``seq`` counts, the lowest of equal ones.
    """
    first = first_values(values)
    own = cells.select("place_id", "cell").distinct()
    totals = own.groupBy("place_id").agg(F.count("*").alias("total"))
    found = own.join(first, "cell").groupBy("place_id", "species").agg(F.count("*").alias("cells"), F.max("suit").alias("max_suit"), F.avg("suit").alias("mean_suit"))
    return found.join(totals, "place_id").withColumn("share", F.col("cells") / F.col("total")).drop("total")


def summary_line(n: Column, species: Column, latest: Column, latest_species: Column) -> Column:
    """One sentence, with thousands separators; the decade is left out when there is none."""
    tail = F.when(latest.isNotNull(), F.concat(F.lit("; in the "), latest.cast("string"), F.lit("s, "), F.format_number(latest_species, 0), F.lit(" species"))).otherwise("")
    return F.concat(F.format_number(n, 0), F.lit(" records of "), F.format_number(species, 0), F.lit(" species in every year"), tail, F.lit("."))
