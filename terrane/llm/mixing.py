"""Mixing sources to target weights by capped water-filling.

Each source's target is its weight's share of the total, but at most ``max_epochs`` times its own size; what a clamped
source cannot take is dealt to the others by weight until no target is above its cap. The water level has a closed form:
with sources ordered by cap / weight, the first k are clamped and the level is (total - caps of the k) / (weights of the
rest). Targets are then sampled: every document is taken floor(target / size) times, and one more time if it falls below
a cut of the seeded order of its source's documents. The cut lies where the running size comes nearest to what is missing.

At scale: one scan counts words; the thin table of (doc_id, source, size, order key) is kept. The cut is found by
histogram: sizes are summed for each of 4,096 ranges of the order key, and only the one range that holds the cut is
sorted, so a source with a third of all rows is never sorted as a whole. Copies are summed for each part of the table
first. Sources are one row each; that table is ordered in one task, so it is meant for sources by the million, not by the billion.

Defined results: a null text has size 0; a null source is a source of its own and comes last. A source whose size is 0
has target 0. Rows with null or repeated doc_ids are told apart by their texts; rows alike in both are copies, of which as many
get the extra repetition as the target asks for. An empty table gives no rows. Extra columns keep their names, whatever they
are. No document is taken more than ``max_epochs`` times. Reruns agree up to the choice among such copies, as the order key is a hash of seed, doc_id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import ROW, WS, keyed, own_columns, stash, with_rows

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
DIGITS = 3  # hexadecimal digits of the order key that name a range: 4,096 ranges


def word_count(text) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{WS}]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` has (source, source_size); adds ``target``. Weights repeat over the sources in code point order, null last."""
    order = Window.orderBy(F.isnull("source"), F.col("source"))
    whole = Window.partitionBy()
    place = F.row_number().over(order)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights)) + 1).cast("long")
    s = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(whole)).withColumn("weights", F.sum("weight").over(whole))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0))).cast("double") / (F.col("weights") - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))).cast("double"))
    # the source is clamped if the level reached when all before it are clamped lifts it above its cap
    clamped = F.col("level") * F.col("weight") >= F.col("cap")
    s = s.withColumn("open_level", F.min(F.when(~clamped, F.struct((F.col("cap") / F.col("weight")).alias("ratio"), F.col("place").alias("place"), F.col("level").alias("level")))).over(whole)["level"])
    target = F.when(clamped, F.col("cap").cast("double")).otherwise(F.col("open_level") * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, source, size, source_size, target and ``times``, how often the mix takes it."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), given("doc_id"), F.lit(":"), F.md5(given("text"))))
    thin = stash(with_rows(docs, "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), key.alias("key")), "sizes")
    thin = thin.withColumn("bin", F.substring("key", 1, DIGITS)).withColumn("part", F.shiftright(ROW, 33))
    bins = stash(thin.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "bins")
    goals = targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, max_epochs)
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goals = stash(goals.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "goals")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    running = lambda *keys: Window.partitionBy("source").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ranges = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(running("bin")), F.lit(0)))
    ranges = ranges.join(goals, same(ranges, goals)).select(ranges["source"], "bin", "before", "bin_size", "source_size", "target", "whole", "need")
    rows = thin.join(ranges, same(thin, ranges) & (thin["bin"] == ranges["bin"])).select(ROW, "doc_id", thin["source"], "size", "key", "part", thin["bin"], "before", "bin_size", "source_size", "target", "whole", "need")
    decided = rows.where("before + bin_size <= need or before > need").withColumn("extra", F.col("before") + F.col("bin_size") <= F.col("need"))
    cut = rows.where("not (before + bin_size <= need or before > need)")  # one range of each source
    # rows of one key are copies of one another; they are counted by key and part of the table, so that many copies are not sorted in one task
    copies = cut.groupBy("source", "key", "part").agg(F.sum("size").alias("part_size"))
    copies = copies.select("source", "key", "part", F.coalesce(F.sum("part_size").over(running("key", "part")), F.lit(0)).alias("ahead"))
    turn = F.row_number().over(Window.partitionBy("source", "key", "part").orderBy(ROW))
    cut = cut.withColumn("turn", turn).join(copies.withColumnsRenamed({"source": "of", "key": "k", "part": "p"}), F.col("source").eqNullSafe(F.col("of")) & (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")))
    run = F.col("before") + F.col("ahead") + F.col("turn") * F.col("size")
    cut = cut.withColumn("extra", 2 * run - F.col("size") <= 2 * F.col("need")).drop("turn", "of", "k", "p", "ahead")
    return decided.unionByName(cut).select(ROW, "doc_id", "source", "size", "source_size", "target", (F.col("whole") + F.when(F.col("extra") & (F.col("whole") < max_epochs), 1).otherwise(0)).alias("times"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: dropped at 0 repetitions, repeated at several."""
    docs = keyed(docs)
    times = taken_words(docs, weights, max_epochs, seed).where("times > 0")
    turns = times.select(ROW, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("turn")).select(ROW)
    return own_columns(docs.join(turns, ROW))


def op8(spark, sf_dir: str) -> DataFrame:
    rows = taken_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size,
         md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, 'null'))) k
  from documents
), s as (
  select source, cast(sum(size) as bigint) source_size from d group by source
), p as (
  select *, row_number() over (order by source is null, source) place, 3 * source_size cap from s
), w as (
  select *, case (place - 1) % 3 when 0 then 5 when 1 then 2 else 1 end weight from p
), l as (
  select *, cast(sum(source_size) over () - coalesce(sum(cap) over r, 0) as double)
            / cast(sum(weight) over () - coalesce(sum(weight) over r, 0) as double) lvl
  from w window r as (order by cast(cap as double) / weight, place rows between unbounded preceding and 1 preceding)
), o as (
  select *, lvl * weight >= cap clamped from l
), lv as (
  select lvl open_level from o where not clamped order by cast(cap as double) / weight, place limit 1
), t as (
  select source, source_size, case when clamped then cast(cap as double) else (select open_level from lv) * weight end target from o
), n as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end whole from t
), x as (
  select d.doc_id, d.size, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size need,
         sum(d.size) over (partition by d.source order by d.k rows unbounded preceding) run
  from d join n on d.source is not distinct from n.source
)
select doc_id, size, source_size, target,
       cast(size * (whole + case when whole < 3 and 2 * run - size <= 2 * need then 1 else 0 end) as bigint) taken
from x
"""
