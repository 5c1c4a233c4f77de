"""Audit of how far the vocabularies of sources diverge, by count-level bitmaps.

Each language keeps the terms found in enough of its documents. A group (language, source) gives each kept term a share
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being the group's occurrences of kept terms and V their number. Two groups
diverge by the sum over all kept terms of f = floor((p - q)^2 / (p + q)). As p only depends on the count, the sum runs over
cells (count here, count there) and not over terms: kept terms get numbers, 64 to a word; for each (group, count) a word
holds one bit for each term with that count. AND and a population count give the terms of each joint cell, which f
multiplies. Cells with a zero on one side follow by complement. Written as deviations from zero,

    sum = V f(0,0) + sum over counts c of one side T(c) (f(c,0) - f(0,0)) + the same of the other side
          + sum over joint cells n(c,d) (f(c,d) - f(c,0) - f(0,d) + f(0,0)),

only cells that occur are ever made. All arithmetic is exact, in integers.

At scale: one scan counts terms inside tasks, in tables that are flushed at a bounded size, so a source with a third of all
rows is summed before it is shuffled. Terms are numbered by range of language and frequency, so terms of like counts share
words and a word has few levels; no task sees a whole language. A joint cell is an equi-join on (language, word), whose
rows are at most the kept terms that both sources have; the result itself has a row for each pair of sources of a language.
The ten leading terms are cut in each task before they are shuffled.

Defined results: null text, language and source are empty. Rows are documents, so a repeated row counts twice. Groups
without terms are kept, with the counts 0; where a language keeps no term, each value is 0. Ties follow the items in order
of their bytes. Extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm import textarrays as A
from terrane.llm.common import stash

LEAST_DOCUMENTS = 10
TOP = 10
UNIT = 1_000_000_000
KEEP_TERMS = 400_000  # rows that a task gathers before it hands them on
SLICE = 4 << 20
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and of code points beyond ASCII, A to Z in lower case."""
    return text.translate(_LETTERS).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of ``docs`` (lang, source, text): occurrences and documents of each term. A row without a term stands for each group."""
    schema = "lang string, source string, term string, n long, docs long"
    kinds = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))

    def run(batches):
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush():
            for (lang, source), (n, found) in groups.items():
                size = len(n) + 1
                yield pa.RecordBatch.from_arrays([pa.array([lang] * size), pa.array([source] * size), pa.array([None, *n], pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(found.__getitem__, n)], pa.int64())], schema=kinds)
            groups.clear()

        for batch in A.slices(batches, "text", SLICE):
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for key, data in zip(keys, batch.column("text").to_pylist(), strict=True):
                n, found = groups.setdefault(key, (Counter(), Counter()))
                words = terms(data)
                n.update(words)
                found.update(set(words))
            if sum(len(n) for n, _ in groups.values()) > KEEP_TERMS:
                yield from flush()
        yield from flush()

    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    return rows.mapInArrow(A.tidy(run), schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, width: str = "width") -> Column:
    """p of a count, from column names or SQL. Null where a language keeps no term."""
    return F.expr(f"1 + cast((cast({UNIT} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div cast(nullif({total} + 2 * {width}, 0) as decimal(20,0)) as bigint)")


def apart(p: str, q: str) -> str:
    """f of two shares, as SQL."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


class Levels:
    """The counted terms of a table of documents, kept terms only, and what pairs and leading terms are made of."""

    def __init__(self, docs: DataFrame, least: int = LEAST_DOCUMENTS):
        counted = stash(term_counts(docs), "terms")
        found = counted.where("term is not null")
        kept = found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
        order = ["lang", F.desc("lang_n"), "term"]
        kept = stash(kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()), "kept")
        #: (lang, source, term, n, lang_n, word, bit)
        self.cells = stash(found.drop("docs").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", F.shiftright("id", 6).alias("word"), F.expr("cast(id & 63 as int)").alias("bit")), "cells")
        langs = kept.groupBy("lang").agg(F.count("*").alias("width"), F.sum("lang_n").alias("lang_total"))
        totals = self.cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counted.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "width", "lang_total"])
        #: (lang, source, total, width, lang_total, zero): one row for each group; ``zero`` is the share of a term that it lacks
        self.groups = stash(groups.withColumn("zero", share("0", "total")), "groups")

    def levels(self) -> DataFrame:
        """(lang, source, word, p, zero, bits): for each group, word of 64 terms and count the terms with that count."""
        bits = self.cells.groupBy("lang", "source", "word", "n").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        return bits.join(self.groups, ["lang", "source"]).select("lang", "source", "word", "n", share("n", "total").alias("p"), "zero", "bits")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value): the divergence of each ordered pair of sources of a language."""
        levels = stash(self.levels(), "levels")
        one, two = (levels.select("lang", "word", *[F.col(c).alias(f"{c}{k}") for c in ("source", "p", "zero", "bits")]) for k in (1, 2))
        met = one.join(two, ["lang", "word"]).where("source1 < source2 and (bits1 & bits2) != 0")
        deviation = f"bit_count(bits1 & bits2) * ({apart('p1', 'p2')} - {apart('p1', 'zero2')} - {apart('zero1', 'p2')} + {apart('zero1', 'zero2')})"
        joint = met.groupBy("lang", "source1", "source2").agg(F.sum(F.expr(deviation)).alias("value"))
        sizes = levels.groupBy("lang", "source", "n").agg(F.sum(F.expr("bit_count(bits)")).alias("terms"), F.first("p").alias("p1"), F.first("zero").alias("zero1"))
        others = self.groups.select("lang", F.col("source").alias("source2"), F.col("zero").alias("zero2"), "width")
        one_sided = sizes.withColumnRenamed("source", "source1").join(others, "lang").where("source1 != source2")
        marginal = one_sided.groupBy("lang", "source1", "source2").agg(F.sum(F.expr(f"terms * ({apart('p1', 'zero2')} - {apart('zero1', 'zero2')})")).alias("value"))
        both = self.groups.select("lang", F.col("source").alias("source1"), F.col("zero").alias("zero1")).join(others, "lang").where("source1 < source2")
        base = both.select("lang", "source1", "source2", F.coalesce(F.expr(f"width * ({apart('zero1', 'zero2')})"), F.lit(0)).alias("value"))
        all_parts = joint.unionByName(marginal).unionByName(base)
        ends = F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("source1", "source2"), ("source2", "source1"))])
        return all_parts.select("lang", F.explode(ends).alias("e"), "value").groupBy("lang", "e.source", "e.item").agg(F.sum("value").alias("value"))

    def leading(self, top: int = TOP) -> DataFrame:
        """(lang, source, item, value, rank): the terms that stand out most in each group against its language."""
        shares = self.cells.join(self.groups, ["lang", "source"]).select("lang", "source", "term", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q"))
        rows = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value"))
        return ranked(rows).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """Pairs of sources and leading terms of each group: (lang, source, part, item, value, rank)."""
    made = Levels(docs, least)
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = ranked(made.pairs()).withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionByName(made.leading(top).withColumn("part", F.lit("term")).select(*columns))


def op12(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
with d as (
  select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') w
  from documents
), o as (
  select r, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') term from (select r, lang, source, unnest(w) x from d)
), k as (
  select lang, term, count(*)::hugeint lang_n from o group by all having count(distinct r) >= 10
), c as (
  select o.lang, source, term, count(*)::hugeint n from o join k using (lang, term) group by all
), g as (
  select g.lang, g.source, coalesce(t.n, 0)::hugeint total, coalesce(v.v, 0)::hugeint v, coalesce(v.lang_total, 0)::hugeint lang_total
  from (select distinct lang, source from d) g
  left join (select lang, source, sum(n) n from c group by all) t using (lang, source)
  left join (select lang, count(*) v, sum(lang_n) lang_total from k group by all) v using (lang)
), s as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // (total + 2 * v) p, 1 + 1000000000 * (lang_n + 2) // (lang_total + 2 * v) q
  from g join k using (lang) left join c using (lang, source, term)
), pair as (
  select g.lang, g.source, h.source item, coalesce(x.value, 0) value
  from g join g h on g.lang = h.lang and g.source != h.source
  left join (
    select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) value
    from s a join s b on a.lang = b.lang and a.term = b.term and a.source != b.source group by all
  ) x on x.lang = g.lang and x.source = g.source and x.item = h.source
), term as (
  select lang, source, term item, (p - q) * (p - q) // (p + q) value from s where n > 0 and p > q
), ranked as (
  select lang, source, 'pair' part, item, value, row_number() over (partition by lang, source order by value desc, item) rank from pair
  union all
  select * from (select lang, source, 'term' part, item, value, row_number() over (partition by lang, source order by value desc, item) rank from term) where rank <= 10
)
select lang, source, part, item, cast(value as bigint) value, cast(rank as integer) rank from ranked
"""
