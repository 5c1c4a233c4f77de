"""Quality rules: a decision list learned by sequential covering, in DataFrame functions only.

Rules are conjunctions of thresholds on text statistics, such as ``upper_ratio > 0.21 and rep_ratio > 0.4``. Each is
grown on two thirds of the labelled rows by the condition with the largest information gain, pruned on the other third,
and taken if it is precise enough there; the rows it covers are set aside and the next is grown. The list becomes an
ordered conditional expression that Spark evaluates with the scan: the first rule that holds drops the document, else it
is kept.

Every count that guides the learner is a grouped aggregation; the driver sees one row per candidate condition. The
learner reads at most ``SAMPLE`` labelled rows that pass the base rule, so that rules say what the base rule does not: those
with the lowest hash of their doc_id. Everything else covers all rows.

At scale: one scan of the texts and no shuffle of them; statistics of a text come from arrays of its own words, with
sorting where equal windows must meet, so a long text costs n log n. Windows of three words are compared by a 64-bit hash
within one text.

Defined results: a null text has no words and fails the base rule. Without labels, or with only one class of them, the
list is empty and the base rule alone decides. Repeated or contradictory labels of one doc_id are averaged, ties count as
good; labels that are null or not 0 or 1 are left out. Extra columns and clashing names do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import ROW, WS, stash, with_rows

SAMPLE = 20_000
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.97
MIN_COVER = 4
CUTS = 24
FEATURES = ("symbol_ratio", "bar_ratio", "upper_ratio", "rep_ratio", "dup_line_ratio", "digit_ratio")
Rule = list[tuple[str, str, float]]


def statistics(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id and the counts of the contract, with the ratios the rules use."""
    text = F.col("text")
    d = with_rows(docs, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("words", F.filter(F.split("text", f"[{WS}]+", -1), lambda w: w != ""))
    d = d.withColumn("lines", F.when(F.contains("text", F.lit("\n")), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{WS}]"))).otherwise(F.array().cast("array<string>")))
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, "")).cast("long")
    d = d.select(
        ROW, "doc_id", "words", F.size("words").cast("long").alias("n_words"), count(f"[{WS}]+").alias("word_chars"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"), count(r"[^|]+").alias("n_bars"), count(r"\P{Lu}+").alias("n_upper"), count(r"[^0-9]+").alias("n_digits"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size("lines").alias("n_lines"),
    )
    at = lambda i: F.get("words", i)
    hashes = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    d = d.withColumn("windows", F.when(F.col("n_words") >= 3, hashes).otherwise(F.array().cast("array<bigint>"))).drop("words")
    d = d.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    ranked = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("ranked", F.when(F.col("repeats"), ranked)).drop("windows")
    is_like = lambda x, j: F.coalesce(F.get("ranked", j)["h"] == x["h"], F.lit(False))
    sites = F.array_sort(F.transform(F.filter("ranked", lambda x, j: is_like(x, j - 1) | is_like(x, j + 1)), lambda x: x["i"]))
    d = d.withColumn("sites", sites).drop("ranked")
    covered = F.aggregate("sites", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")), lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")))
    d = d.withColumn("n_repeat_words", F.when(F.col("repeats"), covered["n"]).otherwise(F.lit(0)).cast("long")).drop("sites", "repeats")
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return d.withColumns({
        "mean_word": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "n_words"), "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "rep_ratio": per("n_repeat_words", "n_words"), "upper_ratio": per("n_upper", "word_chars"), "digit_ratio": per("n_digits", "word_chars"), "bar_ratio": per("n_bars", "n_words"),
    })


def holds(rule: Rule) -> Column:
    """The rule as a Column; an empty rule always holds."""
    return reduce(lambda a, b: a & b, [F.col(f) > t if op == ">" else F.col(f) <= t for f, op, t in rule], F.lit(True))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best_condition(rows: DataFrame, cuts: list[tuple[str, float]], rule: Rule) -> tuple[Rule, float, float]:
    """The rule with the best further condition, and the bad and good rows that it then covers."""
    inside = rows.where(holds(rule))
    wide = inside.select("bad", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("x")) for f in FEATURES])).alias("v"))
    cut = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(t).alias("t")) for f, t in cuts])
    each = wide.select("bad", "v.f", "v.x", F.explode(F.filter(cut, lambda c: c["f"] == F.col("v.f"))).alias("c")).select("bad", "f", "c.t", (F.col("x") > F.col("c.t")).alias("above"))
    counts = each.groupBy("f", "t", "above").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    total = inside.agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
    if not total or not total[0]:
        return rule, 0, 0
    best, found = 0.0, (rule, total[0], total[1])
    for r in sorted(counts, key=lambda r: (r["f"], r["t"], r["above"])):
        gain = _gain(r["p"], r["n"], total[0], total[1])
        if gain > best + 1e-9:
            best, found = gain, ([*rule, (r["f"], ">" if r["above"] else "<=", r["t"])], r["p"], r["n"])
    return ([*rule, _centred(inside, found[0][-1])], *found[1:]) if best else found


def _centred(rows: DataFrame, condition: tuple[str, str, float]) -> tuple[str, str, float]:
    """The condition with its threshold moved half way to where the bad rows that it covers begin, away from good ones."""
    f, op, t = condition
    begin = rows.where(holds([condition]) & (F.col("bad") == 1)).agg(F.percentile(f, F.lit(0.05 if op == ">" else 0.95))).first()[0]
    return f, op, (t + begin) / 2


def learn(labelled: DataFrame, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """The decision list. ``labelled`` has the features, ``bad`` (0 or 1) and ``grow`` (whether the row grows or prunes rules)."""
    at = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    found = [labelled.where(f"bad = {k}").agg(*[F.percentile(f, at).alias(f) for f in FEATURES]).first() for k in (0, 1)]
    cuts = sorted({(f, float(t)) for q in found for f in FEATURES for t in q[f] or []})
    rules: list[Rule] = []
    rows = labelled
    while cuts and len(rules) < max_rules:
        rule, p, n = [], 0, 1
        grow = rows.where("grow")
        while n and len(rule) < max_conditions:
            longer, p, n = _best_condition(grow, cuts, rule)
            if len(longer) == len(rule):
                break
            rule = longer
        if not rule:
            break
        shorter = [rule[: k + 1] for k in range(len(rule))]
        sums = [F.sum(F.when(holds(r), x).otherwise(0)) for r in shorter for x in (F.col("bad"), 1 - F.col("bad"))]
        held = [x or 0 for x in rows.where("not grow").agg(*sums).first()]
        score = lambda k: (held[2 * k] - held[2 * k + 1]) / max(1, held[2 * k] + held[2 * k + 1])  # noqa: E731, B023
        k = max(range(len(shorter)), key=lambda k: (score(k), -k))
        rule, p, n = shorter[k], held[2 * k], held[2 * k + 1]
        if p < min_cover or p / (p + n) < min_precision:
            break
        rules.append(rule)
        rows = rows.where(~holds(rule))
    return rules


def keeps(rules: list[Rule]) -> Column:
    """The ordered conditional expression: the first rule that holds drops the row."""
    if not rules:
        return F.lit(True)
    expression = F.when(holds(rules[0]), F.lit(False))
    for rule in rules[1:]:
        expression = expression.when(holds(rule), F.lit(False))
    return expression.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[Rule]]:
    """Statistics of all rows with ``base_failed`` and ``kept``, and the rules. ``labels`` has (doc_id, quality), 0 for bad."""
    rows = stash(statistics(docs), "statistics")
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg((F.avg("quality") < 0.5).cast("int").alias("bad"))
    place = F.xxhash64(F.col("doc_id"), F.lit(10))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    chosen = rows.where(~failed).join(known, "doc_id").select(*FEATURES, "bad", "doc_id", place.alias("place")).orderBy("place", "doc_id").limit(sample)
    rules = learn(stash(chosen.withColumn("grow", F.pmod("place", F.lit(3)) > 0), "labelled"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & keeps(rules)), rules


def op10(spark, sf_dir: str) -> DataFrame:
    rows, _ = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_counts(spark, sf_dir: str) -> DataFrame:
    """The base counts and the base rule alone, which SQL can express."""
    rows = statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') ws from d),
win as (select doc_id, unnest(range(1, len(ws) - 1)) i, ws from w where len(ws) >= 3),
g as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] g from win),
r as (select doc_id, i from g qualify count(*) over (partition by doc_id, g) > 1),
n as (select doc_id, count(distinct i + k) n_repeat_words from r, (values (0), (1), (2)) t(k) group by doc_id),
l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from d),
c as (
  select w.doc_id, cast(len(ws) as bigint) n_words, cast(len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) word_chars,
         cast(len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) n_symbols,
         cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines, coalesce(n.n_repeat_words, 0) n_repeat_words
  from w join l on w.doc_id = l.doc_id left join n on w.doc_id = n.doc_id)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from c
"""
