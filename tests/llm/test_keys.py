"""Null and repeated doc_ids, and columns that bear the names that operators use inside."""

from __future__ import annotations

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from terrane.llm import exact_dedup, language_id, line_dedup, mixing, near_dedup, quality_rules, secret_scan, sentencepiece_codec, substring_dedup, suffix_dedup, token_counts
from terrane.llm.common import keyed, own_columns

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(2, 6)))
    base = [" ".join(word() for _ in range(70)) for _ in range(6)]
    return [*base, base[0], base[1] + " " + base[2], base[3].replace("a", "b", 1), "token=abcdef123456 " + base[4], None, "", base[0], base[5] + "\n" + base[5]]


def documents(spark, texts, ids):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in zip(ids, texts, strict=True)], SCHEMA).coalesce(2)


OPERATORS = {
    "op1": (lambda d: sentencepiece_codec.encode(d), ("ids",)),
    "op2": (lambda d: exact_dedup.groups(d), ("group_size", "text_sha256")),
    "op3": (lambda d: near_dedup.classes(d), ("class_size", "kept")),
    "op4": (lambda d: secret_scan.scan(d), ("base", "spans")),
    "op5": (lambda d: language_id.identify(d), ("language", "confidence", "kept")),
    "op9": (lambda d: substring_dedup.repeats(d), ("n_words", "n_removed", "kept_sha256")),
    "op10": (lambda d: quality_rules.statistics(d), ("n_words", "n_repeat_words")),
    "op13": (lambda d: token_counts.prefix_counts(d), ("counts",)),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("ids", ["null", "repeated"])
def test_ids_do_not_matter(spark, texts, name, ids):
    """These results do not hang on the ids: with null or repeated ones they are as with ids of their own."""
    operator, columns = OPERATORS[name]
    odd = [None] * len(texts) if ids == "null" else [i % 3 or None for i in range(len(texts))]
    run = lambda given: Counter(str(r) for r in operator(documents(spark, texts, given)).select(*columns).collect())
    assert run(odd) == run(range(len(texts)))


def test_suffixes_with_repeated_ids(spark, texts):
    ids = [i % 4 or None for i in range(len(texts))]
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.repeats(documents(spark, texts, ids)).collect())
    order = [float("inf") if i is None else i for i in ids]
    data = [(t or "").encode() for t in texts]
    want = Counter()
    for i, text in zip(order, data, strict=True):
        before = {d[k : k + 50] for j, d in zip(order, data, strict=True) if j < i for k in range(len(d) - 49)}
        gone = {p for k in range(len(text) - 49) if text[k : k + 50] in before for p in range(k, k + 50)}
        want[None if i == float("inf") else i, len(text), len(gone)] += 1
    assert got == want


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: i % 5, lambda i: i])
@pytest.mark.parametrize("same", [False, True])
def test_mix_reaches_its_targets(spark, ids, same):
    """Null and repeated ids, texts of their own or one text for all: each source's take is within a document of its target."""
    rows = [(ids(i), " ".join(["w"] * 10 if same else [f"w{i}"] * 10), "en", s) for s, n in (("a", 100), ("b", 1_000), ("c", 400)) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.taken_words(docs).groupBy("source", "target").agg(F.sum(F.col("times") * F.col("size")).alias("taken"), F.count("*").alias("n")).collect()
    assert {r["source"]: r["n"] for r in got} == {"a": 100, "b": 1_000, "c": 400}
    assert all(abs(r["taken"] - r["target"]) <= 10 for r in got), got
    assert mixing.mix(docs).count() == sum(r["taken"] // 10 for r in got)


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i % 3])
def test_no_language_is_lost(spark, ids):
    """Rows of a language that share or lack ids train it, repeated rows and small samples too."""
    rng = random.Random(4)
    vocabulary = {"fr": ["bonjour", "les", "êtes", "fenêtre", "nous", "avec"], "en": ["the", "which", "window", "with", "there", "they"]}
    rows = [(ids(i), " ".join(rng.choices(vocabulary[lang], k=30)), lang, "s") for lang, n in (("fr", 400), ("en", 40)) for i in range(n)] + [(None, "oui oui êtes", "fr", "s")] * 300
    got = language_id.identify(spark.createDataFrame(rows, SCHEMA).repartition(6), sample=20)
    assert {(r["declared"], r["language"]): r["count"] for r in got.groupBy("declared", "language").count().collect()} == {("fr", "fr"): 700, ("en", "en"): 40}


def test_lowest_places_are_exact(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.randint(-50, 50)) for _ in range(400)] + [("d", 3)] * 90 + [("e", k) for k in range(5)]
    got = {r[0]: r[1] for r in language_id.lowest(spark.createDataFrame(rows, "name string, place long").repartition(7), 9).collect()}
    assert got == {n: sorted({p for m, p in rows if m == n})[:9][-1] for n in "abcde"}


@pytest.mark.parametrize(
    "run",
    [exact_dedup.dedup, near_dedup.dedup, language_id.only_identified, mixing.mix],
    ids=["exact", "near", "language", "mix"],
)
@pytest.mark.parametrize("name", ["__row", "__ROW", "__times", "turn", "row", "part", "kept"])
def test_own_columns_keep_their_names(spark, texts, run, name):
    docs = documents(spark, texts, range(len(texts)))
    plain = run(docs)
    own = run(docs.withColumn(name, F.lit(0)).withColumn("doc.s", F.lit("dot")))
    assert own.columns == [*docs.columns, name, "doc.s"]
    assert {r[0] for r in own.select(f"`{name}`").collect()} <= {0}
    assert Counter(map(tuple, own.select(*docs.columns).collect())) == Counter(map(tuple, plain.collect()))


def test_key_of_a_caller_is_not_ours(spark, texts):
    docs = documents(spark, texts, range(len(texts))).withColumn("__row", F.lit(0))
    table = keyed(docs)
    assert table.select("__row").distinct().count() == len(texts)
    assert keyed(table) is table
    assert Counter(map(tuple, own_columns(table).collect())) == Counter(map(tuple, docs.collect()))
    lines = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.dedup(docs).collect()}
    assert lines == {i: row[2] for i, row in brute.lines_kept(list(enumerate(texts))).items()}
