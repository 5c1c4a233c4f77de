"""The ten operators against plain Python, the oracle SQL, exact round trips and held-out accuracy, with odd inputs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import differences
from pyspark.sql import functions as F

from terrane.llm import exact_dedup, language_id, line_dedup, mixing, near_dedup, quality_rules, registry, secret_scan, sentencepiece_codec, substring_dedup, suffix_dedup
from terrane.llm.common import ROW, stash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, class_id string"


def frame(spark, texts, lang="en", source="s"):
    """Documents with extra columns whose names clash with results."""
    rows = [(i, t, lang, source if i % 3 else None, None if t is None else len(t), "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def odd():
    """Null, empty and blank texts, ties, repeats, long texts, odd characters."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(60)) for _ in range(4)]
    long = "\n".join(" ".join(word() for _ in range(9)) for _ in range(900))
    return [None, "", " \t\n", "a", base[0], base[0].replace(" ", "\n", 3), base[0], base[1] + "\n" + base[2], base[2] + " tail " + base[1], long, "x " + long, long[:5000], "Same Line Here\nsame line here \nother", "  SAME line here\n" + base[3], "é" * 49, "é" * 200, "é" * 200, "\n\n\n", base[3][:40]]


def pairs(texts):
    return list(enumerate(texts))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle(spark, sf, name):
    assert differences(registry.QUERIES[name](spark, sf), registry.ORACLE_SQL[name], sf) == ""


@pytest.mark.parametrize(
    ("operator", "plain", "columns"),
    [
        (lambda d: line_dedup.dedup(d), brute.lines_kept, ("n_lines", "n_dropped", "kept_sha256")),
        (lambda d: suffix_dedup.repeats(d).withColumn("n_spans", F.size("spans")), brute.bytes_kept, ("n_bytes", "n_removed", "n_spans", "kept_sha256")),
        (lambda d: substring_dedup.repeats(d), brute.words_kept, ("n_words", "n_removed", "kept_sha256")),
        (lambda d: quality_rules.statistics(d).withColumn("f", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), lambda p: {i: brute.quality(t) for i, t in p}, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "f")),
    ],
    ids=["lines", "bytes", "words", "quality"],
)
def test_odd_texts(spark, odd, operator, plain, columns):
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in operator(frame(spark, odd)).collect()}
    assert got == plain(pairs(odd))


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_single(spark, n):
    d = frame(spark, [None] * n) if n else spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    frames = [exact_dedup.groups(d), near_dedup.classes(d), secret_scan.scan(d), language_id.identify(d), line_dedup.dedup(d), suffix_dedup.repeats(d), mixing.taken_words(d), substring_dedup.repeats(d), quality_rules.judged(d, labels)[0], sentencepiece_codec.decode(sentencepiece_codec.encode(d))]
    assert [f.count() for f in frames] == [n] * len(frames)


@pytest.mark.parametrize(
    ("module", "inner", "run"),
    [
        (exact_dedup, "groups", lambda d: exact_dedup.dedup(d)),
        (near_dedup, "classes", lambda d: near_dedup.dedup(d)),
        (language_id, "identify", lambda d: language_id.only_identified(d)),
        (line_dedup, "dropped_keys", lambda d: line_dedup.dedup(d)),
        (mixing, "taken_words", lambda d: mixing.mix(d)),
    ],
    ids=["exact", "near", "language", "lines", "mix"],
)
def test_second_scan_split_otherwise(spark, sf, tmp_path, monkeypatch, module, inner, run):
    path, name, real = str(tmp_path / "d"), "spark.sql.files.maxPartitionBytes", getattr(module, inner)
    spark.read.parquet(f"{sf}/documents.parquet").repartition(9).write.parquet(path)
    result = lambda: sorted((r["doc_id"], r["kept_sha256"] if "kept_sha256" in r else r["text"]) for r in run(spark.read.parquet(path)).collect())
    before, expected = spark.conf.get(name), result()

    def resplit(*args, **kwargs):  # each file is a partition of its own in all later scans
        found = real(*args, **kwargs)
        found = stash(found, "inner") if hasattr(found, "sparkSession") else found
        spark.conf.set(name, "1000")
        return found

    monkeypatch.setattr(module, inner, resplit)
    try:
        assert result() == expected
    finally:
        spark.conf.set(name, before)


# 2 ----
def test_exact_groups(spark, odd):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.groups(frame(spark, odd), block=16).collect()}
    key = lambda t: exact_dedup.normalised(t)
    for i, t in enumerate(odd):
        same = [j for j, u in enumerate(odd) if key(u) == key(t)]
        assert got[i] == (min(same), len(same), min(same) == i)


def test_exact_repeated_and_null_ids(spark):
    d = spark.createDataFrame([(1, "a b"), (1, "a  b"), (None, "a\tb"), (None, "c"), (2, "c")], "doc_id long, text string").coalesce(1)
    assert sorted((r["doc_id"] is None, r["text"]) for r in exact_dedup.dedup(d).collect()) == [(False, "a b"), (False, "c")]


# 3 ----
def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=24), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 5)), max_size=7), st.integers(0, 9))
def test_banded_alignment_is_exact(a, changes, limit):
    b = list(a)
    for kind, at, value in changes:
        if kind == 0:
            b.insert(at % (len(b) + 1), value)
        elif b:
            b[at % len(b) : at % len(b) + 1] = [] if kind == 1 else [value]
    d = lev(a, b)
    assert near_dedup.distance_within(np.array(a, np.int64), np.array(b, np.int64), limit) == (d if d <= limit else None)
    words = lambda x: [b"%d" % v for v in x]
    assert near_dedup.similar(words(a), words(b)) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_near_copies_join_and_others_stay(spark):
    rng = random.Random(4)
    words = lambda n: ["w%d" % rng.randrange(5000) for _ in range(n)]
    passage, base = words(50), words(200)
    texts = [" ".join(base)]
    for _ in range(40):  # a chain of copies with 2 % of the words changed
        w = list(base)
        for _ in range(4):
            w[rng.randrange(len(w))] = "new%d" % rng.randrange(999)
        texts.append(" ".join(w))
    texts += [" ".join(words(120) + passage + words(30)) for _ in range(30)]
    texts += ["short one", "short one", "", None, "short two"]
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.classes(frame(spark, texts)).collect()}
    assert all(got[i] == (0, i == 0) for i in range(41))
    assert all(got[i] == (i, True) for i in range(41, 71))
    assert [got[i][0] for i in range(71, 76)] == [71, 71, 73, 73, 75]


def test_near_recall_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    words = {r["doc_id"]: (r["text"] or "").encode().split() for r in docs}
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.op3(spark, sf).collect()}
    ids = sorted(words)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if near_dedup.similar(words[a], words[b]):
                assert got[a] == got[b]


def test_near_copies_far_apart_in_a_large_bucket_meet(spark):
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    passage, own = words("w", 100), words("x", 26)
    # all share the passage, and so the one sketch, but only texts 1 and 2 are alike; 18 others stand between them by length
    texts = [passage + words("first", 20), passage + own, passage + own + words("y", 20)]
    texts += [passage + words(f"o{i}_", 27 + i) for i in range(18)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(frame(spark, [" ".join(t) for t in texts]), n=1, taken=1).collect()}
    assert got == {i: 1 if i == 2 else i for i in range(21)}


def test_near_recall_at_the_threshold_and_of_short_texts(spark):
    rng = random.Random(7)
    texts, planted = [], {"threshold": [], "short": []}
    for kind, lengths in (("threshold", [50, 80, 120, 200] * 75), ("short", list(range(5, 16)) * 20)):
        for k, n in enumerate(lengths):
            base = ["w%d" % rng.randrange(5000) for _ in range(n)]
            copy = list(base)
            for at in rng.sample(range(n), int((0.2 if k % 2 or kind == "short" else 0.16) * n + 1e-9)):
                copy[at] = "new%d" % rng.randrange(10**6)
            planted[kind].append((len(texts), len(texts) + 1))
            texts += [" ".join(base), " ".join(copy)]
    texts += ["a b c d e f g h i j", "a b c d e X g h i j"]
    planted["short"].append((len(texts) - 2, len(texts) - 1))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(frame(spark, texts)).collect()}
    for pairs in planted.values():
        assert sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
    assert got[len(texts) - 1] == len(texts) - 2


# 4 ----
def test_ownership_separates_examples(spark):
    live, example = "Zx9" + "aB3" * 7, "Ex4" + "mP7" * 7
    rows = [(i, f"see {example} end", None, f"owner{i}") for i in range(6)] + [(9, f"use {live} now; password: hunter22, api-key='abc'", None, "owner9"), (10, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["verdict"]) for s in r["spans"]] for r in secret_scan.scan(d).collect()}
    assert got[9] == [(3, 4, "live"), (0, 34, "live")]
    assert all(got[i] == [] for i in (*range(6), 10))


def test_repositories_count_and_many_matches_are_linear(spark):
    value = "Zx9" + "aB3" * 7
    rows = [(i, f"see {value} end", "en", "one owner", f"repo{i}") for i in range(6)] + [(9, " ".join("ab12" * 8 for _ in range(20_000)), "en", "o", "r")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, repo string")
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(d, "source", "repo").collect()}
    assert all(got[i] == [] for i in range(6))
    assert len(got[9]) == 20_000 and got[9][-1]["end"] == 20_000 * 33 - 1


# 5 ----
def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    half = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    held = language_id.identify(half).where("declared is null").join(docs.select("doc_id", "lang"), "doc_id")
    n, right, kept = held.agg(F.count("*"), F.count_if(F.col("language") == F.col("lang")), F.count_if("kept")).first()
    assert right / n > 0.97
    assert kept == n


def test_rare_language_is_a_class(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    few = docs.where("lang = 'en'").limit(60).unionByName(docs.where("lang = 'fr'").orderBy("doc_id").limit(5))
    assert {r["language"] for r in language_id.identify(few).where("declared = 'fr'").collect()} == {"fr"}


def test_language_fuses_evidence(spark, sf):
    base = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", F.concat("lang", F.lit(".example."), "lang").alias("host"))
    odd = spark.createDataFrame([(-1, "12 34", None, "fr.example.fr"), (-2, None, None, None), (-3, "\x01\x02\x03 \x04\x05\x06\x07 \x08\x0e\x0f\x10" * 30, None, None)], base.schema)
    got = {r["doc_id"]: r["language"] for r in language_id.identify(base.unionByName(odd), host="host").where("doc_id < 0").collect()}
    assert got == {-1: "fr", -2: "und", -3: "und"}


def test_pages_as_documents(spark, sf):
    pages = language_id.page_evidence(spark.read.parquet(f"{sf}/pages.parquet"))
    n, right = language_id.identify(pages, host="host").agg(F.count("*"), F.count_if(F.col("language") == F.col("declared"))).first()
    assert right / n > 0.5  # the markup often declares another language than the text has


# 6 ----
@settings(max_examples=30, deadline=None)
@given(st.integers(0, 600), st.integers(0, 10**6))
def test_cuckoo_filter_has_and_forgets(n, seed):
    rng = np.random.default_rng(seed)
    digests = np.unique(rng.integers(0, 256, (n, 16), dtype=np.uint8), axis=0)
    f = line_dedup.Cuckoo.of(digests)
    assert f.has(digests).all()
    half = digests[: len(digests) // 2]
    f.remove(half)
    assert f.has(digests[len(half) :]).all()
    f.remove(digests[len(half) :])
    assert not f.slots.any()


def test_lines_insert_and_delete(spark, odd):
    first, second = frame(spark, odd[:9]), frame(spark, odd).where("doc_id >= 9")
    whole = line_dedup.build(frame(spark, odd))
    start = line_dedup.build(first)
    both = line_dedup.insert(start, second)
    counts = lambda i: {r["digest"]: (r["n_docs"], r["first"]) for r in i.counts.collect()}
    assert counts(both) == counts(whole)
    assert counts(line_dedup.delete(both, second.select("doc_id"))) == counts(start)


def test_rows_of_one_document_keep_their_lines(spark):
    d = spark.createDataFrame([(1, "same line here"), (1, "same line here"), (2, "same line here"), (None, "Same line here ")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_dropped"]) for r in line_dedup.dedup(d).collect()) == [(0, 1), (1, 0), (1, 0), (2, 1)]


# 9 ----
def test_words_that_polynomials_confuse_differ(spark):
    letters = "".join("ab"[i.bit_count() & 1] for i in range(1024))  # Thue-Morse: equal under any odd base modulo 2**64
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join([*words[:20], x, *words[20:]]) for x in (letters, letters.translate(str.maketrans("ab", "ba")))]
    assert [r["n_removed"] for r in substring_dedup.repeats(frame(spark, texts)).collect()] == [0, 0]


# 8 ----
def test_mix_takes_clashing_columns(spark):
    d = frame(spark, ["a b", "c d e", None]).withColumns({"times": F.lit("t"), "size": F.lit("s"), "target": F.lit("x")})
    assert mixing.mix(d).columns == d.columns
    assert mixing.mix(d).where("times != 't'").isEmpty()


def test_mix_reaches_targets(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), ["a", "b", "c", "d", None][min(4, i % 7)]) for i in range(700)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.taken_words(d).groupBy("source").agg(F.first("target").alias("t"), F.first("source_size").alias("s"), F.sum(F.col("times") * F.col("size")).alias("taken"), F.max("times").alias("m")).collect()
    assert sum(r["t"] for r in got) == pytest.approx(sum(r["s"] for r in got))
    assert all(r["t"] <= 3 * r["s"] and r["m"] <= 3 and abs(r["taken"] - r["t"]) <= 40 for r in got)
    once, again = (sorted(map(tuple, mixing.taken_words(d).select("doc_id", "times").collect())) for _ in range(2))
    assert once == again
    assert mixing.mix(d).count() == sum(t for _, t in once)


# 10 ----
def test_rules_hold_on_other_rows(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    rows = [(i, " ".join(("#" + word() if i % 3 == 0 and j % 2 else word()) for j in range(80))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id long, quality int")
    judged, rules = quality_rules.judged(docs, labels)
    assert rules
    assert all(r["kept"] == (r["doc_id"] % 3 > 0) and not r["base_failed"] for r in judged.where("doc_id >= 120").collect())


def test_learned_rules(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows, rules = quality_rules.judged(docs, labels)
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in rows.collect()}
    known = [(r["doc_id"], r["quality"]) for r in labels.collect()]
    good = [got[d] for d, q in known if q == 1]
    assert sum(k or f for f, k in good) / len(good) > 0.98
    assert all(op in (">", "<=") for rule in rules for _, op, _ in rule)


# 1 ----
def test_ids_equal_the_library(spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    texts += ["", " ", "  two  spaces ", " lead", "tab\tand\nline\n\n", "漢字 ünï 😀", "a" * 400 + " " * 45 + "b", "    é   z", "</s> <unk> <0x0A>", "▁x"]
    found = sentencepiece_codec.Encoder(sentencepiece_codec.Vocabulary.load().prepare()).encode(texts)
    assert [np.frombuffer(x, np.int32).tolist() for x in found] == [library.encode(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_viterbi_equals_the_library_on_any_text(text):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.ready(sentencepiece_codec.Vocabulary.load()))
    assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode(text)


def test_unigram_scores_decide():
    v = sentencepiece_codec.Vocabulary(["<unk>", "▁", "a", "b", "▁a", "ab", "▁ab"], [0, -2, -3, -3, -2, -1, -9.0], [2, 1, 1, 1, 1, 1, 1], False, True, "toy").prepare()
    assert np.frombuffer(v.encode_words(["▁ab", "▁a"])["▁ab"], np.int32).tolist() == [1, 5]


def test_round_trip(spark, odd):
    d = sentencepiece_codec.decode(sentencepiece_codec.encode(frame(spark, odd)))
    assert {r["doc_id"]: r["decoded"] for r in d.collect()} == {i: t or "" for i, t in enumerate(odd)}


# the pipeline ----
def test_pipeline_against_plain(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, sf)
        assert out.columns == docs.columns
    got = corpus_pipeline.run(spark, sf).groupBy("doc_id").agg(F.count("*").alias("n"), F.min("exact").alias("exact")).collect()
    assert all(r["exact"] for r in got)
    # plain: every document has a language; then equal texts, then near copies, smallest id first
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept, seen = [], set()
    for i in sorted(texts):
        if (key := exact_dedup.normalised(texts[i])) not in seen:
            seen.add(key)
            kept.append(i)
    words = {i: (texts[i] or "").encode().split() for i in kept}
    first = {i: i for i in kept}
    for k, a in enumerate(kept):
        for b in kept[k + 1 :]:
            if near_dedup.similar(words[a], words[b]):
                low, high = sorted((first[a], first[b]))
                first = {i: low if f == high else f for i, f in first.items()}
    stay = {i for i in kept if first[i] == i}
    mixed = mixing.taken_words(docs.where(F.col("doc_id").isin(sorted(stay)))).where("times > 0")
    assert {r["doc_id"]: r["n"] for r in got} == {r["doc_id"]: r["times"] for r in mixed.collect()}


def test_row_key_is_not_a_column_of_results(spark, odd):
    assert ROW not in exact_dedup.dedup(frame(spark, odd)).columns
