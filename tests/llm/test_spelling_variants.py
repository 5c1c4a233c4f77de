"""Spelling variants against a plain version: odd texts, large blocks cut to tiles, more groups of letters, chains of forms."""

from __future__ import annotations

import random

import brute
import pytest

from terrane.llm import spelling_variants

NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def rows_of(df):
    return {tuple(r) for r in df.select(*NAMES).collect()}


def documents(spark, pairs):
    return spark.createDataFrame([(k, t, "x", 3) for k, t in pairs], "doc_id long, text string, word string, n long").coalesce(3)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeéÿ×") for _ in range(rng.randint(6, 10))) for _ in range(60)]

    def slip(w):
        i, c = rng.randrange(len(w)), rng.choice("abcé÷")
        return rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w.upper()])

    texts = [" ".join(w if rng.random() < 0.5 else slip(w) for w in rng.choices(base, k=200)) for _ in range(12)]
    long = "ab" * 40_000
    texts += [None, "", " 123 \n", texts[0], texts[0], "漢letters漢letters letterss", f"{long} {long} {long}c {long}c", "ÀBCDEFGH Àbcdefgh àbcdefgh " * 3]
    return [*enumerate(texts), (None, texts[1]), (None, texts[2]), (3, texts[4])]


def test_odd_texts(spark, odd):
    got = rows_of(spelling_variants.variants(documents(spark, odd)))
    assert got == brute.variants(odd)
    assert sum(r[4] for r in got) > 50


@pytest.mark.parametrize(("tile", "each"), [(3, 1_000_000), (7, 40), (2_048, 2)])
def test_tiles_and_groups(spark, odd, monkeypatch, tile, each):
    monkeypatch.setattr(spelling_variants, "TILE", tile)
    monkeypatch.setattr(spelling_variants, "WORDS_EACH", each)
    assert rows_of(spelling_variants.variants(documents(spark, odd))) == brute.variants(odd)


def test_forms_are_followed(spark):
    words = [("abcdefg" + "h" * i, 2 * 10**i) for i in range(4)]
    texts = [(-1, " ".join(f"{w} " * n for w, n in words))]
    got = {r[0]: r for r in rows_of(spelling_variants.variants(documents(spark, texts)))}
    want = {r[0]: r for r in brute.variants(texts)}
    assert got == want
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(19)], "word string, form string")
    assert {tuple(r) for r in spelling_variants.roots(forms).collect()} == {(f"w{i}", "w19") for i in range(19)}


def test_empty_table(spark, odd):
    assert spelling_variants.variants(documents(spark, odd).limit(0)).count() == 0


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(spelling_variants.op11(spark, sf)) == brute.variants(docs)
