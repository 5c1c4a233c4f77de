"""Token counts at every prefix against the library, on odd texts and on documents."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from terrane.llm import token_counts

PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", " \n", "'", "'s", "'re", "'ll", "!", "...", "--", "1", "23", "é", "漢", "😀", "\x1c", "<|endoftext|>", "<|endo", "ll", "re", "ՙ", "٣", "²", "aaaa", "========", "　", "ſ", "é", "\U0003fc36"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.public_path(token_counts.TOKENIZER))
    return lambda text: len(t.encode(text, add_special_tokens=False))


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load().prepare()


def test_every_prefix(vocabulary, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(600)]
    for text, counts in zip(texts, vocabulary.of(texts), strict=True):
        assert counts.tolist() == [library(text[:i]) for i in range(len(text) + 1)], repr(text)


def test_generations(vocabulary, library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEEP_PIECES", 20)
    monkeypatch.setattr(token_counts, "KEEP_PAIRS", 50)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(30)) for _ in range(20)]
    assert [int(vocabulary.of([t])[0][-1]) for t in texts] == [library(t) for t in texts]


def test_long_pieces(vocabulary, library):
    for text in ("ab" * 300_000, " " * 100_000 + "x", "=" * 50_000):
        assert vocabulary.of([text])[0][-1] == library(text)


def test_columns_and_cut(spark, library):
    texts = [None, "", "a", "a b  c\n\nthe end", "x<|endoftext|>y", "the " * 500, "the " * 500]
    rows = [(i % 2 or None, t, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, counts string")
    out = token_counts.prefix_counts(docs)
    assert sorted(out.columns) == ["counts", "doc_id", "text"]
    got = sorted((r["text"] or "", tuple(r["counts"])) for r in out.collect())
    assert got == sorted(((t or ""), tuple(library((t or "")[:i]) for i in range(len(t or "") + 1))) for t in texts)
    cut = {r["text"]: r["n"] for r in token_counts.truncated(docs, 5).select("text", token_counts.tokens_at(F.col("counts")).alias("n")).collect()}
    want = set()
    for t in texts:
        t = t or ""
        want.add(t[: max(i for i in range(len(t) + 1) if library(t[:i]) <= 5)])
    assert set(cut) == want and all(cut[t] == library(t) for t in want)
    assert token_counts.prefix_counts(docs.limit(0)).count() == 0
    assert {r[0] for r in out.select(token_counts.tokens_at(F.col("counts"), 1)).collect()} == {0, 1}


def test_query(spark, sf, library):
    rows = token_counts.op13(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)
