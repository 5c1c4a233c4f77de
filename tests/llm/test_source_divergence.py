"""The divergence audit against a plain version on odd tables; its SQL is run with those of the other operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from terrane.llm import source_divergence

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def plain(docs, least):
    counts, found, groups = Counter(), Counter(), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts.update((lang, source, w) for w in words)
        found.update({(lang, w) for w in words})
    kept = defaultdict(set)
    for (lang, w), n in found.items():
        if n >= least:
            kept[lang].add(w)
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    p, q = {}, {}
    for lang, source in groups:
        v = len(kept[lang])
        total = sum(counts[lang, source, w] for w in kept[lang])
        every = {w: sum(counts[lang, s, w] for k, s in groups if k == lang) for w in kept[lang]}
        for w in kept[lang]:
            p[lang, source, w] = share(counts[lang, source, w], total, v)
            q[lang, w] = share(every[w], sum(every.values()), v)
    f = lambda a, b: (a - b) ** 2 // (a + b)
    rows = set()
    for lang, source in groups:
        pairs = [(sum(f(p[lang, source, w], p[lang, s, w]) for w in kept[lang]), s) for k, s in groups if k == lang and s != source]
        terms = [(f(p[lang, source, w], q[lang, w]), w) for w in kept[lang] if counts[lang, source, w] and p[lang, source, w] > q[lang, w]]
        order = lambda x: sorted(x, key=lambda y: (-y[0], y[1].encode()))
        rows |= {(lang, source, "pair", s, v, i) for i, (v, s) in enumerate(order(pairs), 1)}
        rows |= {(lang, source, "term", w, v, i) for i, (v, w) in enumerate(order(terms)[:10], 1)}
    return rows


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["Éa", "éa", "漢", "A", "a", "𝒳"]
    rows = []
    for lang in ("en", "", None, "fr"):
        for k in range(40):
            source = rng.choice(["hot", "hot", "b", "", None, "ü"])
            rows.append((lang, source, rng.choice([" ", "-", "1"]).join(words[int(rng.random() ** 3 * len(words))] for _ in range(rng.randint(0, 60)))))
    rows += [("xx", "one", "alone here"), ("xx", "two", None), ("yy", "only", ""), rows[0], rows[0]]
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, item string, N long").coalesce(3)


@pytest.mark.parametrize("least", [1, 3, 10])
def test_odd_tables(spark, odd, least):
    got = source_divergence.audit(documents(spark, odd), least)
    assert [(f.name, f.dataType.simpleString()) for f in got.select("value", "rank").schema] == [("value", "bigint"), ("rank", "int")]
    got = [tuple(r) for r in got.select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(odd, least)


def test_flushed_counts(spark, odd, monkeypatch):
    want = {tuple(r) for r in source_divergence.term_counts(documents(spark, odd)).collect()}
    monkeypatch.setattr(source_divergence, "KEEP_TERMS", 0)
    assert {tuple(r) for r in source_divergence.term_counts(documents(spark, odd)).collect()} == want


def test_counts_of_a_large_corpus(spark):
    """Shares stay exact where 10^9 times the count is beyond 64 bits."""
    n, total = 9 * 10**15, 10**18
    got = spark.range(1).selectExpr(f"{n}L n", f"{total}L total", "7L width").select(source_divergence.share("n", "total")).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 14)


def test_empty_table(spark, odd):
    assert source_divergence.audit(documents(spark, odd).limit(0)).count() == 0
