"""Order statistics by counting against sorted values: ties, one value, many magnitudes, integers beyond doubles, null keys."""

from __future__ import annotations

import math
import random

import pytest

from terrane.operators import aggregates as A

QUANTILES = [0.0, 0.05, 0.5, 0.95, 1.0]


def plain(rows):
    groups = {}
    for key, v in rows:
        if v is not None and math.isfinite(v):
            groups.setdefault(key, []).append(v)
    return {(k, i, len(v), sorted(v)[math.floor(q * (len(v) - 1))]) for k, v in groups.items() for i, q in enumerate(QUANTILES)}


def cases():
    rng = random.Random(12)
    yield "double", [(rng.choice("abc"), round(rng.gauss(0, 1), 1)) for _ in range(500)] + [("one", 3.5)] * 9 + [(None, float(k)) for k in range(7)] + [("a", None), ("b", math.nan), ("c", -math.inf), ("none", None)]
    yield "double", [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(300)] + [("wide", 0.0)] * 5 + [("tight", 1.0 + k * 2**-52) for k in range(40)] + [("far", v) for v in (-1.7e308, 1.7e308, 5e-324, 0.0, -5e-324)]
    yield "bigint", [("big", 2**60 + rng.randint(0, 40)) for _ in range(200)] + [("mixed", rng.randint(-5, 5)) for _ in range(50)] + [("mixed", 2**61)]


@pytest.mark.parametrize("bins", [2, 1024])
@pytest.mark.parametrize(("kind", "rows"), list(cases()))
def test_order_statistics(spark, kind, rows, bins):
    if bins == 2 and any(v is not None and abs(v) > 1e200 for _, v in rows if v == v):
        pytest.skip("two bins take a round for each bit")
    d = spark.createDataFrame(rows, f"k string, v {kind}").repartition(4)
    got = [tuple(r) for r in A.order_statistics(d, "k", "v", QUANTILES, bins).select("k", "i", "n", "v").collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_one_key_with_all_rows(spark):
    d = spark.range(0, 300_000, 1, 8).selectExpr("'all' k", "cast(id * 7919 % 300007 as double) v")
    found = A.colour_domain(d, "k", "v")
    v = sorted(i * 7919 % 300007 for i in range(300_000))
    assert [tuple(r) for r in found.collect()] == [("all", v[math.floor(0.05 * 299_999)], v[math.floor(0.95 * 299_999)])]


def test_declared_domains_win(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 9.0), ("b", 2.0), (None, 4.0)], "k string, v double")
    declared = spark.createDataFrame([("a", 0.0, 100.0)], "k string, lo double, hi double")
    assert {tuple(r) for r in A.colour_domain(d, "k", "v", declared=declared).collect()} == {("a", 0.0, 100.0), ("b", 2.0, 2.0), (None, 4.0, 4.0)}


def test_empty(spark):
    assert A.colour_domain(spark.createDataFrame([], "k string, v double"), "k", "v").count() == 0
