"""Points just past 180 degrees: cells as the caller's columns say."""

from __future__ import annotations

import pytest
from hand_made import both
from pyspark.sql import functions as F

from terrane.functions import boxes as B

#: The first key lies at 180.003 degrees east.
ORDERS = ([(22321, 5.0), (1, 7.0), (3, 2.5)], "o_orderkey long, o_totalprice double")


def test_a_column_past_the_last_is_not_wrapped(spark):
    got = spark.range(1).select(B.cell_at(F.lit(1), F.lit(720), 720, 0.5, 5.0).alias("c")).select("c.*").first()
    assert tuple(got) == (2 * 720 + 1, 72)


@pytest.mark.parametrize("name", ["f22_cell_at", "f24_morton"])
def test_points_past_180(spark, tmp_path, name):
    got, want = both(spark, tmp_path, name, orders=ORDERS)
    assert len(got) == 3 and got == want
