"""Counts of the index do not wait for its groups of copies."""

from __future__ import annotations

import pytest
from hand_made import both

from terrane.operators import index as I

TABLES = {
    "supplier": ([(k, k % 2) for k in range(40)], "s_suppkey long, s_nationkey int"), "customer": ([(k, k % 2) for k in range(30)], "c_custkey long, c_nationkey int"),
    "nation": ([(0, "NATION_0", 0), (1, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int"), "region": ([(0, "R")], "r_regionkey int, r_name string"),
}


def test_counts_need_no_groups(spark, tmp_path, monkeypatch):
    def refuse(_):
        raise AssertionError("groups were made")

    monkeypatch.setattr(I, "same_place_groups", refuse)
    got, want = both(spark, tmp_path, "b3_index_counts", **TABLES)
    assert len(got) == 6 and got == want
    layer = I.Layer("a", spark.createDataFrame([("X:1", "n")], "place_id string, name string"))
    with pytest.raises(AssertionError, match="groups were made"):
        _ = I.build_index([layer]).places
