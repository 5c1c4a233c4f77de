"""The search finds names that hold either word which the query has used."""

from __future__ import annotations

from hand_made import both


def test_names_of_both_words(spark, tmp_path):
    nations = ([(0, "Canada"), (1, "NATION_1"), (2, "Peru")], "n_nationkey int, n_name string")
    got, want = both(spark, tmp_path, "j26_search_sites", nation=nations, supplier=([(k, k % 3) for k in range(6)], "s_suppkey long, s_nationkey int"), customer=([(k, k % 3) for k in range(6)], "c_custkey long, c_nationkey int"))
    assert got == want
    assert {m for g in got for m in (g[1], *g[2].split(",")) if m} == {f"{c}:{k}" for c in ("SUP", "CUS") for k in (0, 1, 3, 4)}
