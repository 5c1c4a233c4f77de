"""A sliver of a coarse cell, under the tolerance there, is over it in a finer cell."""

from __future__ import annotations

from hand_made import both


def test_slivers_are_refined(spark, tmp_path):
    got, want = both(spark, tmp_path, "m3_keep_rule", supplier=([(3294,), (2119,), (1,)], "s_suppkey long"))
    assert len(got) == 24 and got == want
