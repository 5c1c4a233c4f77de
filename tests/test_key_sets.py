"""Keys that two tables share: odd keys, repeated keys, other statuses, nulls on both sides and on one."""

from __future__ import annotations

import pytest

from terrane.plans import registry

ORDERS = [(1, "F"), (1, "F"), (3, "F"), (3, "O"), (4, "O"), (6, "F"), (9, "F"), (None, "F")]


@pytest.mark.parametrize(("customers", "shared"), [([1, 2, 3, 4, 5, None], {1, 3, None}), ([1, 2, 3, 3], {1, 3}), ([2, 4], set())])
def test_intersect_keys(spark, tmp_path, customers, shared):
    spark.createDataFrame([(k,) for k in customers], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame(ORDERS, "o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    got = [r["k"] for r in registry.QUERIES["u3_intersect_keys"](spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == shared
