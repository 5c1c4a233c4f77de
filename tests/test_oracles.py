"""Every registered query of the reference's operators agrees with its oracle SQL."""

from __future__ import annotations

import pytest
from oracle import differences, sql_rows

from terrane.plans import registry


#: Queries whose right answer on the smallest tables is no row; on larger ones they have some.
MAY_BE_EMPTY = {"p12_boxes_meet", "s15_export_values", "j9_bbox_join", "j10_polygon_overlap", "j21_carry", "b5_derive_intersect", "a22_derived_report", "t2_anonymous_rates"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    if name in registry.ORACLE_SQL:
        assert name in MAY_BE_EMPTY or sql_rows(registry.ORACLE_SQL[name], sf)[1]
        assert differences(df, registry.ORACLE_SQL[name], sf) == ""
    else:
        assert df.count() > 0


def test_names_are_unique_and_documented():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert registry.FLAGSHIP in registry.QUERIES
