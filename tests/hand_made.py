"""Hand-made tables for a registered query and its SQL."""

from __future__ import annotations

import duckdb
from oracle import plain

from terrane.plans import registry


def both(spark, folder, name: str, **tables) -> tuple[list, list]:
    """Sorted rows of a query and of its SQL over ``tables``, each (rows, schema)."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet/*.parquet')")
    cursor = con.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in cursor.description]
    return sorted(tuple(plain(r[n]) for n in names) for r in registry.QUERIES[name](spark, str(folder)).collect()), sorted(tuple(map(plain, r)) for r in cursor.fetchall())
