"""Layouts of written tables: files by measured bytes, large parents split, and what a lookup reads."""

from __future__ import annotations

import uuid
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from terrane.sources import writers


def bytes_read(spark, df):
    """(rows, bytes) that the tasks of one run of ``df`` read, by their metrics."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "lookup")
    rows = df.collect()
    context._jsc.sc().listenerBus().waitUntilEmpty()
    store, tracker = context._jsc.sc().statusStore(), context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return rows, sum(store.lastStageAttempt(s).inputBytes() for s in stages)


def _wide(spark, n):
    return spark.range(n, numPartitions=4).select(F.format_string("P:%06d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("place_id"), F.sha2(F.col("id").cast("string"), 256).alias("external_id"), F.concat_ws("", *[F.sha2(F.concat(F.col("id"), F.lit(f"/{i}")), 512) for i in range(8)]).alias("geometry"))


def _files(path):
    return sorted(Path(path).rglob("*.parquet"))


def test_files_and_groups_follow_bytes(spark, tmp_path):
    d = _wide(spark, 20_000)  # 22 MB
    writers.write_sites(d, str(tmp_path / "a"), file_bytes=4 << 20, group_bytes=256 << 10)
    writers.write_sites(d.limit(100), str(tmp_path / "b"), file_bytes=4 << 20)
    writers.write_sites(d.limit(0), str(tmp_path / "c"))
    assert 5 <= len(_files(tmp_path / "a")) <= 7
    assert len(_files(tmp_path / "b")) == 1
    assert spark.read.parquet(str(tmp_path / "c")).count() == 0
    groups = [pq.ParquetFile(f).metadata.row_group(0).num_rows for f in _files(tmp_path / "a")]
    assert max(groups) <= 1000


def test_a_lookup_reads_a_small_part(spark, tmp_path):
    path = str(tmp_path / "sites")
    writers.write_sites(_wide(spark, 20_000), path, file_bytes=4 << 20, group_bytes=256 << 10, blooms=("external_id",))
    size = sum(f.stat().st_size for f in _files(path))
    d = spark.read.option("parquet.hadoop.vectored.io.enabled", False).parquet(path)  # the metric misses vectored reads
    rows, read = bytes_read(spark, d.where("place_id = 'P:004242'"))
    assert len(rows) == 1 and 0 < read < size / 10
    rows, other = bytes_read(spark, d.where(F.col("external_id") == F.sha2(F.lit("77"), 256)))
    assert len(rows) == 1 and other < size / 3  # unsorted: the filters of the groups decide
    _, whole = bytes_read(spark, d.agg(F.max("geometry"), F.max("external_id")))
    assert whole > size / 2  # the metric does count


def test_a_large_parent_is_many_files_of_consecutive_cells(spark, tmp_path):
    hot = spark.range(60_000).select(F.concat(F.lit("p"), F.col("id") % 5).alias("place_id"), F.col("id").alias("cell"), F.lit(0.5).alias("share"), F.lit(3).alias("res"), F.lit(1).alias("parent"))
    cold = hot.where("cell < 40").withColumn("parent", F.col("cell").cast("int") + 2)
    writers.write_membership(hot.unionByName(cold), str(tmp_path / "m"), file_bytes=200_000)
    spans = sorted((t["min"], t["max"]) for f in _files(tmp_path / "m" / "res=3" / "parent=1") for t in [_span(f)])
    assert len(spans) > 4
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 60_040
    assert len(_files(tmp_path / "m")) <= 41 + 12


def test_one_cell_with_all_rows_is_split_by_place(spark, tmp_path):
    d = spark.range(40_000).select(F.format_string("p%05d", "id").alias("place_id"), F.lit(7).cast("long").alias("cell"), F.lit(0.5).alias("share"), F.lit(1).alias("res"), F.lit(1).alias("parent"))
    writers.write_membership(d, str(tmp_path / "m"), file_bytes=200_000)
    assert len(_files(tmp_path / "m")) > 3


def _span(file):
    c = pq.read_table(file, columns=["cell"], partitioning=None).column("cell").to_numpy()
    assert (c[1:] >= c[:-1]).all()
    return {"min": c[0], "max": c[-1]}


def test_row_bytes_of_all_types_and_nulls(spark):
    d = spark.sql("select 'abcd' s, cast('xy' as binary) b, 1 i, 2L l, true t, date'2024-01-01' d, array(1, 2) a, cast(null as string) n, timestamp'2024-01-01' ts, 1.5 `odd.name`")
    assert d.select(writers.row_bytes(d)).first()[0] == 4 + 2 + 4 + 8 + 1 + 4 + len('{"a":[1,2]}') + 0 + 8 + 8
