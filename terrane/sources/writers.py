"""Sinks: sites, membership, feature lines, value exports."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions.text import csv_cell

#: The columns of a values file, in order.
VALUE_COLUMNS = ("place_id", "coll", "indicator", "time_grain", "time", "class", "n", "sd", "unit")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row before compression: lengths of texts and binaries, fixed sizes of numbers, JSON for nested columns."""

    def of(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(c)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(c)))
        return F.lit(4 if isinstance(field.dataType, (T.IntegerType, T.DateType, T.FloatType)) else 1 if isinstance(field.dataType, (T.BooleanType, T.ByteType)) else 8)

    return sum((F.coalesce(of(f), F.lit(0)).cast("long") for f in df.schema), F.lit(0).cast("long"))


def layout(df: DataFrame, file_bytes: int, group_bytes: int) -> tuple[int, int]:
    """(files, rows of a group) that hold ``df`` in pieces of about these sizes, measured by one aggregate; at least one of each."""
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return max(1, ceil(size / file_bytes)), max(1, round(rows * group_bytes / size) if size else 1)


def write_sites(df: DataFrame, path: str, order: str = "place_id", partitions: int | None = None, group_bytes: int = 1 << 20, file_bytes: int = 256 << 20, blooms: tuple[str, ...] = ()) -> None:
    """Range-partitioned and sorted by ``order`` with small row groups, so that a lookup by it reads few of them.

    Without ``partitions`` the number of files follows the measured bytes of the rows, ``file_bytes`` of them to a file before
    compression. Rows of one key stay in one file. Columns of ``blooms`` get a Bloom filter in each row group, sized for the
    rows that it holds, so lookups by them skip groups although they are not sorted by them. A row larger than
    ``group_bytes`` is a group of its own, up to the few rows between two looks at the size. An empty table is one empty file.
    """
    files, group_rows = layout(df, file_bytes, group_bytes) if partitions is None or blooms else (partitions, 0)
    spread = df.repartitionByRange(partitions or files, order).sortWithinPartitions(order)
    writer = spread.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", group_bytes).option("parquet.block.size.row.check.min", 10)
    for c in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True).option(f"parquet.bloom.filter.expected.ndv#{c}", group_rows)
    writer.parquet(path)


def write_membership(df: DataFrame, path: str, file_bytes: int = 256 << 20) -> None:
    """(place_id, cell, share, res, parent) by resolution and coarse parent, sorted by cell.

    Rows are cut into ranges of (res, parent, cell, place_id) of about ``file_bytes`` before compression, measured. So a parent with most
    rows is many files of consecutive cells, written by as many tasks, and small parents share a task; there are at most
    as many files as parents and ranges together.
    """
    order = ("res", "parent", "cell", "place_id")
    files, _ = layout(df, file_bytes, file_bytes)
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").partitionBy("res", "parent").parquet(path)


def membership_manifest(df: DataFrame) -> DataFrame:
    return df.groupBy("res", "parent").agg(F.count("*").alias("rows"), F.count_distinct("place_id").alias("sites"))


def place_parents(df: DataFrame) -> DataFrame:
    return df.select("place_id", "res", "parent").distinct()


def feature_lines(df: DataFrame, keep: list[str]) -> DataFrame:
    """One GeoJSON feature per line; null properties are left out. ``geometry`` is GeoJSON text."""
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*keep)), F.lit(',"geometry":'), "geometry", F.lit("}")).alias("line"))


def write_feature_lines(df: DataFrame, keep: list[str], path: str) -> None:
    feature_lines(df, keep).write.mode("overwrite").text(path)


def export_values(df: DataFrame, place_id: str, source: str) -> DataFrame:
    """One place's rows as CSV lines in the fixed column order, with the file they came from."""
    cells = [csv_cell(F.col(c)) for c in VALUE_COLUMNS]
    return df.where(F.col("place_id") == place_id).select(F.concat_ws(",", *cells, csv_cell(F.lit(source))).alias("line"))


def write_index(df: DataFrame, path: str) -> None:
    write_sites(df, path, "place_id")
