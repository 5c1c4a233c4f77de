"""Shared pieces of the training-data operators: row keys, scratch tables, text constants.

Scratch tables live under ``spark.checkpoint.dir``, the folder that the driver and all executors share. Writing a
table there cuts the lineage, so a lost executor costs at most the stage that was running.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract, as the inside of a character class.
WS = r"\x20\x09-\x0D"
ROW = "__row"
_MARK = "terrane.row"

_LOCAL: dict[str, str] = {}
_USED: set[str] = set()
_COLLECT: list[list[DataFrame]] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Unset is only accepted on a local master, which gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return _LOCAL[app]


def stash(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it back: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    home = f"{shared_folder(spark)}/scratch-{spark.sparkContext.applicationId}"
    path = f"{home}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if home not in _USED:
        _USED.add(home)
        atexit.register(_remove, spark, home)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch_path = path
    for made in _COLLECT:
        made.append(found)
    return found


@contextmanager
def collected():
    """The list of all tables that are stashed within; the caller may discard them when what was made of them is written."""
    made: list[DataFrame] = []
    _COLLECT.append(made)
    try:
        yield made
    finally:
        _COLLECT[:] = [x for x in _COLLECT if x is not made]


def discard(*tables: DataFrame | None) -> None:
    """Deletes stashed tables that nothing reads any more; other frames are left alone."""
    for table in tables:
        path = vars(table).get("scratch_path") if table is not None else None
        if path:
            _remove(table.sparkSession, path)


def _remove(spark: SparkSession, home: str) -> None:
    """Deletes a folder of scratch tables, if Spark still runs; all that is left goes when the driver's Python ends."""
    context = spark.sparkContext
    if getattr(context, "_jsc", None) is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(home)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def has_key(docs: DataFrame) -> bool:
    """Whether ``docs`` holds a row key of ours. The mark in the column's metadata tells it from a column of the caller that has its name."""
    return any(f.name == ROW and _MARK in f.metadata for f in docs.schema)


def with_rows(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` of ``docs`` with a row key, so that repeated or null ``doc_id`` values stay apart. A key that ``docs`` holds already is kept; a new one holds for this scan only."""
    key = F.col(ROW) if has_key(docs) else F.monotonically_increasing_id()
    return docs.select(key.alias(ROW, metadata={_MARK: "key"}), *columns)


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs``, or some of its columns, written once with its row key. Whatever joins on the key reads it from here, since
    another scan of ``docs`` may be split, and so numbered, otherwise. A column of the caller that is named as the key gets
    another name, which :func:`own_columns` takes back.
    """
    if has_key(docs):
        return docs
    clear = lambda c: F.col(f"`{c}`").alias(f"{ROW}_{uuid.uuid4().hex}", metadata={_MARK: c}) if c.lower() == ROW else F.col(f"`{c}`")
    return stash(with_rows(docs, *map(clear, columns or docs.columns)), "keyed")


def own_columns(rows: DataFrame) -> DataFrame:
    """Rows of a :func:`keyed` table without the key, the caller's columns under their own names."""
    return rows.select(*[F.col(f"`{f.name}`").alias(f.metadata.get(_MARK, f.name), metadata={k: v for k, v in f.metadata.items() if k != _MARK}) for f in rows.schema if f.name != ROW])


def id_order(doc_id, row):
    """A struct that sorts rows by doc_id, nulls last, then by row key."""
    return F.struct(F.isnull(doc_id).alias("no"), doc_id.alias("id"), row.alias("row"))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text in the table; one number reaches the driver."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).cast("long")).first()[0]


def parts(spark: SparkSession, total: int, each: int) -> int:
    """Partitions of about ``each`` bytes, but no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // each))
