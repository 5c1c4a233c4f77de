"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of fixed size. Equal blocks get equal integer names by sorting: blocks fall into
buckets by content, and a block's name is its bucket and its rank among the bucket's sorted distinct blocks. Then
adjacent names are paired and the pairs are named in the same way, until one name is left. Names compare whole
contents, never hashes alone, so two texts have one identity exactly when they are equal.

At scale: every text crosses the network once, as blocks. Before that, each task keeps one copy of a block with the
list of its sites, so a text that a third of all rows repeat reaches its bucket once for each batch of rows, not once
for each row. Each further level works on names only and has half the rows of the level before.

Defined results: a null text counts as empty; texts are equal after each run of white space is made one space. Of equal
texts the row with the smallest doc_id stays, a null doc_id after all others; of repeated rows with that doc_id, one
stays. An empty table gives no rows. Any other columns are left alone; names that clash with the result's own do not matter.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import ROW, id_order, keyed, own_columns, stash, with_rows
from terrane.llm.textarrays import slices, tidy

BLOCK = 4096
BUCKETS = 1 << 20
_RUNS = re.compile(rb"  +")
_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_PLACE = "struct<row:bigint,at:int,n:int,id:bigint,sha:binary>"
_ARROW_PLACE = pa.struct([("row", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("id", pa.int64()), ("sha", pa.binary())])


def normalised(text: str | None) -> bytes:
    """The text in UTF-8 with each run of white space made one space."""
    return _RUNS.sub(b" ", (text or "").encode().translate(_TO_SPACE))


def _blocks(size: int):
    schema = pa.schema([("block", pa.binary()), ("sites", pa.list_(_ARROW_PLACE))])

    def cut(batches):
        for batch in slices(batches, "text", 4 << 20):
            found: dict[bytes, list] = {}
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in (ROW, "doc_id", "text")), strict=True):
                whole = normalised(text)
                n = max(1, -(-len(whole) // size))
                for at in range(n):
                    first = at == 0
                    found.setdefault(whole[at * size : (at + 1) * size], []).append((row, at, n, doc if first else None, hashlib.sha256(whole).digest() if first else None))
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found.values()])))
            flat = [x for sites in found.values() for x in sites]
            sites = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], f.type) for i, f in enumerate(_ARROW_PLACE)], fields=list(_ARROW_PLACE))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), sites)], schema=schema)

    return tidy(cut)


def _named(df: DataFrame, *content: str) -> DataFrame:
    """Adds ``name``: bucket and rank of the row's content among the bucket's sorted distinct contents."""
    bucket = F.pmod(F.xxhash64(*content), F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*content))
    return df.withColumn("bucket", bucket).withColumn("name", F.col("bucket") * F.lit(1 << 40) + rank).drop("bucket")


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, ``n`` blocks, ``name`` and the text's SHA-256. (n, name) is the text's identity."""
    blocks = with_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_blocks(block), f"block binary, sites array<{_PLACE}>")
    named = stash(_named(blocks, "block").select("name", F.explode("sites").alias("p")).select("p.row", "p.at", "p.n", "name", "p.id", "p.sha"), "blocks")
    heads = named.where("at = 0").select("row", "n", F.col("id").alias("doc_id"), "sha", F.col("name").alias("only"))
    level = named.where("n > 1").select("row", "at", F.col("n").alias("left"), "name")
    done = None
    while not level.isEmpty():
        pairs = (
            level.groupBy("row", F.shiftright("at", 1).alias("at"), F.shiftright(F.col("left") + 1, 1).alias("left"))
            .agg(F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        names = _named(pairs.select("a", "b").distinct(), "a", "b")
        level = stash(pairs.join(names, ["a", "b"]).select("row", "at", "left", "name"), "level")
        whole = level.where("left = 1").select("row", "name")
        done = whole if done is None else done.unionByName(whole)
        level = level.where("left > 1")
    if done is None:
        return heads.withColumnRenamed("only", "name")
    return heads.join(done, "row", "left").select("row", "n", "doc_id", "sha", F.coalesce("name", "only").alias("name"))


def groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and the row key."""
    rows = identities(docs, block).withColumn("order", id_order(F.col("doc_id"), F.col("row")))
    sizes = rows.groupBy("n", "name").agg(F.min("order").alias("first"), F.count("*").alias("group_size"))
    return rows.join(sizes, ["n", "name"]).select(
        F.col("row").alias(ROW), "doc_id", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = keyed(docs)
    kept = groups(docs, block).where("kept").select(ROW)
    return own_columns(docs.join(kept, ROW, "left_semi"))


def op2(spark, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop(ROW)


SQL = r"""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents
), g as (
  select t, min(doc_id) keep_id, count(*) group_size from d group by t
)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
from d join g on d.t = g.t
"""
