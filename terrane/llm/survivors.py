"""Which winnowed seeds occur more than once in the corpus: the shared first pass of suffix-array and substring dedup.

Documents are dealt into chunks of a few MB. A chunk sends each of its distinct hashes once, packed per bucket into one
binary value, with a mark if the chunk itself already repeats it. A bucket compares the hashes of all chunks and answers
with one bit for each hash sent. So a seed in a third of all documents costs one hash per chunk, not one per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import ROW, parts, text_bytes, with_rows

CHUNK = 4 << 20
ASKED = "chunk long, bucket int, n int, hashes binary, marks binary"
LAST = (1 << 63) - 1  # stands for a null doc_id, which comes last
ASKED_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("marks", pa.binary())])
TOLD = "chunk long, bucket int, bits binary"
_TOLD_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())])


def chunked(docs: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, int]:
    """``docs`` as (row key, doc_id, text, chunk), dealt by chunk, and the number of buckets. A null doc_id sorts after all others."""
    spark = docs.sparkSession
    total = text_bytes(docs)
    chunks = max(1, -(-total // chunk))
    d = with_rows(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = parts(spark, total, 64 << 20)
    return d.withColumn("chunk", F.pmod(F.xxhash64(ROW), F.lit(chunks))).repartition(n, "chunk"), n


def packed(chunk: int, buckets: int, keys: np.ndarray, order_marks: list[np.ndarray], arrays: list[np.ndarray]):
    """Rows for the buckets: ``keys`` decide the bucket; arrays (and marks as bits) are cut alike. Yields (bucket, n, bytes of arrays, bytes of marks)."""
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.diff(np.concatenate(([-1], bucket[order])))) if len(keys) else []
    for start, end in zip(at, [*at[1:], len(keys)], strict=False):
        pick = order[start:end]
        yield int(bucket[pick[0]]), len(pick), [a[pick].tobytes() for a in arrays], [np.packbits(m[pick]).tobytes() for m in order_marks]


def asked(chunk: int, buckets: int, hashes: np.ndarray, marks: np.ndarray) -> pa.Table:
    """The chunk's distinct sorted hashes (rows of 64-bit words) as a table for the buckets."""
    first = hashes if hashes.ndim == 1 else hashes[:, 0]
    rows = list(packed(chunk, buckets, first, [marks], [hashes]))
    return pa.table([pa.array([chunk] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2][0] for r in rows], pa.binary()), pa.array([r[3][0] for r in rows], pa.binary())], schema=ASKED_ARROW)


def answer(bits_by_bucket: dict[int, bytes], buckets: int, hashes: np.ndarray) -> np.ndarray:
    """For the hashes that ``asked`` sent, in their order, whether they occur more than once."""
    first = hashes if hashes.ndim == 1 else hashes[:, 0]
    out = np.zeros(len(first), bool)
    bucket = (first % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.diff(np.concatenate(([-1], bucket[order])))) if len(first) else []
    for start, end in zip(at, [*at[1:], len(first)], strict=False):
        pick = order[start:end]
        bits = bits_by_bucket.get(int(bucket[pick[0]]))
        if bits is not None:
            out[pick] = np.unpackbits(np.frombuffer(bits, np.uint8))[: len(pick)].astype(bool)
    return out


def _compare(words: int):
    def run(batches):
        chunk, bucket, n, hashes, marks = [], [], [], [], []
        for b in batches:
            chunk += b.column("chunk").to_pylist()
            bucket += b.column("bucket").to_pylist()
            n += b.column("n").to_pylist()
            hashes += b.column("hashes").to_pylist()
            marks += b.column("marks").to_pylist()
        if not n:
            return
        size = np.array(n)
        all_hashes = np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, words)
        mark = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8))[:k] for m, k in zip(marks, n, strict=True)]).astype(bool)
        order = np.lexsort(all_hashes.T[::-1]) if words > 1 else np.argsort(all_hashes[:, 0])
        ranked = all_hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        often = (np.bincount(group) > 1) | (np.bincount(group, weights=mark[order]) > 0)
        repeated = np.zeros(len(ranked), bool)
        repeated[order] = often[group]
        ends = np.cumsum(size)
        for i in range(len(n)):
            piece = repeated[ends[i] - size[i] : ends[i]]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk[i]], pa.int64()), pa.array([bucket[i]], pa.int32()), pa.array([np.packbits(piece).tobytes()], pa.binary())], schema=_TOLD_ARROW)

    return run


def compared(rows: DataFrame, buckets: int, words: int = 1) -> DataFrame:
    """``rows`` of ``ASKED`` to rows of ``TOLD``: in each bucket, which hashes came from two chunks or were marked. Buckets without any are left out."""
    return rows.repartition(buckets, "bucket").mapInArrow(_compare(words), TOLD)


def told(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table.column("bucket").to_pylist(), table.column("bits").to_pylist(), strict=True))

