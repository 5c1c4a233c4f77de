"""Suffix-array dedup by a depth-limited radix sort, over bytes.

Suffixes matter only through their first 50 bytes: equal groups at that depth are exactly the repeated 50-byte strings.
The sort goes by most significant digits, and a group that lies in one document is dropped as soon as that is known. The
first digit is chosen so that few suffixes need sorting at all: every 50-byte string has one anchor, the lowest-hashed 16
bytes in it, which depends on its content only. The first pass groups by anchors; strings whose anchor lies in one document
are unique and done. The following passes sort what remains by the other bytes, eight bytes a pass, down to depth 50.

At scale: the text moves once (all three passes over it read one exchange), then 8 bytes for each distinct anchor of a
chunk, about one for 18 bytes of text, then for each repeated anchor its 84 bytes of context, once per chunk however many
documents of it hold it. A hot passage costs each chunk of 4 MB one context for 18 bytes. Strings themselves are only made
inside the bucket that compares them. A chunk of about 4 MB is the unit of memory; it holds whole texts, so memory grows with
the longest text, by some 90 bytes for each of its bytes.

Defined results: a null text is empty; a text shorter than 50 bytes is left alone. Matches never cross documents. A null
doc_id counts as the largest; rows with one doc_id do not remove each other's bytes, as neither is smaller. Extra columns
and clashing names do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm import textarrays as A
from terrane.llm.survivors import ASKED, LAST, answer, asked, chunked, compared, packed, told

WIDTH = 50
SEED = 16
_SENT = "chunk long, bucket int, n int, contexts binary, docs binary"
_SENT_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("contexts", pa.binary()), ("docs", pa.binary())])
_TOLD = "chunk long, bucket int, bits binary"
_TOLD_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())])


class _Chunk:
    """The byte strings of one chunk: windows, their anchors, and each anchor's document."""

    def __init__(self, texts: pa.Table, width: int, seed: int):
        self.width, self.seed = width, seed
        self.key = texts.column("chunk")[0].as_py()
        self.data, self.offsets = A.joined(texts.column("text"))
        self.windows, at, grams = A.anchors(self.data, self.offsets, width, seed)
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        self.begin = np.flatnonzero(new)  # each anchor's first window
        self.anchor_of = np.cumsum(new) - 1
        self.sites = at[self.begin]
        ids = texts.column("doc_id").to_numpy()
        self.docs = ids[np.searchsorted(self.offsets, self.sites, side="right") - 1] if len(self.sites) else np.zeros(0, np.int64)
        self.values, self.value_of, count = A.unique(grams[self.sites] if len(self.sites) else np.zeros(0, np.uint64))
        if len(self.values):
            order = np.argsort(self.value_of, kind="stable")
            heads = np.concatenate(([0], np.cumsum(count)[:-1]))
            ranked = self.docs[order]
            self.marks = np.minimum.reduceat(ranked, heads) != np.maximum.reduceat(ranked, heads)
        else:
            self.marks = np.zeros(0, bool)

    def contexts(self, repeated: np.ndarray):
        """For the anchors whose value is repeated: distinct contexts (with the span of their windows), smallest doc of each, its anchor's hash; the anchors and the context of each."""
        side = self.width - self.seed
        pick = np.flatnonzero(repeated[self.value_of]) if len(self.sites) else np.zeros(0, np.int64)
        ends = np.append(self.begin[1:], len(self.windows)) - 1
        low, high = (self.windows[x].astype(np.int32) for x in (self.begin[pick], ends[pick]))
        at = self.sites[pick]
        where = (at - side).astype(np.int32)[:, None] + np.arange(self.width + side, dtype=np.int32)[None, :]
        needed = (where >= low[:, None]) & (where < (high + self.width)[:, None])
        rows = np.zeros((len(pick), self.width + side + 2), np.uint8)
        rows[:, :-2] = np.where(needed, self.data[np.clip(where, 0, max(0, len(self.data) - 1))], 0) if len(pick) else 0
        rows[:, -2], rows[:, -1] = at - low, at - high
        first, context = _distinct(rows)
        smallest = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(smallest, context, self.docs[pick])
        return rows[first], smallest, self.values[self.value_of[pick[first]]], pick, context


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct row, and for each row which of them it equals."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel()
    _, first, place = np.unique(whole, return_index=True, return_inverse=True)
    return first, place.ravel()


def _first_digit(width: int, seed: int, buckets: int):
    def run(texts: pa.Table) -> pa.Table:
        c = _Chunk(texts, width, seed)
        return asked(c.key, buckets, c.values, c.marks)

    return run


def _send(width: int, seed: int, buckets: int):
    def run(texts: pa.Table, seeds: pa.Table) -> pa.Table:
        if not texts.num_rows or not seeds.num_rows:
            return _SENT_ARROW.empty_table()
        c = _Chunk(texts, width, seed)
        rows, docs, values, *_ = c.contexts(answer(told(seeds), buckets, c.values))
        out = [(c.key, b, n, blobs[0], blobs[1]) for b, n, blobs, _ in packed(c.key, buckets, values, [], [rows, docs])]
        return pa.table([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_SENT_ARROW)], schema=_SENT_ARROW)

    return run


def _refined(group: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """Group numbers after one more digit: equal for members of one group with equal digits."""
    order = np.lexsort((digit, group))
    new = np.ones(len(order), np.int64)
    new[1:] = (group[order][1:] != group[order][:-1]) | (digit[order][1:] != digit[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def smallest_docs(rows: np.ndarray, docs: np.ndarray, left: int, width: int, side: int) -> np.ndarray:
    """For the strings that start ``left`` bytes before the anchor: the smallest document of each row's string. Rows are contexts; a digit is eight bytes."""
    out = docs.copy()
    live = np.arange(len(rows))
    group = np.zeros(len(rows), np.int64)
    for start in range(0, width, 8):
        piece = np.zeros((len(live), 8), np.uint8)
        end = min(start + 8, width)
        piece[:, : end - start] = rows[live, side - left + start : side - left + end]
        group = _refined(group, piece.view(">u8").ravel().astype(np.uint64))
        shared = np.bincount(group)[group] > 1
        live, group = live[shared], group[shared]
        if not len(live):
            return out
    order = np.argsort(group, kind="stable")
    heads = np.flatnonzero(np.diff(np.concatenate(([-1], group[order]))))
    low = np.minimum.reduceat(docs[live[order]], heads)
    out[live[order]] = np.repeat(low, np.diff(np.append(heads, len(order))))
    return out


def _sort(width: int, seed: int):
    side = width - seed

    def run(batches):
        chunk, bucket, n, contexts, docs = [], [], [], [], []
        for b in batches:
            for to, name in ((chunk, "chunk"), (bucket, "bucket"), (n, "n"), (contexts, "contexts"), (docs, "docs")):
                to += b.column(name).to_pylist()
        if not n:
            return
        sent = np.frombuffer(b"".join(contexts), np.uint8).reshape(-1, width + side + 2)
        own = np.frombuffer(b"".join(docs), np.int64)
        del contexts, docs
        first, place = _distinct(sent)
        rows = sent[first]
        low = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(low, place, own)
        bits = np.zeros(len(sent), np.uint64)
        for left in range(side + 1):
            some = np.flatnonzero((rows[:, -2] >= left) & (rows[:, -1] <= left))
            found = low.copy()
            found[some] = smallest_docs(rows[some], low[some], left, width, side)
            bits |= (found[place] < own).astype(np.uint64) << np.uint64(left)
        ends = np.cumsum(n)
        for i in range(len(n)):
            piece = bits[ends[i] - n[i] : ends[i]]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk[i]], pa.int64()), pa.array([bucket[i]], pa.int32()), pa.array([piece.tobytes()], pa.binary())], schema=_TOLD_ARROW)

    return run


_OUT = "row long, doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary, kept_sha256 string"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_OUT_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", _SPANS), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def _remove(width: int, seed: int, buckets: int, with_text: bool):
    def run(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _OUT_ARROW.empty_table()
        step = lambda k: told(replies.filter(pc.equal(replies.column("step"), k)))
        c = _Chunk(texts, width, seed)
        _, smallest, values, pick, context = c.contexts(answer(step(1), buckets, c.values))
        bits = np.zeros(len(values), np.uint64)
        found = step(2)
        numbers = (values % np.uint64(buckets)).astype(np.int32)
        for b, blob in found.items():
            bits[numbers == b] = np.frombuffer(blob, np.uint64)
        known = np.full(len(c.sites), -1)
        known[pick] = context
        which = known[c.anchor_of] if len(c.windows) else c.windows
        live = np.flatnonzero(which >= 0)
        start, which = c.windows[live], which[live]
        anchor = c.anchor_of[live]
        left = (c.sites[anchor] - start).astype(np.uint64)
        gone = (c.docs[anchor] > smallest[which]) | ((bits[which] >> left) & np.uint64(1) > 0)
        cut = A.covered(start[gone], width, len(c.data))
        rows = []
        for i, (row, doc) in enumerate(zip(texts.column(0).to_pylist(), texts.column("doc_id").to_pylist(), strict=True)):
            part = slice(c.offsets[i], c.offsets[i + 1])
            kept = c.data[part][~cut[part]].tobytes()
            from_, to = A.runs(cut[part])
            rows.append((row, None if doc == LAST else doc, len(cut[part]), int(cut[part].sum()), [{"start": s, "end": e} for s, e in zip(from_.tolist(), to.tolist(), strict=True)], kept if with_text else None, hashlib.sha256(kept).hexdigest()))
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_OUT_ARROW)], schema=_OUT_ARROW)

    return run


def repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id (a null one is the largest long), n_bytes, n_removed, removed byte spans, the bytes that stay, and their SHA-256."""
    texts, buckets = chunked(docs)
    seeds = compared(texts.groupBy("chunk").applyInArrow(_first_digit(width, seed, buckets), ASKED), buckets)
    sent = texts.groupBy("chunk").cogroup(seeds.groupBy("chunk")).applyInArrow(_send(width, seed, buckets), _SENT)
    found = sent.repartition(buckets, "bucket").mapInArrow(_sort(width, seed), _TOLD)
    replies = seeds.withColumn("step", F.lit(1)).unionByName(found.withColumn("step", F.lit(2)))
    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_remove(width, seed, buckets, with_text), _OUT)


def op7(spark, sf_dir: str) -> DataFrame:
    rows = repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


#: Bytes are two hexadecimal digits each; a text is cut into pieces of 250 bytes and 49 more, so that a window is a short substring.
SQL = """
with h as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
piece as (select doc_id, p, substring(h, 500 * p + 1, 598) s from (select doc_id, h, unnest(range(0, (len(h) + 499) // 500)) p from h)),
win as (select doc_id, 250 * p + k pos, substring(s, 2 * k + 1, 100) g from (select doc_id, p, s, unnest(range(0, least(250, len(s) // 2 - 49))) k from piece where len(s) >= 100)),
r as (select doc_id, pos from win qualify min(doc_id) over (partition by g) < doc_id),
gone as (select distinct doc_id, pos + k pos from r, range(50) t(k)),
byt as (select doc_id, 250 * p + k pos, substring(s, 2 * k + 1, 2) b from (select doc_id, p, s, unnest(range(0, least(250, len(s) // 2))) k from piece)),
mark as (
  select byt.*, gone.pos is not null cut, lag(gone.pos is not null, 1, false) over (partition by byt.doc_id order by byt.pos) before
  from byt left join gone on byt.doc_id = gone.doc_id and byt.pos = gone.pos),
kept as (
  select doc_id, count(*) filter (where cut) n_removed, count(*) filter (where cut and not before) n_spans,
         sha256(unhex(coalesce(string_agg(b, '' order by pos) filter (where not cut), ''))) kept_sha256
  from mark group by doc_id)
select h.doc_id, cast(len(h) // 2 as bigint) n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans,
       coalesce(kept_sha256, sha256('')) kept_sha256
from h left join kept on h.doc_id = kept.doc_id
"""
