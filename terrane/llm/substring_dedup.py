"""Substring dedup by seed and extend, over words.

Every window of 35 words has one anchor: the lowest-hashed seed of 8 words in it (winnowing). Equal windows have equal
anchors, so documents meet on the hashes of anchors. Seeds that occur only once end there. Those that remain are extended
both ways, by l words to the left and 27 - l to the right for each l that leaves the seed the anchor, and the extensions meet
once more, by BLAKE2 digests of 128 bits over their whole bytes. Adjacent repeated windows join to maximal repeats; their words are removed.

At scale: three shuffles. The text moves once (all three passes over it read one exchange), then 8 bytes for each distinct
anchor of a chunk, about one for 14 words, then 16 bytes for each window of repeated seeds. A passage in a third of all
documents is sent once for each chunk of about 4 MB, not for each document, and no pairs of documents are made. Extensions are
dealt by their own digest, so a hot seed with many surroundings is spread over all buckets. Memory is that of a chunk,
which holds whole texts, so it grows with the longest text.

Defined results: a null text has no words; texts shorter than the window are left alone. Repeated rows are repeats like
any others, so both lose their windows, as the contract judges windows and not documents. Seeds are sought by hashes that
may agree by chance, which only sends more extensions; what is removed is decided by the digests. Extra columns and
clashing names do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm import textarrays as A
from terrane.llm.survivors import ASKED, LAST, answer, asked, chunked, compared, told

WIDTH = 35
SEED = 8


def _seeds(texts: pa.Table, width: int, seed: int):
    """The chunk's word spans, text offsets in words, word hashes, window starts with their anchors, and seed hashes."""
    data, offsets = A.joined(texts.column("text"))
    starts, ends, first = A.words(data, offsets)
    hashes = A.spans_hash(data, starts, ends)
    windows, at, grams = A.anchors(hashes, first, width, seed)
    return data, starts, ends, first, hashes, windows, at, grams


def _distinct_seeds(at: np.ndarray, grams: np.ndarray):
    """Distinct anchors' hashes, which of them each window has, and the marks of those at several sites."""
    sites, back = np.unique(at, return_inverse=True)
    values, place, count = A.unique(grams[sites])
    return values, place[back] if len(at) else at, count > 1


def _ask_seeds(width: int, seed: int, buckets: int):
    def run(texts: pa.Table) -> pa.Table:
        *_, at, grams = _seeds(texts, width, seed)
        values, _, marks = _distinct_seeds(at, grams)
        return asked(texts.column("chunk")[0].as_py(), buckets, values, marks)

    return run


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """Two 64-bit words for each window: the BLAKE2 digest of its words, joined by one space."""
    size = ends - starts
    head = np.cumsum(size + 1) - size - 1
    letters = np.arange(size.sum())
    plain = np.full(int(size.sum() + len(size)), 0x20, np.uint8)
    before = np.cumsum(size) - size
    plain[letters + np.repeat(head - before, size)] = data[letters + np.repeat(starts - before, size)]
    last = windows + width - 1
    view = memoryview(plain)
    found = [hashlib.blake2b(view[s:e], digest_size=16).digest() for s, e in zip(head[windows].tolist(), (head[last] + size[last]).tolist(), strict=True)]
    return np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)


def _extended(texts: pa.Table, seeds: pa.Table, width: int, seed: int, buckets: int):
    """Windows whose seed is repeated, with their distinct digests, the place among those, and marks."""
    data, starts, ends, first, hashes, windows, at, grams = _seeds(texts, width, seed)
    values, which, _ = _distinct_seeds(at, grams)
    windows = windows[answer(told(seeds), buckets, values)[which]] if len(windows) else windows
    if not len(windows):
        return data, starts, ends, first, windows, np.zeros((0, 2), np.uint64), windows, np.zeros(0, bool)
    pair = _digests(data, starts, ends, windows, width)
    order = np.lexsort(pair.T[::-1])
    ranked = pair[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    group = np.cumsum(new) - 1
    place = np.empty(len(ranked), np.int64)
    place[order] = group
    return data, starts, ends, first, windows, ranked[new], place, np.bincount(group) > 1


def _extend(width: int, seed: int, buckets: int):
    def run(texts: pa.Table, seeds: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return asked(0, buckets, np.zeros((0, 2), np.uint64), np.zeros(0, bool))
        *_, pairs, _, marks = _extended(texts, seeds, width, seed, buckets)
        return asked(texts.column("chunk")[0].as_py(), buckets, pairs, marks)

    return run


_OUT = "row long, doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string, kept_sha256 string"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_OUT_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", _SPANS), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def _remove(width: int, seed: int, buckets: int, with_text: bool):
    def run(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _OUT_ARROW.empty_table()
        pass_one = replies.filter(pc.equal(replies.column("step"), 1))
        pass_two = replies.filter(pc.equal(replies.column("step"), 2))
        data, starts, ends, first, windows, pairs, place, marks = _extended(texts, pass_one, width, seed, buckets)
        repeated = answer(told(pass_two), buckets, pairs) | marks
        gone = A.covered(windows[repeated[place]] if len(windows) else windows, width, len(starts))
        raw = data.tobytes()
        rows = []
        for i, (row, doc) in enumerate(zip(texts.column(0).to_pylist(), texts.column("doc_id").to_pylist(), strict=True)):
            a, b = first[i], first[i + 1]
            cut = gone[a:b]
            keep = np.flatnonzero(~cut) + a
            kept = b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)])
            from_, to = A.runs(cut)
            rows.append((row, None if doc == LAST else doc, int(b - a), int(cut.sum()), [{"start": s, "end": e} for s, e in zip(from_.tolist(), to.tolist(), strict=True)], kept.decode() if with_text else None, hashlib.sha256(kept).hexdigest()))
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_OUT_ARROW)], schema=_OUT_ARROW)

    return run


def repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id (a null one is the largest long), n_words, n_removed, the maximal repeats as word spans, the text that stays, and its SHA-256."""
    texts, buckets = chunked(docs)
    seeds = compared(texts.groupBy("chunk").applyInArrow(_ask_seeds(width, seed, buckets), ASKED), buckets)
    windows = texts.groupBy("chunk").cogroup(seeds.groupBy("chunk")).applyInArrow(_extend(width, seed, buckets), ASKED)
    found = compared(windows, buckets, 2)
    replies = seeds.withColumn("step", F.lit(1)).unionByName(found.withColumn("step", F.lit(2)))
    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_remove(width, seed, buckets, with_text), _OUT)


def op9(spark, sf_dir: str) -> DataFrame:
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 34], ' ') g from (select doc_id, ws, unnest(range(1, len(ws) - 33)) i from w where len(ws) >= 35)),
r as (select doc_id, i from win qualify count(*) over (partition by g) > 1),
gone as (select distinct doc_id, i + k j from r, range(35) t(k)),
words as (select doc_id, ws[j] word, j from (select doc_id, ws, unnest(range(1, len(ws) + 1)) j from w)),
kept as (
  select words.doc_id, count(*) filter (where gone.j is not null) n_removed,
         sha256(coalesce(string_agg(word, ' ' order by words.j) filter (where gone.j is null), '')) kept_sha256
  from words left join gone on words.doc_id = gone.doc_id and words.j = gone.j group by words.doc_id)
select w.doc_id, cast(len(ws) as bigint) n_words, coalesce(n_removed, 0) n_removed, coalesce(kept_sha256, sha256('')) kept_sha256
from w left join kept on w.doc_id = kept.doc_id
"""
