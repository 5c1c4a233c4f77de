"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

The index has three tables. ``refs`` has one row per document and distinct line key; ``counts`` has for each key the
number of documents and the first of them; ``filters`` has for each shard of keys two cuckoo filters, of the keys that are
known and of those that at least two documents hold. Inserting documents screens their keys by the first filter: only keys
that may be known meet the exact table. Removing repeated lines screens keys by the second: only keys that may be repeated
meet it. Cuckoo filters also delete, so taking documents out again restores the index exactly.

At scale: keys travel as 16-byte digests. Filters have a bounded number of keys each (``SHARD_KEYS`` on average) and are
streamed to the rows of their shard; rows of a shard are salted, so a line in a third of all documents is probed in many
tasks. Reference counts are partial sums. Text moves once, to meet its own dropped keys.

Defined results: a null or empty text is one empty line. Keys are lines stripped of white space at both ends, A-Z in lower
case; shorter than ``MIN_CHARS`` code points they are never dropped. A repeated key keeps all its lines in the smallest
doc_id that holds it, a null doc_id counting as the largest; rows with one doc_id are one document, so they do not remove each
other's lines. Extra columns and clashing names do not matter; an empty table gives no rows. Documents to insert must not be
in the index yet: replace a document by deleting it first.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import ROW, keyed, stash, with_rows
from terrane.llm.textarrays import slices, tidy

MIN_CHARS = 10
SHARD_KEYS = 1 << 15
SALTS = 8
SLOTS = 4
_STRIP = b" \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1


def line_digests(text: bytes, min_chars: int = MIN_CHARS) -> tuple[list[bytes], list[bytes | None]]:
    """The lines, and for each the 16-byte digest of its key, None if the key is too short."""
    lines = text.split(b"\n")
    keys = [x.strip(_STRIP).lower() for x in lines]
    long = lambda k: len(k) >= 4 * min_chars or (len(k) >= min_chars and len(k.decode()) >= min_chars)
    return lines, [hashlib.blake2b(k, digest_size=16).digest() if long(k) else None for k in keys]


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints in buckets of four, as one numpy array that can be stored as bytes."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)
        self.mask = np.uint64(len(self.slots) - 1)

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1
        while buckets * SLOTS * 0.85 < max(1, keys):
            buckets *= 2
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    @classmethod
    def of(cls, digests: np.ndarray) -> Cuckoo:
        """A filter of distinct digests; it is doubled until all have a place."""
        size = len(digests)
        while True:
            f = cls.sized(size)
            if f.add(digests):
                return f
            size = max(2 * size, 8)

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).copy())

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _where(self, digests: np.ndarray):
        words = digests.view(np.uint64).reshape(-1, 2)
        prints = (words[:, 0] >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = words[:, 1] & self.mask
        return prints, one, one ^ self._jump(prints)

    def _jump(self, prints):
        return (prints.astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(3)) & self.mask

    def _fill(self, at: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Puts fingerprints into free slots of their buckets; which of them found none."""
        order = np.argsort(at, kind="stable")
        ranked = at[order].astype(np.int64)
        heads = np.flatnonzero(np.diff(np.concatenate(([-1], ranked)))) if len(ranked) else np.zeros(0, np.int64)
        rank = np.arange(len(ranked)) - np.repeat(heads, np.diff(np.append(heads, len(ranked))))
        free = np.argsort(self.slots[ranked] != 0, axis=1, kind="stable")
        room = (self.slots[ranked] == 0).sum(axis=1)
        fits = rank < room
        self.slots[ranked[fits], free[fits, rank[fits]]] = prints[order][fits]
        left = np.ones(len(at), bool)
        left[order[fits]] = False
        return left

    def add(self, digests: np.ndarray) -> bool:
        """False if a fingerprint found no place; the filter is then to be built anew, larger."""
        if not len(digests):
            return True
        prints, one, two = self._where(digests)
        left = np.flatnonzero(self._fill(one, prints))
        left = left[self._fill(two[left], prints[left])]
        turn = np.random.default_rng(len(digests))
        for i in left.tolist():
            at, mark = int(two[i]), prints[i]
            for _ in range(500):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = mark
                    break
                k = int(turn.integers(SLOTS))
                mark, self.slots[at, k] = self.slots[at, k], mark
                at = int(np.uint64(at) ^ self._jump(np.array([mark], np.uint16))[0])
            else:
                return False
        return True

    def remove(self, digests: np.ndarray) -> None:
        """Takes out digests that are in the filter."""
        for mark, *buckets in zip(*self._where(digests), strict=True):
            for at in map(int, buckets):
                found = np.flatnonzero(self.slots[at] == mark)
                if len(found):
                    self.slots[at, found[0]] = 0
                    break

    def has(self, digests: np.ndarray) -> np.ndarray:
        prints, one, two = self._where(digests)
        return ((self.slots[one] == prints[:, None]) | (self.slots[two] == prints[:, None])).any(axis=1)


def _array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 16)


@dataclass
class LineIndex:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    shard_keys: int = SHARD_KEYS


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(row, doc, digest): one row per row of ``docs`` and distinct line key."""
    schema = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for batch in slices(batches, "text", 8 << 20):
            rows, ids, found = [], [], []
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in (ROW, "doc", "text")), strict=True):
                keys = dict.fromkeys(k for k in line_digests((text or "").encode(), min_chars)[1] if k)
                rows += [row] * len(keys)
                ids += [doc] * len(keys)
                found += keys
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(found, pa.binary())], schema=schema)

    d = with_rows(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(tidy(run), "row long, doc long, digest binary")


def counted(refs: DataFrame) -> DataFrame:
    """(digest, n_docs, first): the exact reference counts and the first document of each key; rows with one doc_id count once."""
    return refs.groupBy("digest", "doc").agg(F.count("*")).groupBy("digest").agg(F.count("*").alias("n_docs"), F.min("doc").alias("first"))


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _filters(counts: DataFrame, shards: int) -> DataFrame:
    schema = pa.schema([("shard", pa.int32()), ("known", pa.binary()), ("repeated", pa.binary())])

    def build(key, table):
        digests = _array(table.column("digest"))
        often = table.column("n_docs").to_numpy() > 1
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([Cuckoo.of(digests).dump()], pa.binary()), pa.array([Cuckoo.of(digests[often]).dump()], pa.binary())], schema=schema)

    return counts.select("digest", "n_docs", _shard(shards).alias("shard")).groupBy("shard").applyInArrow(build, "shard int, known binary, repeated binary")


def build(docs: DataFrame, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The index of a table of documents."""
    refs = stash(references(docs, min_chars), "refs")
    counts = stash(counted(refs), "counts")
    shards = max(1, -(-counts.count() // shard_keys))
    return LineIndex(refs, counts, stash(_filters(counts, shards), "filters"), shards, shard_keys)


def screened(keys: DataFrame, index: LineIndex, which: str) -> DataFrame:
    """The rows of ``keys`` whose digest the filter ``which`` (known or repeated) may hold; its columns are unchanged."""
    columns = keys.columns
    salted = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int") if "row" in columns else F.lit(0)
    probes = keys.select(_shard(index.shards).alias("shard"), salted.alias("salt"), F.lit(None).cast("binary").alias("filter"), *columns)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1 if "row" in columns else 0)))
    filters = index.filters.select("shard", salts.alias("salt"), F.col(which).alias("filter"))
    stream = probes.unionByName(filters, allowMissingColumns=True)

    def run(batches):
        now, at = None, None
        for batch in batches:
            shard, filters = batch.column("shard").to_numpy(zero_copy_only=False), batch.column("filter")
            salt = batch.column("salt").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(np.concatenate(([-1], shard.astype(np.int64) * SALTS + salt))))
            edges = sorted({0, *edges.tolist()})
            for start, end in zip(edges, [*edges[1:], batch.num_rows], strict=True):
                if filters[start].is_valid:
                    now, at, start = Cuckoo.load(filters[start].as_py()), (shard[start], salt[start]), start + 1
                if start == end or now is None or at != (shard[start], salt[start]):
                    continue
                rows = batch.slice(start, end - start)
                hit = rows.filter(pa.array(now.has(_array(rows.column("digest")))))
                if hit.num_rows:
                    yield hit.select(columns)

    dealt = stream.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.desc_nulls_last("filter"))
    return dealt.mapInArrow(tidy(run), keys.schema)


def insert(index: LineIndex, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineIndex:
    """The index with more documents. Row keys of the new documents follow those of the old."""
    base = index.refs.agg(F.coalesce(F.max("row"), F.lit(-1))).first()[0] + 1
    refs = stash(references(docs, min_chars).withColumn("row", F.col("row") + base), "refs")
    new = stash(counted(refs), "new")
    may = screened(new, index, "known").select("digest")
    met = index.counts.join(may, "digest", "left_semi")
    both = stash(new.unionByName(met).groupBy("digest").agg(F.sum("n_docs").alias("n_docs"), F.min("first").alias("first")), "touched")
    old = met.select("digest", F.col("n_docs").alias("before"))
    change = both.join(old, "digest", "left").withColumn("before", F.coalesce("before", F.lit(0)))
    counts = stash(index.counts.join(both, "digest", "left_anti").unionByName(both), "counts")
    refs, n = stash(index.refs.unionByName(refs), "refs"), counts.count()
    if n > 2 * index.shards * index.shard_keys:  # filters stay of bounded size: more shards, built anew
        shards = -(-n // index.shard_keys)
        return LineIndex(refs, counts, stash(_filters(counts, shards), "filters"), shards, index.shard_keys)
    return LineIndex(refs, counts, stash(_changed(index, change.select("digest", "before", F.col("n_docs").alias("after"))), "filters"), index.shards, index.shard_keys)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents in ``doc_ids`` (one column, doc_id): the state as if they had never been inserted."""
    ids = doc_ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")).distinct()
    refs = stash(index.refs.join(ids, "doc", "left_anti").select("row", "doc", "digest"), "refs")
    touched = stash(index.refs.join(ids, "doc", "left_semi").select("digest").distinct(), "touched")
    left = stash(counted(refs.join(touched, "digest", "left_semi")), "left")
    change = index.counts.join(touched, "digest", "left_semi").select("digest", F.col("n_docs").alias("before")).join(left.select("digest", F.col("n_docs").alias("after")), "digest", "left")
    counts = stash(index.counts.join(touched, "digest", "left_anti").unionByName(left), "counts")
    return LineIndex(refs, counts, stash(_changed(index, change.select("digest", "before", F.coalesce("after", F.lit(0)).alias("after"))), "filters"), index.shards, index.shard_keys)


def _changed(index: LineIndex, change: DataFrame) -> DataFrame:
    """The filters after counts went from ``before`` to ``after``. A filter that overflows is marked null and built anew by the caller's counts."""
    schema = pa.schema([("shard", pa.int32()), ("known", pa.binary()), ("repeated", pa.binary())])

    def grown(data: bytes | None, add: np.ndarray, remove: np.ndarray) -> bytes:
        f = Cuckoo.load(data) if data else Cuckoo.sized(len(add))
        f.remove(remove)
        while not f.add(add):
            raise OverflowError("rebuild")
        return f.dump()

    def run(key, old, new):
        shard = key[0].as_py()
        digests, before, after = _array(new.column("digest")), new.column("before").to_numpy(), new.column("after").to_numpy()
        out = []
        for name, least in (("known", 1), ("repeated", 2)):
            data = old.column(name)[0].as_py() if old.num_rows else None
            try:
                out.append(grown(data, digests[(before < least) & (after >= least)], digests[(before >= least) & (after < least)]))
            except OverflowError:
                out.append(None)
        return pa.table([pa.array([shard], pa.int32()), pa.array([out[0]], pa.binary()), pa.array([out[1]], pa.binary())], schema=schema)

    dealt = change.withColumn("shard", _shard(index.shards))
    made = stash(index.filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(run, "shard int, known binary, repeated binary"), "filters")
    full = made.where("known is null or repeated is null").select("shard")
    if full.isEmpty():
        return made
    # counts after the change, of the overfull shards only
    counts = index.counts.join(change.select("digest"), "digest", "left_anti").select("digest", "n_docs").unionByName(change.where("after > 0").select("digest", F.col("after").alias("n_docs")))
    again = _filters(counts.withColumn("shard", _shard(index.shards)).join(full, "shard", "left_semi"), index.shards)
    return made.join(full, "shard", "left_anti").unionByName(again)


def dropped_keys(index: LineIndex) -> DataFrame:
    """(row, digest) of the keys that a document loses: screened by the filters, decided by the exact counts."""
    may = screened(index.refs.select("row", "doc", "digest"), index, "repeated")
    repeated = index.counts.where("n_docs > 1").select("digest", "first")
    return may.join(repeated, "digest").where("doc != first").select("row", "digest")


_OUT = "row long, doc_id long, n_lines long, n_dropped long, kept_text string, kept_sha256 string"
_OUT_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def without(docs: DataFrame, dropped: DataFrame, min_chars: int = MIN_CHARS, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs`` without its dropped keys: row key, doc_id, n_lines, n_dropped, kept text and its SHA-256."""

    def run(batches):
        for batch in slices(batches, "text", 8 << 20):
            out = []
            for row, doc, text, gone in zip(*(batch.column(c).to_pylist() for c in (ROW, "doc_id", "text", "gone")), strict=True):
                raw = (text or "").encode()
                n, cut = raw.count(b"\n") + 1, 0
                if gone:
                    gone = set(gone)
                    lines, keys = line_digests(raw, min_chars)
                    keep = [x for x, k in zip(lines, keys, strict=True) if k not in gone]
                    cut, raw = n - len(keep), b"\n".join(keep)
                out.append((row, doc, n, cut, raw.decode() if with_text else None, hashlib.sha256(raw).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_OUT_ARROW)], schema=_OUT_ARROW)

    d = with_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lost = dropped.groupBy(F.col("row").alias(ROW)).agg(F.collect_list("digest").alias("gone"))
    return d.join(lost, ROW, "left").mapInArrow(tidy(run), _OUT)


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, with_text: bool = True) -> DataFrame:
    """Builds the index of ``docs`` and removes the lines that an earlier document holds."""
    docs = keyed(docs, "doc_id", "text")
    index = build(docs, min_chars)
    return without(docs, dropped_keys(index), min_chars, with_text)


def op6(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


SQL = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select doc_id, i, ls[i] line from (select doc_id, ls, unnest(range(1, len(ls) + 1)) i from d)),
k as (select doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
c as (select key, min(doc_id) first from k where len(key) >= 10 group by key having count(distinct doc_id) >= 2),
m as (select k.doc_id, k.i, k.line, coalesce(c.first < k.doc_id, false) gone from k left join c on k.key = c.key)
select doc_id, count(*) n_lines, count(*) filter (where gone) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) kept_sha256
from m group by doc_id
"""
