"""Grouping of spelling variants by blocked Gram matrices of letter counts.

A word is a vector of letter counts. One inserted or deleted letter moves it by a squared distance of 1, one replaced letter
by 2. For a block of words, NumPy's product of the count matrix with itself gives all these distances at once; pairs at 1
between adjacent lengths and at 2 within a length are candidates, whose spelling is then compared letter by letter.

Blocks are no larger than they must be. The alphabet is dealt to ``m`` groups of letters; one edit changes the counts of
two groups at most, so two near words agree in the counts of all other groups. Words meet in a block if they agree there,
for each choice of two groups left out, and if their lengths are equal or adjacent. This loses no pair, and a vocabulary that
grows gets more groups, so that blocks stay small. A block larger than ``TILE`` words or ``TILE_BYTES`` is cut by a hash of
the word, and its parts meet pair by pair in tasks of their own. A pair is told in the first block where it meets.

A word's form is its near word with the most occurrences, if that has ``RATIO`` times the word's own; the root is found by
following forms, which doubles its reach in each round, so five rounds reach the end of any chain.

At scale: one scan counts words inside tasks, in tables flushed at a bounded size. What follows works on the vocabulary: a
row for each word and block, dealt by block. A word has at most some 180 near words for each of its letters, so the counts of near words are bounded.

Defined results: a null text has no words; a null doc_id reads ``null`` where runs are altered. Rows with one doc_id are
altered alike. Of near words with equal counts the first in code-point order is the form. Extra columns do not matter; an empty table gives no
rows. Words may have up to 60 million letters, where distances are still exact.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm import textarrays as A
from terrane.llm.common import discard, stash

SHORTEST = 7
LEAST = 2
RATIO = 10
EVERY = 31  # a run is altered if this divides its hash
KEEP_WORDS = 300_000
SLICE = 4 << 20
TILE = 2_048
TILE_BYTES = 16 << 20
WORDS_EACH = 1_000_000  # words from which each tenfold vocabulary gets one more group of letters
MOST_GROUPS = 7
LETTERS = bytes([*range(97, 123), *range(0xC0, 0x100)])
_PLACE = np.full(256, -1, np.int64)
_PLACE[list(LETTERS)] = np.arange(len(LETTERS))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_WEIGHTS = np.random.default_rng(11).integers(1, 1 << 63, len(LETTERS), dtype=np.uint64)


def runs(text: str) -> list[bytes]:
    """Runs of A to Z, a to z and U+00C0 to U+00FF as Latin-1 bytes, A to Z in lower case."""
    return text.encode("latin-1", "replace").translate(_LOWER).split()


def altered(run: bytes, start: int) -> bytes:
    """The run without the letter that the hash names, if it names one; ``start`` is the hash of what stands before the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % EVERY == 0 else run


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least ``SHORTEST`` letters with at least ``LEAST`` occurrences in ``docs`` (doc_id, text)."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        total: Counter = Counter()

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(total.values(), pa.int64())], schema=schema)
            total.clear()

        for batch in A.slices(batches, "text", SLICE):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{'null' if key is None else key}:".encode())
                for w, n in Counter([w for w in runs(text or "") if len(w) >= SHORTEST]).items():
                    w = altered(w, start)
                    if len(w) >= SHORTEST:
                        total[w] += n
            if len(total) > KEEP_WORDS:
                yield from flush()
        yield from flush()

    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(A.tidy(run), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def letter_groups(vocabulary: DataFrame) -> np.ndarray:
    """The group of each letter, balanced by how often words have it. More words get more groups."""
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    seen = letters.groupBy("letter").agg(F.count("*").alias("n")).collect()  # one row for each letter of the alphabet
    n = Counter({r["letter"]: r["n"] for r in seen})
    size = vocabulary.count()
    m = min(MOST_GROUPS, 3 + (int(math.log10(size / WORDS_EACH)) + 1 if size > WORDS_EACH else 0))
    load, found = [0] * m, np.zeros(len(LETTERS), np.int64)
    for letter in sorted(LETTERS.decode("latin-1"), key=lambda c: (-n[c], c)):
        g = load.index(min(load))
        load[g] += n[letter] + 1
        found[LETTERS.index(letter.encode("latin-1"))] = g
    return found


class Batch:
    """The words of an Arrow batch as arrays: lengths, letter counts, and for each choice of groups left out a hash of the other counts."""

    def __init__(self, column: pa.Array, groups: np.ndarray):
        self.words = [w.encode("latin-1") for w in column.to_pylist()]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        places = _PLACE[np.frombuffer(b"".join(self.words), np.uint8)]
        width = len(LETTERS)
        self.counts = np.bincount(np.repeat(np.arange(len(self.words)), self.sizes) * width + places, minlength=len(self.words) * width).reshape(-1, width)
        m = groups.max() + 1
        weighted = self.counts.astype(np.uint64) * _WEIGHTS
        each = np.stack([weighted[:, groups == g].sum(axis=1) for g in range(m)], axis=1)
        self.keys = np.stack([each[:, [g for g in range(m) if g not in out]].sum(axis=1) for out in combinations(range(m), 2)], axis=1).view(np.int64)


def blocks(vocabulary: DataFrame, groups: np.ndarray) -> DataFrame:
    """(word, n, size, choice, key, low): each word for each choice of groups left out, in the block of its own length and in that of the length below."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("size", pa.int64()), ("choice", pa.int32()), ("key", pa.int64())])

    def run(batches):
        for batch in A.slices(batches, "word", SLICE):
            b = Batch(batch.column("word"), groups)
            for choice in range(b.keys.shape[1]):
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(b.sizes), pa.array(np.full(len(b.words), choice, np.int32)), pa.array(b.keys[:, choice])], schema=schema)

    rows = vocabulary.select("word", "n").mapInArrow(A.tidy(run), "word string, n long, size long, choice int, key long")
    return rows.withColumn("low", F.explode(F.array(F.col("size"), F.col("size") - 1)))


def _apart(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """Which pairs of words, each of one length for all, differ by one edit."""
    a = np.frombuffer(b"".join(one), np.uint8).reshape(len(one), -1)
    b = np.frombuffer(b"".join(two), np.uint8).reshape(len(two), -1)
    if a.shape == b.shape:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    ahead, behind = a != b[:, :n], a[:, ::-1] != b[:, :0:-1]
    run = lambda x: np.where(x.any(axis=1), x.argmax(axis=1), n)
    return run(ahead) + run(behind) >= n


def _near(batch: Batch, own: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words of a block: within ``own``, all of one length, and between it and ``longer``, one letter more."""
    rows = np.concatenate((own, longer))
    size = int(batch.sizes[own[0]])
    x = batch.counts[rows]
    x = x[:, x.any(axis=0)].astype(np.float32 if size < 2_000 else np.float64)
    square = (x * x).sum(axis=1)
    apart = square[: len(own), None] + square[None, :] - 2 * (x[: len(own)] @ x.T)  # the Gram matrix as squared distances
    wanted = np.ones(len(rows))
    wanted[: len(own)] = 2
    i, j = np.nonzero(apart == wanted)
    keep = (j > i) | (j >= len(own))
    i, j = rows[i[keep]], rows[j[keep]]
    fits = np.zeros(len(i), bool)
    step = max(1, SLICE // size)
    for same in (True, False):
        part = np.flatnonzero((batch.sizes[j] == size) == same)
        for at in range(0, len(part), step):
            some = part[at : at + step]
            fits[some] = _apart([batch.words[k] for k in i[some]], [batch.words[k] for k in j[some]])
    return i[fits], j[fits]


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, in both directions."""
    groups = letter_groups(vocabulary)
    entries = stash(blocks(vocabulary, groups), "blocks")
    block = ["choice", "key", "low"]
    large = entries.groupBy(*block).agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).where((F.col("rows") > TILE) | (F.col("bytes") > TILE_BYTES))
    large = large.select(*block, F.greatest(F.ceil(F.col("rows") / TILE), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int").alias("tiles"))
    tiled = entries.join(large, block, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.withColumn("lo", F.least("tile", "other")).withColumn("hi", F.greatest("tile", "other")).select(*block, "lo", "hi", "tile", "size", "word", "n")
    place = [*block, "lo", "hi"]
    kinds = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def found(rows: pa.RecordBatch, starts: np.ndarray):
        b = Batch(rows.column("word"), groups)
        column = lambda name: rows.column(name).to_numpy(zero_copy_only=False)
        choice, low, lo, hi, tile, n = (column(c) for c in ("choice", "low", "lo", "hi", "tile", "n"))
        own = b.sizes == low
        ends = np.append(starts[1:], len(b.words))
        owned = np.add.reduceat(own, starts) if len(starts) else starts
        some = (owned > 0) & (ends - starts > 1)
        one, two = [], []
        for start, end in zip(starts[some], ends[some], strict=True):
            at = np.arange(start, end)
            i, j = _near(b, at[own[start:end]], at[~own[start:end]])
            if lo[start] != hi[start]:  # two parts of a large block
                across = tile[i] != tile[j]
                i, j = i[across], j[across]
            one.append(i)
            two.append(j)
        if one:
            i, j = np.concatenate(one), np.concatenate(two)
            first = (b.keys[i] == b.keys[j]).argmax(axis=1) == choice[i]
            i, j = np.concatenate((i[first], j[first])), np.concatenate((j[first], i[first]))
            word = rows.column("word")
            yield pa.RecordBatch.from_arrays([word.take(pa.array(i)), word.take(pa.array(j)), pa.array(n[j])], schema=kinds)

    def run(batches):
        rest = None
        for batch in A.slices(batches, "word", SLICE):
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in place])
            starts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1))
            last = int(starts[-1])  # its block may go on in the next batch
            if last:
                yield from found(batch.slice(0, last), starts[:-1])
            rest = batch.slice(last)
        if rest is not None:
            yield from found(rest, np.zeros(1, np.int64))

    return tiled.repartition(*place).sortWithinPartitions(*place).mapInArrow(A.tidy(run), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form), which is followed to its end. Forms have more occurrences than their words, so chains end."""
    found = stash(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stash(found.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(found)
        found = after
        if not found.where("moved").limit(1).count():
            return found.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of ``docs`` (doc_id, text)."""
    vocabulary = stash(words(docs), "words")
    near = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    joined = vocabulary.join(near, "word", "left")
    form = -F.col("best.n") >= RATIO * F.col("n")
    rows = stash(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best.word")).alias("form"), F.when(form, -F.col("best.n")).alias("form_n")), "forms")
    found = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("word", "form", "root", "n", "n_near", "form_n")
