"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

Texts are marked (white space becomes the mark U+2581, one is put in front) and cut before each run of marks, where no piece of the
vocabulary crosses. The distinct words of a batch are sorted and walked as a trie, depth first: from one word to the next
only the positions after their common prefix are computed, all forward scores before it are reused. At each position the
best piece that ends there is found from the forward scores of the positions before; following the pieces back gives the
word's ids.

Unigram models take the path with the highest sum of scores. For a BPE model, whose ids follow merge order, the lattice
only has the transitions that merging allows: two pieces may follow each other if merging their concatenation gives those
two. Every prefix then has one admissible path, the merge result, and the same walk finds it. Runs of marks are merged
last of all, so they are joined to their word afterwards. The vocabulary comes from a model file, a parameter; nothing is trained.

At scale: no shuffle at all. A task keeps a bounded table of words already encoded and drops it when full, so memory does not
grow with the corpus; it ends with the task. (Sending words through a shuffle to one dictionary and back would move each word
of each text twice.) The vocabulary, whose size is the model file's, reaches the workers as one broadcast. Encoding and
decoding back can be one pass, so that ids need not go from Python to the JVM and back to Python.

Defined results: a null or empty text has no ids and decodes to the empty text. Characters that are not in the vocabulary
become byte pieces, or the unknown piece if the model has none. Decoding gives back every text without U+2581 itself.
Repeated rows are encoded alike; extra columns pass through, but a column named as the result is replaced; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm import textarrays as A

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KEEP_WORDS = 120_000
KEEP_PAIRS = 250_000
SLICE = 8 << 20  # bytes of text whose distinct words are sorted together
SHIFT = 1 << 20
_NO = float("-inf")


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, i


def _fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """The fields of one message of the model file: (number, value)."""
    out, i = [], 0
    while i < len(data):
        tag, i = _varint(data, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(data, i)
        elif kind == 2:
            n, i = _varint(data, i)
            value, i = data[i : i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            value, i = data[i : i + n], i + n
        out.append((tag >> 3, value))
    return out


@dataclass
class Vocabulary:
    """Pieces, scores and kinds of a model file, and the tables that a task builds from them."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # fixed values of the format: 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
    bpe: bool
    dummy_prefix: bool
    key: str
    ids: dict[str, int] = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """Reads the model file on the driver."""
        data = Path(path).read_bytes()
        top = _fields(data)
        rows = [dict(_fields(v)) for n, v in top if n == 1]
        trainer = dict(_fields(next((v for n, v in top if n == 2), b"")))
        normal = dict(_fields(next((v for n, v in top if n == 3), b"")))
        if normal.get(2) or normal.get(4, 1):
            raise ValueError("only models without character rewriting and without white space removal are supported")
        scores = np.frombuffer(b"".join(r.get(2, b"\0\0\0\0") for r in rows), "<f4").astype(float).tolist()
        return cls([r.get(1, b"").decode() for r in rows], scores, [r.get(3, 1) for r in rows], trainer.get(3, 1) == 2, bool(normal.get(3, 1)), hashlib.sha256(data).hexdigest())

    def prepare(self) -> Vocabulary:
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (1, 4)}
        self.code = [np.int32(i).tobytes() for i in range(len(self.pieces))]
        self.rank = {p: self.scores[i] for p, i in self.ids.items()}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(len(self.pieces)) if self.kinds[i] == 6}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == 2), 0)
        self.cut_marks = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.cut_lines = not any("\n" in p for p in self.ids)
        self.ends = _Lengths(self.ids)
        self.follow: dict[int, bool] = {}
        space = MARK.encode()
        raw = [bytes([int(p[1:-1], 16)]) if k == 6 else b"" if k == 3 else b" \xe2\x81\x87 " if k == 2 else p.encode().replace(space, b" ") for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.raw = pa.array(raw, pa.large_binary())
        return self

    def merged(self, text: str) -> list[str]:
        """Plain merging of a short text: the best-scored neighbours first, of equal ones the leftmost."""
        parts, rank = list(text), self.rank
        pairs = [rank.get(a + b, _NO) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            best = max(pairs)
            if best == _NO:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank.get(parts[i - 1] + parts[i], _NO)
            if i < len(pairs):
                pairs[i] = rank.get(parts[i] + parts[i + 1], _NO)
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging leaves two pieces as they are. -1 on the left: the start, or a character outside the vocabulary, which never merges."""
        if len(self.follow) > KEEP_PAIRS:
            self.follow.clear()
        pair = ([self.pieces[left]] if left >= 0 else []) + [self.pieces[right]]
        found = self.follow[left * SHIFT + right] = self.merged("".join(pair)) == pair
        return found

    def symbol_bytes(self, piece: str) -> bytes:
        """The ids of a character outside the vocabulary."""
        return np.array([self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown], np.int32).tobytes()

    def run_ids(self, n: int) -> list[int]:
        """A run of n marks: the merge result, found by halves of equal pieces for long runs."""
        return [self.ids.get(p, self.unknown) for p in self.merged(MARK * n)] if n else []

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as bytes of 32-bit integers, of distinct words. Sorted, the words are the trie in depth-first order; ``score``, ``last`` and ``path`` hold the forward state along the current path: the best sum of scores, its last piece and its ids."""
        find, ends, code, follow, may_follow = self.ids.get, self.ends, self.code, self.follow.get, self.may_follow
        scores = None if self.bpe else self.scores
        out: dict[str, bytes] = {}
        score, last, path, before = [0.0], [-1], [b""], ""
        for word in sorted(words):
            n = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                n += 1
            del score[n + 1 :], last[n + 1 :], path[n + 1 :]
            for i in range(n + 1, len(word) + 1):
                best, start, piece = _NO, i - 1, -1
                for size in ends[word[i - 3 : i] if i > 2 else word[:i]]:
                    j = i - size
                    if j < 0:
                        continue
                    k = find(word[j:i])
                    if k is None:
                        continue
                    if scores is None:
                        ok = follow(last[j] * SHIFT + k)
                        if ok or ok is None and may_follow(last[j], k):
                            start, piece = j, k
                            break  # a prefix has one admissible path
                    elif scores[k] + score[j] > best:
                        best, start, piece = scores[k] + score[j], j, k
                if piece < 0:  # a character outside the vocabulary
                    best, found = score[start] - 100.0, self.symbol_bytes(word[start:i])
                else:
                    found = code[piece]
                score.append(best)
                last.append(piece)
                path.append(path[start] + found)
            before = word
            out[word] = path[-1]
        return out

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts that the ids stand for; ``counts`` has each text's number of ids."""
        pieces = self.raw.take(pa.array(ids))
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = pieces.buffers()[2]
        place = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
        drop = 1 if self.dummy_prefix else 0
        view = memoryview(raw) if raw is not None else memoryview(b"")
        whole = [view[s:e].tobytes() for s, e in zip(place, place[1:], strict=False)]
        return pa.array([(t[drop:] if t[:1] == b" " else t).decode(errors="replace") for t in whole], pa.string())


class _Lengths(dict):
    """By the last three characters of a prefix (fewer at a word's start): the lengths of the pieces that may end there, longest first."""

    def __init__(self, pieces):
        super().__init__()
        self.sizes: dict[str, set[int]] = {}
        for p in pieces:
            self.sizes.setdefault(p[-3:], set()).add(len(p))

    def __missing__(self, tail: str) -> tuple[int, ...]:
        found = set(self.sizes.get(tail, ()))
        for k in range(1, len(tail)):
            found |= {n for n in self.sizes.get(tail[-k:], ()) if n == k}
        lengths = tuple(sorted(found, reverse=True))
        if len(self) < 100_000:
            self[tail] = lengths
        return lengths


_READY: dict[str, Vocabulary] = {}


def ready(given) -> Vocabulary:
    """The broadcast vocabulary with its tables, which serve all tasks of a Python worker, one after another."""
    vocabulary = given.value if hasattr(given, "value") else given
    if vocabulary.key not in _READY:
        _READY.clear()
        _READY[vocabulary.key] = vocabulary.prepare()
    return _READY[vocabulary.key]


class Encoder:
    """Encodes texts; keeps the words of the last batches in two generations of bounded size."""

    def __init__(self, vocabulary: Vocabulary, keep: int = KEEP_WORDS):
        self.v = vocabulary
        self.keep = keep
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.runs: dict[int, bytes] = {}
        line = "\n" if self.v.cut_lines else ""
        self.cut = re.compile(f"{MARK}+[^{MARK}{line}]*|[^{MARK}{line}]+" + ("|\n" if line else "")) if self.v.cut_marks else re.compile(".+", re.DOTALL)
        self.bare = np.array([self.v.ids.get(MARK, self.v.unknown)], np.int32).tobytes()

    def run(self, n: int) -> bytes:
        if n not in self.runs:
            self.runs[n] = np.array(self.v.run_ids(n), np.int32).tobytes()
        return self.runs[n]

    def spaced(self, word: str) -> bytes:
        """A word with several marks in front: the marks that merging leaves alone form a run."""
        core = word.lstrip(MARK)
        marks = len(word) - len(core)
        if not core:
            return self.run(marks)
        ids = self.known[MARK + core]
        if ids[:4] == self.bare:
            return self.run(marks) + ids[4:]
        return self.run(marks - 1) + ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        prefix = MARK if self.v.dummy_prefix else ""
        marked = [prefix + t.replace(" ", MARK) if t else "" for t in texts]
        if len(self.known) > self.keep:  # words not met since the last turn are dropped, frequent ones come back below
            self.older, self.known = self.known, {}
        words: set[str] = set()
        for t in marked:  # each text is cut twice: lists of all its words would be many times its size
            words |= set(self.cut.findall(t)).difference(self.known)
        several = {w for w in words if w.startswith(MARK * 2) or w == MARK} if self.v.cut_marks else set()
        words |= {w for core in several if (w := MARK + core.lstrip(MARK)) != MARK and w not in self.known}
        back = words & self.older.keys()
        self.known.update({w: self.older[w] for w in back})
        words -= back
        self.known |= self.v.encode_words(list(words - several))
        for w in several & words:
            self.known[w] = self.spaced(w)
        find = self.known.__getitem__
        return [b"".join(map(find, self.cut.findall(t))) for t in marked]


def encode(docs: DataFrame, model: str = MODEL, column: str = "text", to: str = "ids", back: str | None = None) -> DataFrame:
    """``docs`` with the array ``to`` of piece ids and, if ``back`` is a name, the text that they decode to."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    made = [c for c in (to, back) if c]
    given = docs.select(*[c for c in docs.columns if c not in made or c == column])
    kept = [c for c in given.columns if c not in made]

    def run(batches):
        encoder = Encoder(ready(vocabulary))
        for batch in A.slices(batches, column, SLICE):
            found = encoder.encode(batch.column(column).to_pylist())
            counts = np.array([len(x) // 4 for x in found], np.int64)
            ids = np.frombuffer(b"".join(found), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists, *([encoder.v.texts(ids, counts)] if back else [])], names=[*kept, *made])

    given = given.withColumn(column, F.col(column).cast("string"))
    fields = [*given.select(*kept).schema.fields, T.StructField(to, T.ArrayType(T.IntegerType()))]
    return given.mapInArrow(A.tidy(run), T.StructType(fields + ([T.StructField(back, T.StringType())] if back else [])))


def decode(docs: DataFrame, model: str = MODEL, column: str = "ids", to: str = "decoded") -> DataFrame:
    """``docs`` with the text ``to`` that the ids in ``column`` stand for."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    given = docs.select(*[c for c in docs.columns if c != to or c == column])
    kept = [c for c in given.columns if c != to]

    def run(batches):
        v = ready(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(column)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], v.texts(ids, counts)], names=[*kept, to])

    return given.mapInArrow(A.tidy(run), T.StructType([*given.select(*kept).schema.fields, T.StructField(to, T.StringType())]))


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = encode(docs, back="decoded")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )
