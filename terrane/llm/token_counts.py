"""Token counts at every prefix, by a dynamic program over the prefixes of each piece of text.

A text is cut into pieces as the tokenizer cuts it (contractions, words, numbers, signs, white space). In a piece, the last
token of each prefix follows from those of shorter prefixes: it is the one token that ends there and that may follow the
last token of what stands before it. Two tokens may follow each other if no merge across their border comes before the
merges that consume its two sides. So each prefix has one count, the count before its last token plus one, and that is
exactly what merging the prefix by itself would give. Where a prefix would be cut otherwise than the whole text (inside a
contraction, after a run of white space, inside a special token) the count is that of the prefix.

The stored counts answer budget questions without encoding again: how many tokens a text or any start of it has
(:func:`tokens_at`), and where to cut it for a budget (:func:`longest_fit`, :func:`truncated`).

At scale: no shuffle. The vocabulary, whose size is the tokenizer file's, reaches the workers as one broadcast; a task
keeps the counts of pieces it has met in two generations of bounded size, and slices of bounded bytes, or of one text.

Defined results: a null or empty text has the counts ``[0]``. Places are code points; entry i counts the first i of them. A
special token inside a text counts as one, as the library has it by default. Repeated rows count alike; extra columns
pass through, but a column named as the result is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache
from operator import sub
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm import textarrays as A

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
KEEP_PIECES = 300_000
KEEP_PAIRS = 400_000
SLICE = 2 << 20
NEVER = 1 << 62
SPLIT = ("'ll", "'ve", "'re")
PLANES = 0x40000  # above, no code point is a letter, a number or white space


def public_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> dict[str, int]:
    """The printable names that byte-level vocabularies give to bytes: printable Latin-1 stands for itself, the rest counts up from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranges(members: list[int]) -> list[tuple[int, int]]:
    """Sorted code points as ranges, ends inclusive."""
    found: list[tuple[int, int]] = []
    for c in members:
        if found and found[-1][1] == c - 1:
            found[-1] = (found[-1][0], c)
        else:
            found.append((c, c))
    return found


def _inside(ranges: list[tuple[int, int]], limit: int) -> str:
    """The part of the ranges below ``limit`` as the inside of a character class."""
    return "".join(f"\\U{a:08x}-\\U{min(b, limit - 1):08x}" for a, b in ranges if a < limit)


def _classes(path: str) -> tuple[list[tuple[int, int]], ...]:
    """Letters, numbers and white space as the library's own cutting has them: its Unicode version decides."""
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    points = [c for c in range(PLANES) if not 0xD800 <= c < 0xE000]

    def joins(before: str) -> set[int]:
        """Code points that stay in one piece with the character before them; each stands on a line of its own."""
        found = set()
        for at in range(0, len(points), 1 << 14):
            part = points[at : at + (1 << 14)]
            found.update(part[a // 3] for _, (a, b) in cut("".join(f"{before}{chr(c)}\n" for c in part)) if b - a >= 2 and a % 3 == 0)
        return found

    letters, numbers, signs = joins("a"), joins("1"), joins("!")
    return tuple(_ranges(sorted(x)) for x in (letters, numbers, set(points) - letters - numbers - signs))


class Prefixes:
    """A byte-level BPE vocabulary and the counts of its pieces."""

    def __init__(self, path: str):
        data = Path(path).read_bytes()
        spec = json.loads(data)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        plain = {"normalizer": None, "truncation": None, "padding": None}
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or any(spec.get(k) != v for k, v in plain.items()):
            raise ValueError("this reads byte-level BPE files without normaliser, truncation or padding")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not read")
        self.key = hashlib.sha256(data).hexdigest()
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.classes = _classes(path)
        names = _byte_names()
        self.vocabulary = {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if all(c in names for c in token)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = [(model["vocab"][a], model["vocab"][b], model["vocab"][a + b]) for a, b in pairs]

    def prepare(self) -> Prefixes:
        """The tables that a worker needs."""
        self.cut = self.cutting(PLANES)
        self.cuts = [("latin-1", 1, self.cutting(0x100)), ("utf-16-le", 2, self.cutting(0x10000))]
        space = _inside(self.classes[2], PLANES)
        self.runs = re.compile(f"[{space}]{{2,}}(?=[^{space}])")
        self.marks = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.rank = {a << 32 | b: r for r, (a, b, _) in enumerate(self.merges)}
        self.made = {t: (a, b, r) for r, (a, b, t) in reversed(list(enumerate(self.merges)))}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.sides: tuple[dict, dict] = ({}, {})
        self.ids: dict[bytes, int] = {}
        self.longest = [0] * 256
        for token, i in sorted(self.vocabulary.items(), key=lambda x: len(x[0])):  # a token that merging its bytes does not give never occurs
            made = self.made.get(i)
            if len(token) == 1 or (made and self.may_follow(made[0], made[1], made[2])):
                self.ids[token] = i
                self.longest[token[-1]] = len(token)
        return self

    def cutting(self, limit: int) -> re.Pattern:
        """How texts of code points below ``limit`` are cut."""
        letters, numbers, space = (_inside(c, limit) for c in self.classes)
        return re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")

    def side(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens at one edge of ``token`` while it is merged, each with the rank of the merge that consumes it."""
        found = self.sides[right].get(token)
        if found is None:
            made = self.made.get(token)
            if made is None:
                found = [(token, NEVER)]
            else:
                below = self.side(made[1] if right else made[0], right)
                found = [*below[:-1], (below[-1][0], made[2]), (token, NEVER)]
            self.sides[right][token] = found
        return found

    def may_follow(self, left: int, right: int, until: int = NEVER) -> bool:
        """No merge of a rank below ``until`` joins what stands at the border of the two tokens. Of equal merges the left one comes first."""
        a, b = self.side(left, True), self.side(right, False)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.rank.get(x << 32 | y)
            if rank is not None and rank < x_ends and rank <= y_ends and rank < until:
                return False
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def last_token(self, data: bytes, end: int, starts: range, last: list[int]) -> tuple[int, int] | None:
        """Start and id of the token that ends at ``end`` and may follow the last token of what stands before it; only one can."""
        ids, pairs = self.ids, self.pairs
        for start in starts:
            token = ids.get(data[start:end])
            if token is not None:
                pair = last[start] << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= KEEP_PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self.may_follow(last[start], token)
                if fits:
                    return start, token
        return None

    def walk(self, pieces: list[str]) -> None:
        """Counts of all prefixes of each of ``pieces``, in sorted order: from one piece to the next only the prefixes after their common one are computed."""
        ids, longest, known, find = self.ids, self.longest, self.known, self.last_token
        last, starts, counts, before = [0], [0], [0], b""
        for piece in sorted(pieces):
            data = piece.encode()
            n = len(data)
            common = 0
            for x, y in zip(before, data, strict=False):
                if x != y:
                    break
                common += 1
            before = data
            del last[common + 1 :], starts[common + 1 :], counts[common + 1 :]
            for end in range(common + 1, n + 1):
                token = ids.get(data[:end]) if end <= longest[data[end - 1]] else None
                if token is not None:
                    last.append(token)
                    starts.append(0)
                    counts.append(1)
                    continue
                near = starts[end - 1] or 1  # most often the token before is made longer, or a short one begins
                start, token = find(data, end, range(near, end), last) or find(data, end, range(near - 1, max(0, end - 1 - longest[data[end - 1]]), -1), last)
                last.append(token)
                starts.append(start)
                counts.append(counts[start] + 1)
            found = counts if n == len(piece) else [counts[i] for i in range(n) if data[i] & 0xC0 != 0x80] + counts[-1:]
            if piece in SPLIT:  # cut off before its end, this is a sign and a letter
                found = [0, 1, 2, counts[-1]]
            known[piece] = array("i", map(sub, found[1:], found)).tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Sees to it that the counts of ``pieces`` are known; those not met for two generations are dropped."""
        if len(self.known) >= KEEP_PIECES:
            self.older, self.known = self.known, {}
        pieces -= self.known.keys()
        back = pieces & self.older.keys()
        self.known.update({p: self.older[p] for p in back})
        self.walk(list(pieces - back))

    def pieces(self, text: str) -> list[str]:
        """``text`` as the tokenizer cuts it. Small classes are faster: texts of Latin-1 and of the first plane have their own."""
        for coding, width, cut in self.cuts:
            try:
                if len(text.encode(coding)) == width * len(text):
                    return cut.findall(text)
            except UnicodeEncodeError:
                continue
        return self.cut.findall(text)

    def counted(self, text: str, pieces: list[str]) -> np.ndarray:
        """Counts at each place of a text without special tokens, whose pieces are known."""
        counts = np.zeros(len(text) + 1, np.int32)
        np.cumsum(np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), np.int32), out=counts[1:])
        for run in self.runs.finditer(text):  # at the end of a prefix a run of white space is one piece
            counts[run.end()] = counts[run.start()] + np.frombuffer(self.known[run.group()], np.int32).sum()
        return counts

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text its counts at each place, from none to all of its code points."""
        plain, shape = [], []  # texts between special tokens; how many of each text, and where its next one starts
        for text in texts:
            text = text or ""
            marks = list(self.marks.finditer(text)) if self.marks and any(s in text for s in self.special) else []
            starts = [0, *(m.end() for m in marks)]
            shape.append([m.start() - s for m, s in zip(marks, starts, strict=False)])
            plain += [text[s : m.end() - 1] for m, s in zip(marks, starts, strict=False)] + [text[starts[-1] :]]  # inside a special token the prefix is plain text
        cut = [self.pieces(t) for t in plain]
        self.learn(set().union(*cut).union(*(self.runs.findall(t) for t in plain)))
        each = map(self.counted, plain, cut)
        found = []
        for ends in shape:
            parts, before = [np.zeros(1, np.int32)], 0
            for end in ends:
                counts = next(each) + before
                before = int(counts[end]) + 1
                parts += [counts[1:], np.array([before], np.int32)]
            parts.append((next(each) + before)[1:])
            found.append(np.concatenate(parts))
        return found


@lru_cache(maxsize=2)
def _load(path: str, _changed: float) -> Prefixes:
    return Prefixes(path)


_READY: dict[str, Prefixes] = {}


def ready(given) -> Prefixes:
    """The broadcast vocabulary with its tables, which serve all tasks of a Python worker, one after another."""
    vocabulary = given.value if hasattr(given, "value") else given
    if vocabulary.key not in _READY:
        _READY.clear()
        _READY[vocabulary.key] = vocabulary.prepare()
    return _READY[vocabulary.key]


def load(tokenizer: str | None = None) -> Prefixes:
    """The vocabulary of a tokenizer file."""
    path = tokenizer or public_path(TOKENIZER)
    return _load(path, Path(path).stat().st_mtime)


def prefix_counts(docs: DataFrame, tokenizer: str | None = None, column: str = "text", to: str = "counts") -> DataFrame:
    """``docs`` with the array ``to``: entry i is the number of tokens of the first i code points of the text."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    given = docs.select(*[c for c in docs.columns if c != to or c == column]).withColumn(column, F.col(column).cast("string"))
    kept = [c for c in given.columns if c != to]

    def run(batches):
        v = ready(vocabulary)
        for batch in A.slices(batches, column, SLICE):
            found = v.of(batch.column(column).to_pylist())
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found])))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], names=[*kept, to])

    return given.mapInArrow(A.tidy(run), T.StructType([*given.select(*kept).schema.fields, T.StructField(to, T.ArrayType(T.IntegerType()))]))


def tokens_at(counts: Column, place: Column | int | None = None) -> Column:
    """Tokens of the first ``place`` code points, or of the whole text."""
    last = F.size(counts) - 1
    return F.get(counts, last if place is None else F.least(F.lit(place) if isinstance(place, int) else place, last)).cast("long")


def longest_fit(counts: Column, budget: int) -> Column:
    """Code points of the longest start of the text that has at most ``budget`` tokens. Counts may fall as a text grows, so the last such place is taken."""
    from_end = F.array_position(F.transform(F.reverse(counts), lambda n: n <= budget), True)
    return F.when(from_end > 0, F.size(counts) - from_end).otherwise(F.lit(0)).cast("long")


def truncated(docs: DataFrame, budget: int, tokenizer: str | None = None, column: str = "text", to: str = "counts") -> DataFrame:
    """``docs`` with the text cut to ``budget`` tokens, and the counts of what is left. Nothing is encoded twice."""
    rows = prefix_counts(docs, tokenizer, column, to)
    fit = longest_fit(F.col(to), budget)
    return rows.withColumn(column, F.substring(F.coalesce(column, F.lit("")), F.lit(1), fit.cast("int"))).withColumn(to, F.slice(to, F.lit(1), fit.cast("int") + 1))


def op13(spark, sf_dir: str) -> DataFrame:
    rows = prefix_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = tokens_at(F.col("counts"))
    return rows.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), n.alias("n_tokens"), (n > LIMIT).alias("over_limit"))
