"""Plain Python versions of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    wins = Counter(zip(words, words[1:], words[2:], strict=False))
    rep = {j for i in range(len(words) - 2) if wins[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep), n < 50 or 100 * len(rep) > 50 * n


def lines_kept(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """n_lines, n_dropped, kept_sha256 by doc_id."""
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held: dict[str, set] = {}
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                held.setdefault(key(x), set()).add(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(keep), sha("\n".join(keep)))
    return out


def bytes_kept(docs: list[tuple[int, str | None]], width: int = 50) -> dict[int, tuple]:
    """n_bytes, n_removed, n_spans, kept_sha256 by doc_id."""
    first: dict[bytes, int] = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in sorted(raw, key=lambda x: x[0]):
        for i in range(len(b) - width + 1):
            first.setdefault(b[i : i + width], d)
    out = {}
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < d:
                gone[i : i + width] = b"\1" * width
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def words_kept(docs: list[tuple[int, str | None]], width: int = 35) -> dict[int, tuple]:
    """n_words, n_removed, kept_sha256 by doc_id."""
    seen: Counter = Counter()
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    for _, w in split:
        for i in range(len(w) - width + 1):
            seen[tuple(w[i : i + width])] += 1
    out = {}
    for d, w in split:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def variants(docs):
    """Rows (word, form, root, n, n_near, form_n): near words are found by deleting each letter, since near words share a word so made or one holds the other."""
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}
    near = {w: set() for w in n}
    holes = {}
    for w in n:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            if cut in n:
                near[w].add(cut)
                near[cut].add(w)
            holes.setdefault((i, cut), []).append(w)
    for group in holes.values():
        for w in group:
            near[w] |= set(group) - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return rows
