"""Numpy helpers over the text of one Arrow batch: words, hashes and winnowed anchors as arrays, never row by row."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
#: Odd multipliers of the rolling polynomials, one for each independent hash.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLES = [np.random.default_rng(7 + i).integers(1, MASK, 256, dtype=np.uint64, endpoint=True) for i in range(len(BASES))]
_POWERS: dict[int, np.ndarray] = {}


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``limit`` bytes of the column, or one row: memory stays bounded by the longest text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, start = np.cumsum(size), 0
        while start < len(size):
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def tidy(run):
    """``run`` over a task's batches, after which the worker gives its freed Arrow memory back: idle workers stay small."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return whole


def joined(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and where each starts (one more than texts). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the first word of each text (one more than texts)."""
    word = ~_SPACE[data]
    first = np.empty(len(data) + 1, bool)
    first[0], first[-1] = True, True
    first[1:-1] = ~word[:-1]
    first[offsets] = True
    starts = np.flatnonzero(word & first[:-1])
    last = np.empty(len(data) + 1, bool)
    last[:-1] = ~word
    last[-1] = True
    last[offsets] = True
    ends = np.flatnonzero(word & last[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n + 1, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[: n + 1]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that polynomial hashes also differ in their high bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span, from one running sum. Values are bytes or hashes of words."""
    base = BASES[which]
    n = len(values)
    terms = _TABLES[which][values] if values.dtype == np.uint8 else values + np.uint64(1 + which)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(terms * powers(base, n)[:n], out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(inverse(base), n)[starts])


def windows_hash(values: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive values; those that cross texts are the caller's to leave out."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return spans_hash(values, at, at + width, which)


def window_starts(offsets: np.ndarray, width: int) -> np.ndarray:
    """Starts of all windows of ``width`` tokens that lie within one text."""
    n = np.diff(offsets) - width + 1
    n = np.where(n > 0, n, 0)
    return np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def lowest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, where its lowest one is; of equal ones the leftmost. Ordered by the top 40 bits."""
    if len(hashes) >= 1 << 24:
        return _lowest_long(hashes, width)
    key = (hashes & np.uint64(MASK ^ ((1 << 24) - 1))) | np.arange(len(hashes), dtype=np.uint64)
    done = 1
    while done < width:
        step = min(done, width - done)
        key = np.minimum(key[:-step], key[step:])
        done += step
    return (key & np.uint64((1 << 24) - 1)).astype(np.int64)


def _lowest_long(hashes: np.ndarray, width: int) -> np.ndarray:
    """The same over overlapping pieces, for texts of over 16 million tokens."""
    n, size, found = len(hashes) - width + 1, 1 << 23, []
    for start in range(0, max(n, 0), size):
        piece = hashes[start : min(n, start + size) + width - 1]
        found.append(lowest(piece, width) + start)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def anchors(values: np.ndarray, offsets: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing. Every window of ``width`` tokens has one anchor, its lowest-hashed run of ``seed`` tokens, which depends on the window's content only.

    Returns the windows' starts, each window's anchor, and the hashes of all runs."""
    starts = window_starts(offsets, width)
    grams = windows_hash(values, seed)
    if not len(starts):
        return starts, starts, grams
    return starts, lowest(grams, width - seed + 1)[starts], grams


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n tokens lie in a window of ``width`` tokens at one of the starts."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + width, n), minlength=n + 1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the place of each value among them, and how often each occurs."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return ranked[new], place, np.diff(np.append(at, len(values)))
