"""Near-dedup by Order MinHash, with candidates verified by banded alignment.

K-mers are runs of three words, of two in texts of at most ``SHORT`` words, labelled with their occurrence in the text, so
repeats count. Each of ``SKETCHES`` hash functions takes the ``TAKEN`` lowest labelled k-mers of a text and keeps them in
text order; texts that agree in one sketch are candidates. Texts just under ``SHORT`` words are sketched both ways, so two
texts that may be similar always have one length of k-mers in common. Texts of 4 to 9 words, of which one may differ, also
meet by what is left when one word is taken out, which finds all of their pairs. Unlike plain MinHash, agreement also depends on order, as edit similarity does. A candidate is
accepted if its edit similarity over words, 1 - distance / longer length, is at least 0.8. The alignment runs within the
band of diagonals that this similarity allows, so its answer is exact. Classes are the connected components of the links.

At scale: equal texts are collapsed first, by SHA-256 of their words, to one representative. Candidates are verified in
rounds, one partner for each row and round, while links are found: of the firsts of its buckets the one that it meets most
often and that is not in its class yet. Links are merged to classes after
each round, and only buckets of several classes go on, so a large group of copies costs its number of rows. When a round
links few, all pairs of different classes that share a bucket are taken, in blocks of ``BLOCK`` rows. A pair is left out only if
its lengths or its counts of words by ``BINS`` bins show that its edit distance is too large, and else aligned. So the
alignments grow with the rows unless many unlinked texts of a bucket have like words; the comparison of bins does grow with
the square of an unlinked bucket, in small steps. Text moves only for candidates.

What can be missed: two texts that agree in no sketch. With k-mer similarity j a pair meets in one of 50 sketches with
probability 1 - (1 - j^2)^50. A share s of words kept, at random sites, leaves j = s^k / (2 - s^k): at 0.8, 0.344 for
three words and 0.47 for two, so 0.998 and over 0.9999.

Defined results: a null text is empty; all texts without words are one class; a text of fewer words than a k-mer is one. Of a
class the smallest doc_id stays, a null one after all others; of repeated rows one stays. Extra columns and clashing names
do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm import textarrays as A
from terrane.llm.common import ROW, discard, id_order, keyed, own_columns, release, stash, with_rows

K = 3
SHORT, SHORT_K = 40, 2
ANCHOR = 5
SKETCHES = 50
TAKEN = 2
SIMILARITY = 0.8
BLOCK = 2048
BINS = 512
FEW = 50  # a round that links less than one in so many of its pairs is the last before all pairs are taken
_TOP = np.uint64(A.MASK)


def _labelled(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled k-mers of all texts with words, and how many each text has."""
    n = np.diff(first)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    heads = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(n)), counts)
    start = first[:-1][doc] + np.arange(len(doc)) - heads[doc]
    grams = A.spans_hash(hashes, start, np.minimum(start + k, first[1:][doc]))
    key = A.mixed(doc.astype(np.uint64)) ^ grams
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    again = np.empty(len(ranked), np.uint64)
    again[order] = (np.arange(len(ranked)) - at[np.cumsum(new) - 1]).astype(np.uint64) if len(at) else 0
    return np.where(again > 0, A.mixed(grams + again * np.uint64(A.BASES[1])), grams), counts


def sketches(labelled: np.ndarray, counts: np.ndarray, n: int, taken: int) -> np.ndarray:
    """One row of n signatures for each text with k-mers: the lowest k-mers by each hash function, hashed in text order."""
    own = counts[counts > 0]
    heads = np.cumsum(own) - own
    doc = np.repeat(np.arange(len(own)), own)
    rng = np.random.default_rng(3)
    out = np.zeros((len(own), n), np.uint64)
    # the lowest are sought among about 12 for each text; a text with too few such k-mers has all of them looked at
    low_end = np.where(own > 16, 2.0**64 * 12 / np.maximum(own, 17), 2.0**63).astype(np.uint64)
    low_end[own <= 16] = _TOP
    likely = np.repeat(low_end, own)
    for i in range(n):
        flip, odd = (np.uint64(x) for x in rng.integers(0, A.MASK, 2, dtype=np.uint64, endpoint=True))
        every = (labelled ^ flip) * (odd | np.uint64(1))
        few = every <= likely
        lacking = np.add.reduceat(few.astype(np.int64), heads) < np.minimum(own, taken)
        if lacking.any():
            few |= lacking[doc]
        at = np.flatnonzero(few)
        keyed, of = every[at], doc[at]
        first = np.searchsorted(of, np.arange(len(own)))
        sites = np.full((len(own), taken), np.iinfo(np.int64).max)
        for t in range(taken):
            low = np.minimum.reduceat(keyed, first)
            hit = np.flatnonzero(keyed == low[of])
            hit = hit[np.concatenate(([True], of[hit][1:] != of[hit][:-1]))]
            sites[:, t] = np.where(own > t, at[hit], np.iinfo(np.int64).max)
            keyed[hit] = _TOP
        sites.sort(axis=1)
        for t in range(taken):
            some = sites[:, t] < np.iinfo(np.int64).max
            value = np.zeros(len(own), np.uint64)
            value[some] = labelled[sites[some, t]]
            out[:, i] = A.mixed(out[:, i] * np.uint64(A.BASES[0]) + value + np.uint64(1))
    return out


def _of_texts(hashes: np.ndarray, first: np.ndarray, which: np.ndarray, k: int, n: int, taken: int) -> np.ndarray:
    """The signatures of the texts ``which``, all of them with words."""
    size = np.diff(first)[which]
    heads = np.concatenate(([0], np.cumsum(size)))
    labelled, counts = _labelled(hashes[np.repeat(first[:-1][which] - heads[:-1], size) + np.arange(heads[-1])], heads, k)
    return sketches(labelled, counts, n, taken)


def _without_one(words: np.ndarray) -> np.ndarray:
    """Hashes of a text's word hashes as they are and without each one."""
    left = [words, *(np.delete(words, i) for i in range(len(words)))]
    return np.unique(np.array([A.windows_hash(x, len(x))[0] for x in left], np.uint64))


def _bags(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the number of its words in each of ``BINS`` bins; all are the highest count if one does not fit."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    found = np.bincount(doc * BINS + (A.mixed(hashes) % np.uint64(BINS)).astype(np.int64), minlength=n * BINS).reshape(n, BINS)
    found[found.max(axis=1) > 65535] = 65535
    return found.astype(np.uint16)


def _sketched(similarity: float, k: int, n: int, taken: int):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("key", pa.binary()), ("bag", pa.binary()), ("sketches", pa.list_(pa.int64()))])

    def run(batches):
        for batch in A.slices(batches, "text", 1 << 20):
            data, offsets = A.joined(batch.column("text"))
            starts, ends, first = A.words(data, offsets)
            hashes, size = A.spans_hash(data, starts, ends), np.diff(first)
            rows, bands, values = [], [], []
            for base, which, of in ((0, np.flatnonzero((size > 0) & (size <= SHORT)), SHORT_K), (n, np.flatnonzero(size >= max(1, int(SHORT * similarity))), k)):
                if len(which):
                    values.append(_of_texts(hashes, first, which, of, n, taken).ravel())
                    rows.append(np.repeat(which, n))
                    bands.append(np.tile(np.arange(base, base + n), len(which)))
            for i in np.flatnonzero((size >= 4) & (size <= 9)).tolist():
                values.append(_without_one(hashes[first[i] : first[i + 1]]))
                rows.append(np.full(len(values[-1]), i))
                bands.append(np.full(len(values[-1]), 2 * n))
            row, band, value = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((rows, np.int64), (bands, np.int64), (values, np.uint64)))
            order = np.argsort(row, kind="stable")
            buckets = A.mixed(value ^ A.mixed(band.astype(np.uint64)))[order].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(batch.num_rows + 1)), pa.int32()), pa.array(buckets))
            keys = [hashlib.sha256(b" ".join(t.split())).digest() for t in (data[offsets[i] : offsets[i + 1]].tobytes() for i in range(batch.num_rows))]
            bags = [x.tobytes() for x in _bags(hashes, first)]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(keys, pa.binary()), pa.array(bags, pa.binary()), lists], schema=schema)

    return A.tidy(run)


def distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The edit distance of two id arrays if it is at most ``limit``, from the band of diagonals that can hold it; else None."""
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m - n > limit:
        return None
    width = 2 * limit + 1
    far = limit + 1
    offsets = np.arange(width) - limit  # column j = i + offset
    row = np.where((offsets >= 0) & (offsets <= m), offsets, far)
    steps = np.arange(width)
    padded = np.full(n + m + 2 * width, -1, a.dtype)
    padded[limit : limit + m] = b
    for i in range(1, n + 1):
        same = padded[i - 1 : i - 1 + width] == a[i - 1]  # b[j - 1] for j = i + offset
        best = np.where(same, row, row + 1)  # from (i - 1, j - 1), on the same diagonal
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)  # from (i - 1, j)
        column = i + offsets
        best[column < 0] = far
        if i <= limit:
            best[limit - i] = i  # column 0
        best = np.minimum.accumulate(best - steps) + steps  # from (i, j - 1)
        best[(column < 0) | (column > m)] = far
        row = np.minimum(best, far)
        if row.min() > limit:
            return None
    last = int(row[m - n + limit])
    return last if last <= limit else None


def _chain_cost(a: np.ndarray, b: np.ndarray, k: int, limit: int) -> int:
    """The cost of one alignment, through the longest chain of common unique k-mers within the band: an upper bound of the distance."""
    if min(len(a), len(b)) < k:
        return max(len(a), len(b))
    grams = [A.windows_hash(x.astype(np.uint64), k) for x in (a, b)]
    once = [np.unique(g, return_index=True, return_counts=True) for g in grams]
    once = [(v[c == 1], i[c == 1]) for v, i, c in once]
    _, x, y = np.intersect1d(once[0][0], once[1][0], assume_unique=True, return_indices=True)
    i, j = once[0][1][x], once[1][1][y]
    band = np.abs(i - j) <= limit
    order = np.argsort(i[band])
    i, j = i[band][order], j[band][order]
    if len(j) > 1 and (np.diff(j) < 0).any():  # longest increasing run of sites
        tails, at, before = [], [], np.full(len(j), -1)
        for p, value in enumerate(j.tolist()):
            q = bisect_left(tails, value)
            before[p] = at[q - 1] if q else -1
            tails[q : q + 1], at[q : q + 1] = [value], [p]
        chain, p = [], at[-1]
        while p >= 0:
            chain.append(p)
            p = before[p]
        i, j = i[chain[::-1]], j[chain[::-1]]
    cost, p, q = 0, 0, 0
    for s, t in zip(i.tolist(), j.tolist(), strict=True):
        if s >= p and t >= q:
            cost += max(s - p, t - q)
        elif s - p != t - q:
            continue
        p, q = s + k, t + k
    return cost + max(len(a) - p, len(b) - q)


def similar(a: list[bytes], b: list[bytes], similarity: float = SIMILARITY, k: int = ANCHOR) -> bool:
    """Whether the edit similarity over words is at least ``similarity``."""
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    ids: dict[bytes, int] = {}
    x = np.array([ids.setdefault(w, len(ids)) for w in a], np.int64)
    y = np.array([ids.setdefault(w, len(ids)) for w in b], np.int64)
    n = min(len(x), len(y))
    head = int(np.argmin(np.append(x[:n] == y[:n], False)))
    x, y, n = x[head:], y[head:], n - head
    tail = int(np.argmin(np.append(x[::-1][:n] == y[::-1][:n], False)))
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if max(len(x), len(y)) <= limit:
        return True
    common = np.minimum(np.bincount(x, minlength=len(ids)), np.bincount(y, minlength=len(ids))).sum()
    if max(len(x), len(y)) - common > limit:
        return False
    return _chain_cost(x, y, k, limit) <= limit or distance_within(x, y, limit) is not None


def _verified(similarity: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            texts = zip(batch.column("text_a"), batch.column("text_b"), strict=True)
            words = lambda t: (t.as_py() or "").encode().split()
            ok = [pair for pair, (s, t) in zip(ids, texts, strict=True) if similar(words(s), words(t), similarity)]
            if ok:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in ok], pa.int64()) for i in (0, 1)], schema=schema)

    return A.tidy(run)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all ends of ``edges`` (a, b): the smallest node that can be reached. Labels spread to neighbours and jump to their label's label."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = stash(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label")
        spread = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = spread.join(jump, "next", "left").select("node", F.coalesce("further", "next").alias("next"))
        labels = stash(moved.join(labels, "node").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def _fits(similarity: float, first: str = "first"):
    """Whether a member's length lets it be similar to the bucket's first."""
    return F.least(f"{first}.n_words", "n_words") >= similarity * F.greatest(f"{first}.n_words", "n_words")


def _labelled_members(members: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """``members`` (bucket, row, n_words) of buckets that hold several classes, with their label and the bucket's first in an order that each turn draws anew."""
    own = members.withColumn("label", F.col("row")) if labels is None else members.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    place = F.xxhash64("row", F.lit(turn)).alias("place")
    spread = own.groupBy("bucket").agg(F.min(F.struct(place, "label", "row", "n_words")).alias("first"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return stash(own.join(spread.select("bucket", "first"), "bucket"), "mixed")


def _met_most(members: DataFrame, tested: DataFrame | None, similarity: float) -> DataFrame:
    """For each row the first of another class that it meets in most buckets and is not tested with yet, as pairs (a, b)."""
    met = members.where((F.col("label") != F.col("first.label")) & _fits(similarity)).groupBy("row", F.col("first.row").alias("other")).agg(F.count("*").alias("times"))
    pairs = met.select("row", "times", F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b"))
    pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
    best = pairs.groupBy("row").agg(F.max(F.struct("times", -F.col("a"), "b")).alias("best"))
    return best.select((-F.col("best.col2")).alias("a"), F.col("best.b").alias("b")).distinct()


def _all_pairs(members: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of ``members`` that share a bucket, have different labels, and whose lengths and bags of words leave the similarity possible."""
    blocks = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    d = members.select("bucket", "row", "n_words", "label").join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("row", "bucket"), F.col("blocks")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = members.groupBy("row").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))  # at most one for each sketch
    d = d.join(held.join(bags, "row"), "row").select("bucket", "buckets", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "n_words", "row", "label", "bag")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def within(rows):
        n, row, label, own, i, j = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("n_words", "row", "label", "own", "i", "j"))
        if label.min() == label.max():
            return
        bags = np.frombuffer(b"".join(rows.column("bag").to_pylist()), np.uint16).reshape(-1, BINS)
        here, lists = rows.column("bucket")[0].as_py(), rows.column("buckets").combine_chunks()
        held, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))

        def first_meet(p, at):
            """Which of the pairs (p, at) have this bucket as the lowest of those they share; the others are taken there."""
            size = ends[at + 1] - ends[at]
            place = np.repeat(ends[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
            common = np.isin(held[place], held[ends[p] : ends[p + 1]])
            which, value = np.repeat(np.arange(len(at)), size)[common], held[place][common]
            first = np.concatenate(([True], which[1:] != which[:-1]))
            return value[first] == here

        for p in range(len(n) - 1):
            end = int(np.searchsorted(n, n[p] / similarity + 1e-6, "right"))  # sorted by length
            at = p + 1 + np.flatnonzero(label[p + 1 : end] != label[p])
            if i[p] != j[p]:
                at = at[own[at] != own[p]]
            if len(at):
                common = np.minimum(bags[at], bags[p]).sum(axis=1, dtype=np.int64)
                at = at[(n[at] - common <= (1 - similarity) * n[at] + 1e-9) | (bags[at, 0] == 65535)]
            if len(at):
                at = at[first_meet(p, at)]
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(f(row[at], row[p])) for f in (np.minimum, np.maximum)], schema=schema)

    def run(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])]).combine_chunks()
            same = [rows.column(c).to_numpy() for c in ("bucket", "i", "j")]
            edges = [0, *(1 + np.flatnonzero(np.any([x[1:] != x[:-1] for x in same], axis=0))).tolist()]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                yield from within(rows.slice(start, end - start))
            rest = rows.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield from within(rest)

    dealt = d.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "n_words", "row")
    return dealt.mapInArrow(A.tidy(run), "a long, b long")


def _links(docs: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs that alignment accepts."""
    wanted = stash(pairs.select(F.col("a").alias(ROW)).union(pairs.select("b")).distinct(), "wanted")
    texts = with_rows(docs, "text").join(wanted, ROW, "left_semi")
    side = lambda x: texts.select(F.col(ROW).alias(x), F.col("text").alias(f"text_{x}"))
    links = stash(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verified(similarity), "a long, b long"), "links")
    discard(wanted)
    return links


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, label) after ``links`` (a, b) between rows are added. Only the links between classes count, each once."""
    if labels is None:
        return components(links)
    of = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("label_a", "a").alias("s"), F.coalesce("label_b", "b").alias("t"))
    moved = components(stash(between.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct(), "between"))
    new = moved.select("node", F.col("label").alias("moved"))
    old = labels.join(new.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("moved", "label").alias("label"))
    return stash(old.unionByName(moved.join(labels, "node", "left_anti")), "labels")


def classes(docs: DataFrame, similarity: float = SIMILARITY, k: int = K, n: int = SKETCHES, taken: int = TAKEN) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, class_id (the smallest doc_id of the class), class_size, kept."""
    spark, given = docs.sparkSession, docs
    docs = keyed(docs, "doc_id", "text")
    thin = stash(with_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sketched(similarity, k, n, taken), "row long, doc_id long, n_words long, key binary, bag binary, sketches array<bigint>"), "sketches")
    bags = thin.select("row", "bag")
    sketched, thin = thin, thin.drop("bag").withColumn("order", id_order(F.col("doc_id"), F.col("row")))
    copies = stash(thin.groupBy("key").agg(F.min("order").alias("order"), F.count("*").alias("copies")), "copies").withColumn("row", F.col("order.row"))
    held = thin.join(copies.select("row"), "row", "left_semi").select("row", "n_words", F.explode("sketches").alias("bucket"))
    shared = held.groupBy("bucket").agg(F.min(F.struct(F.col("row").alias("label"), "row", "n_words")).alias("first"), F.max("row").alias("last")).where("first.row < last")
    members = stash(held.join(shared.select("bucket", "first"), "bucket").withColumn("label", F.col("row")), "buckets")
    release(spark)
    labels, whole, turn = None, False, 0
    pairs = stash(_met_most(members, None, similarity), "pairs")
    tested = pairs
    while True:
        n_pairs, n_found = pairs.count(), 0
        if n_pairs:
            found = _links(docs, pairs, similarity)
            n_found = found.count()
            if n_found:
                labels = _merged(labels, found)
            discard(found)
            release(spark)
        if whole:
            break
        before, members = members, _labelled_members(members.select("bucket", "row", "n_words"), labels, turn := turn + 1)
        discard(before)
        whole = n_found * FEW <= n_pairs
        pairs = _all_pairs(members, bags, similarity).join(tested, ["a", "b"], "left_anti") if whole else _met_most(members, tested, similarity)
        pairs = stash(pairs, "pairs")
        tested = tested if whole else stash(tested.unionByName(pairs), "tested")
    of_key = copies.select("key", "row")
    if labels is not None:
        of_key = of_key.join(labels.withColumnRenamed("node", "row"), "row", "left")
    named = of_key.select("key", (F.coalesce("label", "row") if labels is not None else F.col("row")).alias("label"))
    sizes = copies.join(named, "key").groupBy("label").agg(F.min("order").alias("first"), F.sum("copies").alias("class_size"))
    by_key = stash(named.join(sizes, "label").select("key", "first", "class_size"), "classes")
    rows = stash(thin.select("row", "doc_id", "key"), "rows")
    discard(members, pairs, tested, sketched, *([] if docs is given else [docs]))
    return rows.join(by_key, "key").select(
        F.col("row").alias(ROW), "doc_id", F.col("first.id").alias("class_id"), "class_size", (F.col("first.row") == F.col("row")).alias("kept")
    )


def dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    docs = keyed(docs)
    kept = classes(docs, similarity).where("kept").select(ROW)
    return own_columns(docs.join(kept, ROW, "left_semi"))


def op3(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop(ROW)
