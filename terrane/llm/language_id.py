"""Language ID by Bayesian fusion of evidence.

Four sources of evidence add up as logarithms: the text's likelihood under byte trigrams of each language; the language
that the markup declares; the address suffix; and the host. The last three are learned from the corpus itself by grouped
aggregation: each text's own posterior is summed by declared language, suffix and host. Host priors are smoothed by
their suffix's, and those by the whole corpus's, so a host with few texts says little. One more class, ``und``, stands for
text that no language explains; its trigrams are all equally likely.

At scale: the trigram table has 32,768 rows and a column for each declared language, taken as bounded since these are language
codes. It is fitted on a bounded sample: of each language ``SAMPLE`` labelled rows, those with the lowest hash of doc_id and text,
or all if it has fewer, so rare languages are classes too. Rows alike in both count once. The hash up to which rows are taken is found exactly, by
merging the lowest of each task, so no language goes short, whatever its doc_ids. Everything else covers all rows: one scan of the texts gives each
row its likelihoods, in a thin table; sums by host are partial sums in each task, and a host with a third of all rows is one
row of the table that joins back. Sums are of integers, so reruns agree.

Defined results: a null text, or one without words, gets ``und``, as has one that no language explains; ``und`` is not kept.
Words with digits (keys, numbers, addresses) say nothing about language; a text of only such words follows its other evidence. Without any labelled rows nothing can be judged: all rows are ``und`` and kept. A
null declaration, host or suffix says nothing. Equal scores go to the first language by name. Repeated rows are judged
alike; extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm import textarrays as A
from terrane.llm.common import ROW, keyed, own_columns, stash, with_rows

SAMPLE = 1_000
BINS = 1 << 15
WEIGHT = 100  # trigrams that a text counts as at most; neighbouring trigrams are not independent
UND = "und"
UND_PRIOR = 1e-3
SMOOTHING = 20.0
UNIT = 1_000_000  # posteriors are summed as millionths


def _trigrams(batch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the trigrams of lower-cased bytes that touch no word with a digit, how many each text has, and its words."""
    data, offsets = A.joined(batch.column(column))
    starts, ends, first = A.words(data, offsets)
    digits = np.concatenate(([0], np.cumsum((data >= 48) & (data <= 57))))
    coded = digits[ends] > digits[starts]
    edge = np.bincount(starts[coded], minlength=len(data) + 1) - np.bincount(ends[coded], minlength=len(data) + 1)
    skip = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]))))
    upper = (data >= 65) & (data <= 90)
    low = (data + upper.astype(np.uint8) * 32).astype(np.uint32)
    at = A.window_starts(offsets, 3)
    n = len(low)
    code = (low[: n - 2] << np.uint32(16)) | (low[1 : n - 1] << np.uint32(8)) | low[2:] if n > 2 else np.zeros(0, np.uint32)
    bins = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    at = at[skip[at + 3] == skip[at]]
    inside = np.searchsorted(at, offsets)
    return bins[at], np.diff(inside), np.diff(first)


def lowest(rows: DataFrame, n: int) -> DataFrame:
    """(name, highest) of ``rows`` (name, place): for each name the n-th lowest of its places, each counted once, or the last if there are fewer. A task hands on at most n places of a name."""
    schema = pa.schema([("name", pa.string()), ("place", pa.int64())])

    def run(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column("name").dictionary_encode()
            which, place = names.indices.to_numpy(zero_copy_only=False), batch.column("place").to_numpy(zero_copy_only=False)
            order = np.argsort(which, kind="stable")
            ends = np.cumsum(np.bincount(which, minlength=len(names.dictionary)))
            for name, some in zip(names.dictionary.to_pylist(), np.split(place[order], ends[:-1]), strict=True):
                found[name] = np.unique(np.concatenate((found.get(name, some[:0]), some)))[:n]
        for name, place in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(place), pa.string()), pa.array(place, pa.int64())], schema=schema)

    places = rows.mapInArrow(A.tidy(run), "name string, place long").distinct()
    turn = F.row_number().over(Window.partitionBy("name").orderBy("place"))
    return places.withColumn("turn", turn).where(F.col("turn") <= n).groupBy("name").agg(F.max("place").alias("highest"))


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, by name, and the log-probabilities of the trigram bins (bins by languages and ``und``). ``docs`` has (doc_id, text, label)."""
    labelled = docs.where("label is not null and label != ''").select(F.col("label").alias("name"), F.xxhash64("doc_id", "text", F.lit(5)).alias("place"), "text")
    limits = stash(lowest(labelled.select("name", "place"), sample), "limits")  # written, so that its size is known: texts that are not sampled stay where they are
    few = labelled.join(limits, "name").where("place <= highest")
    rows = few.groupBy("name", "place").agg(F.first("text").alias("text")).select("name", "text")
    schema = pa.schema([("name", pa.string()), ("bin", pa.int32()), ("n", pa.int64()), ("texts", pa.int64())])

    def count(batches):
        for batch in A.slices(batches, "text", 1 << 20):
            bins, n, _ = _trigrams(batch, "text")
            names, which = np.unique(np.array(batch.column("name").to_pylist()), return_inverse=True)
            doc = np.repeat(which, n)
            for k, name in enumerate(names.tolist()):
                found = np.bincount(bins[doc == k], minlength=BINS)
                at = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array([name] * (len(at) + 1)), pa.array([-1, *at.tolist()], pa.int32()), pa.array([0, *found[at].tolist()], pa.int64()), pa.array([int((which == k).sum())] + [0] * len(at), pa.int64())], schema=schema)

    counts = stash(rows.mapInArrow(A.tidy(count), "name string, bin int, n long, texts long").groupBy("name", "bin").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")), "trigrams")
    names = sorted(r["name"] for r in counts.where("bin = -1").select("name").collect())
    table = np.full((BINS, len(names) + 1), 0.5)
    if names:  # at most BINS rows for each language, as columns
        found = counts.where((F.col("bin") >= 0) & F.col("name").isin(names)).select("name", "bin", "n").toArrow()
        column = np.searchsorted(names, found.column("name").to_pylist())
        np.add.at(table, (found.column("bin").to_numpy(), column), found.column("n").to_numpy())
    table[:, -1] = 1
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def likelihoods(docs: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """``docs`` (row key, doc_id, declared, host, suffix, text) without the text, with its number of ``words``, ``scores`` (log-likelihoods) and ``own``, the posterior of the text alone in millionths."""
    keep = [c for c in docs.columns if c != "text"]
    width = len(names) + 1
    prior = np.log(np.append(np.full(len(names), (1 - UND_PRIOR) / max(1, len(names))), UND_PRIOR))

    def run(batches):
        for batch in A.slices(batches, "text", 1 << 20):
            bins, n, words = _trigrams(batch, "text")
            scores = np.zeros((batch.num_rows, width))
            some = np.flatnonzero(n)
            heads = (np.cumsum(n) - n)[some]
            for k in range(width if len(some) else 0):
                scores[some, k] = np.add.reduceat(table[bins, k].astype(np.float64), heads)
            scores *= (np.minimum(n, WEIGHT) / np.maximum(n, 1))[:, None]
            total = scores + prior
            own = np.exp(total - total.max(axis=1, keepdims=True))
            own = np.rint(own / own.sum(axis=1, keepdims=True) * UNIT).astype(np.int64)
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), pa.array(x.ravel(), kind))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(words, pa.int64()), lists(np.round(scores, 6), pa.float64()), lists(own, pa.int64())], names=[*keep, "words", "scores", "own"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.mapInArrow(A.tidy(run), f"{fields}, words long, scores array<double>, own array<long>")


def _sums(rows: DataFrame, width: int, *keys: str) -> DataFrame:
    """For each key the summed posteriors of its texts, as an array of texts' worth."""
    each = rows.groupBy(*keys).agg(*[F.sum(F.get("own", F.lit(i))).alias(f"s{i}") for i in range(width)])
    return each.select(*keys, F.array(*[F.col(f"s{i}").cast("double") / UNIT for i in range(width)]).alias("sums"))


def _smoothed(sums: Column, above: Column, strength: float = SMOOTHING) -> Column:
    total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(sums, above, lambda s, p: (s + strength * p) / (total + strength))


def host_priors(rows: DataFrame, width: int) -> tuple[DataFrame, list[float]]:
    """(host, suffix, prior) smoothed by the suffix, and that by the whole corpus, whose prior is returned too."""
    hosts = stash(_sums(rows, width, "host", "suffix"), "hosts")
    add = lambda df, *keys: df.groupBy(*keys).agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]).select(*keys, F.array(*[F.col(f"s{i}") for i in range(width)]).alias("sums"))
    whole = add(hosts).first()
    sums = [x or 0.0 for x in whole["sums"]] if whole else [0.0] * width
    overall = [(s + 1.0) / (sum(sums) + width) for s in sums]
    base = F.array(*map(F.lit, overall))
    suffixes = add(hosts, "suffix").select(F.col("suffix").alias("ending"), _smoothed(F.col("sums"), base).alias("above"))
    joined = hosts.join(suffixes, hosts["suffix"].eqNullSafe(suffixes["ending"]))
    return joined.select("host", "suffix", _smoothed(F.col("sums"), F.when(F.col("suffix").isNull(), base).otherwise(F.col("above"))).alias("prior")), overall


def declared_likelihoods(rows: DataFrame, width: int) -> DataFrame:
    """(declared, given): for each declared language how likely texts of each language are to declare it."""
    sums = stash(_sums(rows.where("declared is not null"), width, "declared"), "declared")
    totals = sums.agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
    n = [x or 0.0 for x in totals]
    given = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (F.get("sums", i) + 1.0) / (F.get(F.array(*map(F.lit, n)), i) + SMOOTHING))
    return sums.select("declared", given.alias("given"))


def identify(docs: DataFrame, declared: Column | str | None = "lang", host: Column | str | None = "source", suffix: Column | str | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, declared, ``language``, ``confidence``, ``kept``. ``declared`` also labels the sample that the trigrams are fitted on."""
    as_column = lambda c: F.lit(None).cast("string") if c is None else (F.col(c) if isinstance(c, str) else c).cast("string")
    ending = F.regexp_extract(F.lower(as_column(host)), r"\.([a-z]+)$", 1) if suffix is None else as_column(suffix)
    ending = F.when(ending != "", ending)
    d = with_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.trim(as_column(declared))).alias("declared"), as_column(host).alias("host"), ending.alias("suffix"), F.col("text").cast("string").alias("text"))
    names, table = fit(d.select("doc_id", "text", F.col("declared").alias("label")), sample)
    if not names:
        return d.select(ROW, "doc_id", "declared", F.lit(UND).alias("language"), F.lit(0.0).alias("confidence"), F.lit(True).alias("kept"))
    width = len(names) + 1
    rows = stash(likelihoods(d, names, table), "likelihoods")
    hosts, overall = host_priors(rows, width)
    said = declared_likelihoods(rows, width)
    base = F.array(*map(F.lit, overall))
    found = rows.join(hosts.select(F.col("host").alias("h"), F.col("suffix").alias("e"), "prior"), F.col("host").eqNullSafe(F.col("h")) & F.col("suffix").eqNullSafe(F.col("e")), "left").join(said, "declared", "left")
    prior = F.when(F.col("host").isNull() & F.col("suffix").isNull(), base).otherwise(F.coalesce("prior", base))
    given = F.coalesce("given", F.array(*[F.lit(1.0)] * width))
    fused = F.zip_with(F.zip_with("scores", prior, lambda s, p: s + F.log(p)), given, lambda s, g: s + F.log(g))
    found = found.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    each = F.transform("fused", lambda s: F.exp(s - F.col("top")))
    share = F.lit(1.0) / F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
    place = F.array_position("fused", F.col("top")).cast("int")
    language = F.when(F.col("words") == 0, UND).otherwise(F.element_at(F.array(*map(F.lit, [*names, UND])), place))
    return found.select(ROW, "doc_id", "declared", language.alias("language"), F.when(F.col("words") == 0, F.lit(0.0)).otherwise(F.round(share, 6)).alias("confidence")).withColumn("kept", F.col("language") != UND)


def only_identified(docs: DataFrame, **evidence) -> DataFrame:
    """The rows of ``docs`` whose language is known, with all their columns."""
    docs = keyed(docs)
    kept = identify(docs, **evidence).where("kept").select(ROW)
    return own_columns(docs.join(kept, ROW, "left_semi"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Web pages (page_id, url, html) as documents: doc_id, text without tags, lang from the markup, host and address suffix."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)
    drop = [r"(?is)<(script|style)\b.*?</\1>", r"(?s)<!--.*?-->", r"<[^>]*>"]
    text = reduce(lambda c, p: F.regexp_replace(c, p, " "), drop, F.coalesce("html", F.lit("")))
    lang = F.regexp_extract("html", r"""(?i)<html[^>]*\blang=["']?([a-z]{2,3})""", 1)
    return pages.select(F.col("page_id").alias("doc_id"), text.alias("text"), F.when(lang != "", lang).alias("lang"), F.when(host != "", host).alias("host"))


def language_of_pages(spark, sf_dir: str) -> DataFrame:
    """Web pages by all four kinds of evidence: text, markup language, address suffix and host."""
    return identify(page_evidence(spark.read.parquet(f"{sf_dir}/pages.parquet")), host="host").select(F.col("doc_id").alias("page_id"), "declared", "language", "confidence", "kept")


def op5(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop(ROW)
