"""A corpus pipeline of five stages, each one operator over all that the stage before it kept.

The stages are language ID, exact dedup, near-dedup, mixing and SentencePiece encoding. Each stage's result is written to
the shared folder and read again as the next one's documents, so a lost executor costs at most one stage. A stage writes its
documents once with their row key; then the scratch tables of the stage before are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import exact_dedup, language_id, mixing, near_dedup, sentencepiece_codec
from terrane.llm.common import collected, discard, keyed, stash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_BEFORE: dict[str, list[DataFrame]] = {}


def _keyed_stage(operator):
    """A stage that runs ``operator`` on its documents, written with their row key."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with collected() as made:
            docs = keyed(docs.select(*COLUMNS))
            discard(*_BEFORE.pop(sf_dir, []))
            result = operator(docs).select(*COLUMNS)
        _BEFORE[sf_dir] = made
        return result

    return stage


#: Keeps documents whose language is known.
identify = _keyed_stage(language_id.only_identified)
#: Keeps one of equal texts.
drop_copies = _keyed_stage(exact_dedup.dedup)
#: Keeps one document of each class of near copies.
drop_near_copies = _keyed_stage(near_dedup.dedup)
#: Takes each document as often as the mix of sources asks for.
mix = _keyed_stage(mixing.mix)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the mix. ``exact`` says that decoding gives the text back."""
    rows = sentencepiece_codec.encode(docs.select("doc_id", "source", "lang", "text"), back="decoded")
    return rows.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("mixing", mix),
    ("SentencePiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, f"stage-{k}")
    return docs


#: Near-dedup, language ID and encoding are not SQL; the pipeline is tested against a plain version instead.
ORACLE_SQL = None
