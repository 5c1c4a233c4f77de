"""Connected components and ancestor closures, as joins that repeat until nothing changes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators.joins import same_name_pairs


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in spark.checkpoint.dir; a local master without that setting gets a temporary folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint()


def scratch(df: DataFrame) -> str:
    """A new folder name in the shared checkpoint folder."""
    cut(df.limit(0))  # makes sure of that folder
    return f"{df.sparkSession.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def components(pairs: DataFrame) -> DataFrame:
    """(node, label) for all ends of ``pairs`` (a, b): the smallest node of each connected component.

    Each round takes the smallest label among neighbours, then jumps to that label's label, so long chains
    shorten by half. Partial minima keep a node with many neighbours from being one task's work.
    """
    both = cut(pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct())
    labels = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label"))
    while True:
        labels = cut(labels)
        near = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "label")
        best = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = cut(best.join(jump, "next", "left").select("node", F.coalesce("further", "next").alias("label")))
        if moved.join(labels, ["node", "label"], "left_anti").isEmpty():
            return moved
        labels = moved


def same_place_groups(index: DataFrame) -> DataFrame:
    """``index`` with group_id: the smallest collection/place_id of its copies; null for a place without any."""
    groups = components(same_name_pairs(index)).select(F.col("node").alias("member"), F.col("label").alias("group_id"))
    return index.withColumn("member", F.concat_ws("/", "collection", "place_id")).join(groups, "member", "left").drop("member")


def lineage_closure(parents: DataFrame) -> DataFrame:
    """(id, lineage): itself, then its ancestors to the root. ``parents`` has (id, parent).

    Doubles the known stretch of every lineage each round, so the rounds are the logarithm of the depth.
    """
    paths = cut(parents.select("id", F.array("id").alias("lineage"), F.col("parent").alias("next")))
    while True:
        open_ = paths.where("next is not null")
        if open_.isEmpty():
            return paths.select("id", "lineage")
        step = paths.select(F.col("id").alias("next"), F.col("lineage").alias("more"), F.col("next").alias("then"))
        joined = open_.join(step, "next", "left").select("id", F.concat("lineage", F.coalesce("more", F.array().cast("array<bigint>"))).alias("lineage"), F.col("then").alias("next"))
        paths = cut(paths.where("next is null").unionByName(joined))
