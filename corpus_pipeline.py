"""Corpus pipeline: documents through five training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.llm.common import KeyFilter, checkpointed, table
from closecast.llm.decontaminate import decontaminate
from closecast.llm.line_dedup import dedup_lines
from closecast.llm.mixing import mix_sources
from closecast.llm.order_minhash import near_duplicates
from closecast.llm.quality import score_quality, train
from closecast.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps (score 0.3 or more)."""
    trees = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, trees).where("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line of the corpus."""
    return dedup_lines(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id (a null one last).

    A row's node is its id and text, so rows with equal or null ids take part by
    their own texts; of rows equal in both one stays.
    """
    node = F.xxhash64(F.col("doc_id").cast("string"), F.col("doc_id").isNull(), F.col("text"))
    named = docs.withColumn("__node", node)
    nodes = near_duplicates(named.select(F.col("__node").alias("doc_id"), "text"))
    classes = checkpointed(nodes.groupBy(F.col("doc_id").alias("__node")).agg(F.min("class_id").alias("class_id"), F.count(F.lit(1)).alias("n")))
    many = classes.groupBy("class_id").agg(F.sum("n").alias("rows")).where("rows > 1").select("class_id")
    several = checkpointed(classes.join(many, "class_id").select("__node", "class_id"))
    thin = KeyFilter(several.select("__node"))
    ids = thin.split(named.select("__node", "doc_id"), "__node").where("maybe").select("__node", "doc_id")
    listed_ids = checkpointed(ids.join(several, "__node"))
    first = listed_ids.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__node"))).alias("x")).select(F.col("x.__node").alias("__node"))
    # texts whose node is surely not listed need no join
    split = thin.split(named, "__node")
    listed = split.where("maybe").drop("maybe")
    kept = listed.join(several.select("__node").hint("merge"), "__node", "left_anti").unionByName(
        listed.join(first.hint("merge"), "__node", "left_semi").dropDuplicates(["__node"]))
    return split.where("not maybe").drop("maybe").unionByName(kept).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its block and slot in the mix of the sources."""
    return mix_sources(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Trees, set joins and sketches are not expressible in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
