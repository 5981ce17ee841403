"""From raw documents to a mix for training, stage by stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on what the stage before it kept; ``run`` writes every
result as Parquet to the shared folder and reads it again. A stage removes the intermediate tables of those before it, unless
its documents still read them; so the result of a stage has to be written before another stage is called.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chunk_dedup import dedup_substrings
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import one_of_each
from tidemark.llm.queries import GOOD_QUALITY, scored_quality
from tidemark.llm.source_mix import mix_sources
from tidemark.session import remove_folder, scratch_folder, shared_folder, staged

#: No SQL expresses the classifier, the chunks and so what the later stages see; tests use brute-force versions.
ORACLE_SQL = None


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage whose intermediate tables lie in a folder of the pipeline, which holds those of one stage."""

    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = f"pipeline-{spark.sparkContext.applicationId}"
        folder = f"{shared_folder(spark)}/{name}"
        if not any(f"/{name}/" in file for file in docs.inputFiles()):
            remove_folder(spark, folder)
        with scratch_folder(f"{folder}/{uuid.uuid4().hex}"):
            return work(spark, docs, sf_dir)

    return stage


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good."""
    scored = scored_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where(F.col("score") >= GOOD_QUALITY).select("doc.*")


@_stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents linked by five-word shingles at a similarity of 0.8, the one of the smallest id."""
    return one_of_each(docs, words=5, num=80, den=100)


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those of which no word is left go."""
    found = dedup_substrings(docs, keep=[c for c in docs.columns if c != "text"])
    kept = found.where("n_removed = 0 OR n_removed < n_words")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))
    now = {"text": F.col("text"), "n_chars": n_chars}
    return kept.select(*(now[c] if c in now else F.col("doc")[c] for c in docs.columns)).toDF(*docs.columns)


@_stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    judged = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=docs.columns)
    return judged.where("n_hit = 0").select("doc.*")


@_stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix_sources(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("source mixing", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix made from the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
