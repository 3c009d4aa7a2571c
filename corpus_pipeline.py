"""A corpus pipeline over ``documents``: quality, near and substring dedup,
benchmark decontamination, packing.

Each stage takes all rows its predecessor kept and decides for all of them; the
first four return the columns of ``documents``.  ``run`` writes each result as
Parquet into the shared folder of ``spark.checkpoint.dir``, reads it back and
drops the one before it.
No stage is expressible in SQL as a whole, so there is no ``ORACLE_SQL``; the
tests hold every stage against a brute-force version.

Rows with null or empty text pass the filters (nothing is known against them)
and are packed as the end id alone; a document whose text is cut away wholly
leaves with its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.op1_decontaminate import clean
from cohort_effects.llm.op3_packing import pack_documents
from cohort_effects.llm.op4_quality import accepted
from cohort_effects.llm.op8_minhash import representatives
from cohort_effects.llm.op9_substring import cut_passages
from cohort_effects.llm.tables import on_workers, read, remove
from cohort_effects.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return accepted(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles,
    similarity of 0.8 or more)."""
    return representatives(docs, shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut."""
    cut = cut_passages(docs).where("not cut or text <> ''").drop("cut")
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark text, or a paraphrase of one, go."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # the stage after it is written
            remove(spark, before)
        before = path
    return docs
