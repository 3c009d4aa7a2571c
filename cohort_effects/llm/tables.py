"""Small DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.session import ensure_checkpoint_dir


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers that share the driver's disk (local mode) import
    this package from where the driver did; a cluster has it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(docs: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and nothing else (but ``keep``), so that extra
    columns of the input cannot clash with the columns an operator adds; null
    text is empty."""
    return docs.select(
        *keep,
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, giving what it has freed back to the system at
    its end: Python workers are used again, and an executor's memory limit counts
    what idle ones hold."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim is not None:
                trim(0)

    return wrapped


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def held_out(id_col, folds: int, fold: int):
    """crc32 of the id as text modulo ``folds`` equals ``fold`` (a null id
    counts as the empty text, crc32 0)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system that is no longer read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
