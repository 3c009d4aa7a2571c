"""Parquet scans and sinks, plus table metadata reports.

Reads are lazy: column pruning and filter pushdown reach the Parquet scan, so
callers select late and filter early without extra code.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.sources.versions import current_version, discard, new_version, publish

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Scan ``{base}/{name}.{fmt}``; the format is a flag, not guessed.

    The scan is split by files and row groups alone (the session's
    ``spark.sql.files.*`` settings); no key of the data decides where a row
    goes.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{base.rstrip('/')}/{name}.{fmt}")


def read_tables(spark: SparkSession, base: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    return {n: read_table(spark, base, n) for n in names}


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), mode: str = "overwrite", dynamic: bool = False
) -> str:
    """One directory per partition value; each task writes its own rows, no
    shuffle (``clustered.write_clustered`` lays out the files as well).
    ``dynamic=True`` overwrites only the partitions present in ``df`` (Z1); it is
    a per-write option, the session setting is left alone.
    """
    writer = df.sortWithinPartitions(*partition_by).write.mode(mode).partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def replace_table(df: DataFrame, target: str) -> str:
    """Full replace of a table.  The rows go to a version of their own, which
    is then pointed to; loading the same rows again gives the same table, and a
    load that fails leaves the one before.  Returns the version's folder."""
    version = new_version(target)
    try:
        df.write.parquet(version)
    except Exception:
        discard(df.sparkSession, version)
        raise
    publish(df.sparkSession, version)
    return version


def read_current(spark: SparkSession, target: str, schema=None) -> DataFrame:
    """The published version of a table."""
    folder = current_version(spark, target)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(folder)


def read_partition(
    spark: SparkSession, path: str, where: Mapping[str, object] | None = None, schema=None
) -> DataFrame:
    """Read a partitioned table back; equality filters prune directories.

    Pass the table's schema: partition discovery would otherwise infer the
    partition column's type from directory names (bigint -> int).
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    for k, v in (where or {}).items():
        df = df.filter(F.col(k) == F.lit(v))
    return df


def write_csv_by(df: DataFrame, path: str, by: str) -> str:
    """One CSV (with header) per value of ``by``.  Meant for report-sized
    tables (top lists), so each value is written by one task."""
    df.repartition(by).write.mode("overwrite").partitionBy(by).option("header", True).csv(path)
    return path


def describe_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column catalogue (table, column, type, nullable, position).

    Built from the schema objects alone; no data is scanned.
    """
    rows = []
    for tname, df in tables.items():
        for pos, f in enumerate(df.schema.fields, start=1):
            rows.append((tname, f.name, f.dataType.simpleString(), bool(f.nullable), pos))
    schema = "table_name string, column_name string, data_type string, is_nullable boolean, ordinal_position bigint"
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, schema)


def table_volumes(tables: Mapping[str, DataFrame], cap_bytes: float = 10e9, margin: float = 1.5) -> DataFrame:
    """Rows, bytes on disk, columns and share of total storage per table.

    Bytes come from the file metadata column (one value per file, summed over
    distinct files), so no data pages are decoded beyond the row count.
    """
    parts = []
    for tname, df in tables.items():
        files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
        per_table = files.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s")).agg(
            F.sum("n").cast("bigint").alias("n_rows"), F.sum("s").cast("bigint").alias("bytes")
        )
        parts.append(
            per_table.select(
                F.lit(tname).alias("table_name"),
                F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
                F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    from pyspark.sql import Window

    total = F.sum("bytes").over(Window.partitionBy())
    return out.select(
        "*",
        (F.col("bytes") / F.lit(1024.0 * 1024.0)).alias("mb"),
        F.try_divide(F.col("bytes").cast("double"), total).alias("share_of_storage"),
        (F.col("bytes") * F.lit(margin) <= F.lit(cap_bytes)).alias("fits_cap_with_margin"),
    )


def freshness(
    df: DataFrame,
    name: str,
    loaded_at=None,
    warn_days: float = 7,
    error_days: float = 30,
    now: _dt.datetime | None = None,
) -> DataFrame:
    """Age of the newest load (or event) against warn/error limits.

    With ``loaded_at=None`` the file modification time from the scan metadata
    is used (S13); otherwise the given column expression (S14).  ``now`` is a
    parameter so that runs are repeatable.
    """
    ts = F.col("_metadata.file_modification_time") if loaded_at is None else loaded_at
    if isinstance(ts, str):
        ts = F.col(ts)
    now_lit = F.lit(now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    agg = df.agg(F.max(ts.cast("timestamp_ntz")).alias("max_loaded_at"))
    age = (F.unix_micros(now_lit.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(
        86400.0 * 1e6
    )
    return agg.select(
        F.lit(name).alias("source"),
        F.col("max_loaded_at"),
        age.alias("age_days"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > F.lit(float(error_days)), "error")
        .when(age > F.lit(float(warn_days)), "warn")
        .otherwise("pass")
        .alias("status"),
    )

