"""Sinks, and tables kept as append-only logs of batches.

A log is a Parquet folder partitioned by ``_batch_id``. Writing a batch replaces only that
batch's own folder, so a job that died half-way, or is run again, leaves the same
table. Reading up to a batch prunes the later folders: that is the table's version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.operators.keyed import latest
from pricevault.sources.readers import read_or_empty

BATCH = "_batch_id"
#: Second partition of a log that several loads of one batch write to.
LOAD = "_load"
#: Stored Parquet is packed by zstd, which halves the text of hash keys; snappy, Spark's default, leaves it as it is.
PACKED = {"compression": "zstd"}


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append Parquet files; see :func:`by_partition` for partitioned tables."""
    writer = by_partition(df, partition_by).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a Parquet folder that ``df`` does not read."""
    df.write.mode("overwrite").parquet(path)


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather rows by table partition before a write.

    Spark's rebalance merges small partitions into one file and spreads a large one
    over several tasks, so neither small files nor one giant file come out.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table if there is none; existing data stays."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append_log(
    df: DataFrame,
    path: str,
    batch_id: int,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    load: str | None = None,
    gathered: bool = False,
) -> None:
    """Write ``df`` as batch ``batch_id`` of the log, replacing all of that batch and no other.

    The batch's own folder is overwritten as a whole, so rows and partitions that an
    earlier run of the batch wrote and this one does not are gone; no rows empty it. Where
    several loads of one batch write to a log, each has a folder of its own, named by ``load``.
    Rows that a merge has just ``gathered`` are written from its tasks, not moved again by table partition: a
    partition then has a file for each task, and tasks follow the rows' size.
    """
    writer = (
        (df if gathered else by_partition(df, partition_by))
        .write.mode("overwrite")
        .options(**PACKED if fmt == "parquet" else {})
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .format(fmt)
    )
    (writer.option("header", True) if fmt == "csv" else writer).save(
        f"{path.rstrip('/')}/{BATCH}={int(batch_id)}" + (f"/{LOAD}={load}" if load else "")
    )


def read_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    upto: int | None = None,
    may_be_new: bool = False,
) -> DataFrame:
    """All rows of the log, or those of batches up to ``upto``, with ``_batch_id``.

    A missing log is an error, except for the writer of a first batch (``may_be_new``).
    """
    stored = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    log = read_or_empty(spark, path, stored) if may_be_new else spark.read.schema(stored).parquet(path)
    return log if upto is None else log.filter(F.col(BATCH) <= upto)


def read_as_of(log: DataFrame, keys: Sequence[str], batch_id: int) -> DataFrame:
    """The table as it stood after a batch: each key's newest row."""
    return latest(log.filter(F.col(BATCH) <= batch_id), keys, BATCH).drop(BATCH)


def history(log: DataFrame, keys: Sequence[str], loaded: str = "Load_DTS") -> DataFrame:
    """One row per batch: load time, rows, keys inserted and keys updated.

    A key counts as inserted in its first batch and as updated in every later one. The log is
    read once; keys are pre-aggregated per batch before they are shuffled.
    """
    per_key = log.groupBy(*keys, BATCH).agg(F.min(loaded).alias(loaded), F.count(F.lit(1)).alias("n_rows"))
    first = F.min(BATCH).over(Window.partitionBy(*keys)) == F.col(BATCH)
    batches = per_key.withColumn("_new", first).groupBy(BATCH)
    return batches.agg(
        F.min(loaded).alias(loaded),
        F.sum("n_rows").alias("n_rows"),
        F.count_if("_new").alias("n_inserted"),
        F.count_if(~F.col("_new")).alias("n_updated"),
    ).withColumnRenamed(BATCH, "batch_id")


def detail(spark: SparkSession, path: str, partition: str | None = None) -> DataFrame:
    """One row per batch of a log: files, bytes, rows, and values of its ``partition`` column.

    Files are told apart by the scan's hidden metadata; rows are counted per file in the map tasks.
    """
    log = spark.read.parquet(path)
    place = [F.col(partition).alias("_part")] if partition else []
    per_file = log.groupBy(BATCH, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"), *place)
    files = per_file.agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.count_distinct("_part") if partition else F.lit(0).cast("bigint")
    return files.groupBy(F.col(BATCH).cast("bigint").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("_size").alias("n_bytes"), F.sum("_rows").alias("n_rows"), parts.alias("n_partitions")
    )
