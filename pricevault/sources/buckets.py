"""Parquet folders laid out in buckets of a key, so that joins and windows on it move no stored row.

Spark keeps bucketing in its catalog only: a folder is written through a short-lived external table and
read through one that names its layout. The entries are external, so dropping them keeps the files.
A folder must be read with the number of buckets that it was written with; callers keep that number
beside the data.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.catalog import register_bucketed
from pricevault.sources.tablelog import PACKED, by_partition


def write_bucketed(
    df: DataFrame, folder: str, key: str, buckets: int, partition_by: Sequence[str] = (), gathered: bool = False
) -> None:
    """Replace ``folder`` with the rows of ``df``, ``buckets`` sorted buckets in each partition.

    Rows are gathered by partition and bucket first. Spark's rebalance merges small pairs and splits large
    ones, so a bucket is one file, or a few where it is large. Rows already ``gathered`` by key into as many tasks
    are written from there. ``df`` must not read the folder.
    """
    name = f"default.writing_{uuid.uuid4().hex}"
    spread = df
    if not gathered:
        placed = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        spread = by_partition(placed, [*partition_by, "_bucket"]).drop("_bucket")
    writer = spread.write.mode("overwrite").format("parquet").option("path", folder).option("partitionOverwriteMode", "static")
    writer = writer.options(**PACKED)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    try:
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int, partition_by: Sequence[str]
) -> DataFrame:
    """All partitions that ``path`` holds now, none if nothing was written; ``schema`` includes the partition columns."""
    layout = f"{path} {buckets} {key} {partition_by} {schema.simpleString()}"
    name = f"default.bucketed_{hashlib.sha256(layout.encode()).hexdigest()[:32]}"
    register_bucketed(spark, name, path, schema, key, buckets, partition_by)
    return spark.table(name)
