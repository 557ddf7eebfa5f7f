"""Table registry: schemas, external tables, views, listings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pricevault.schemas import TableSpec


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, name: str, base: str | None = None) -> None:
    """Create the schema if missing; its own folder lies below ``base`` when given."""
    place = f" LOCATION {_quote(base.rstrip('/') + '/' + name + '.db')}" if base else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def columns_ddl(schema: T.StructType) -> str:
    parts = []
    for f in schema:
        required = "" if f.nullable else " NOT NULL"
        parts.append(f"`{f.name}` {f.dataType.simpleString()}{required}")
    return ", ".join(parts)


def create_table(
    spark: SparkSession,
    spec: TableSpec,
    base: str,
    schema: str,
    repoint: bool = False,
    buckets: int = 0,
) -> None:
    """Create an external Parquet table at the spec's place below ``base``.

    ``repoint`` drops the entry first; the files of an external table stay. ``buckets``
    lays bar-sized tables out by their merge key, so that later merges and views on that
    key need no shuffle of the stored side.
    """
    name = f"{schema}.{spec.name}"
    if repoint:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    layout = f" PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    if buckets and spec.bucket_by:
        key = spec.bucket_by
        layout += f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(spec.schema)}) USING PARQUET OPTIONS (compression 'zstd')"
        f"{layout} LOCATION {_quote(spec.location(base))}"
    )
    if spec.partition_by:
        # Make sure the folder is there, then find the partitions it already holds.
        none = spark.createDataFrame([], spec.schema)
        none.write.mode("ignore").partitionBy(*spec.partition_by).parquet(spec.location(base))
        spark.catalog.recoverPartitions(name)


def create_tables(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    base: str,
    schema: str,
    repoint: bool = False,
    buckets: int = 0,
) -> None:
    create_schema(spark, schema, base)
    for spec in specs:
        create_table(spark, spec, base, schema, repoint, buckets)


def register_external(spark: SparkSession, name: str, path: str) -> None:
    """Register existing Parquet data under a table name, or pick up its new partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION {_quote(path)}")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def register_bucketed(
    spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int, partition_by: Sequence[str]
) -> None:
    """Register a folder of bucketed Parquet partitions, or make the entry follow the partitions that it holds now."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partition_by).parquet(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(schema)}) USING PARQUET PARTITIONED BY ({', '.join(partition_by)})"
        f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION {_quote(path)}"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def create_view(spark: SparkSession, name: str, query: str, replace: bool = True) -> None:
    """Create a view; an existing one is replaced, or kept if ``replace`` is off."""
    how = "CREATE OR REPLACE VIEW" if replace else "CREATE VIEW IF NOT EXISTS"
    spark.sql(f"{how} {name} AS {query}")


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {name}")
