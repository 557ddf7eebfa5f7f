"""Scans. Paths are URIs for Hadoop's file systems; schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.schemas import RAW_COMPANY, Grain

#: Where a raw file's symbol stands in its path, for the two layouts in use.
SYMBOL_FOLDER = r"([^/]+)/historical(?:_minute)?/[^/]+$"
SYMBOL_PARTITION = r"Symbol=([^/]+)/[^/]+$"

#: Columns of a scan that keeps records it can't read: the record's text (NULL for a good one) and its file.
RAW_LINE, RAW_FILE = "_raw_line", "_raw_file"

COMPANY_GLOB = "*/info/meta.json"


def _symbol_from_path(pattern: str):
    return F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def _with_raw(scan: DataFrameReader, schema: T.StructType) -> DataFrameReader:
    """A scan that leaves what it can't read NULL and keeps that record's text."""
    kept = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
    return scan.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE)


def read_bars_csv(
    spark: SparkSession,
    base: str,
    grain: Grain,
    glob: str | None = None,
    symbol_pattern: str = SYMBOL_FOLDER,
    keep_broken: bool = False,
) -> DataFrame:
    """Raw bars of all symbols below ``base``; ``Symbol`` comes from each file's path.

    ``keep_broken`` adds the text of lines that don't fit the schema and every line's file, for the
    rejects of a bronze load.
    """
    files = f"{base.rstrip('/')}/{glob or grain.raw_glob}"
    scan = spark.read.option("header", True)
    scan = _with_raw(scan, grain.raw_schema) if keep_broken else scan.schema(grain.raw_schema)
    bars = scan.csv(files).withColumn("Symbol", _symbol_from_path(symbol_pattern))
    return bars.withColumn(RAW_FILE, F.col("_metadata.file_path")) if keep_broken else bars


def read_company_json(spark: SparkSession, base: str, glob: str = COMPANY_GLOB, keep_broken: bool = False) -> DataFrame:
    """The company facts the warehouse uses, from one JSON object per symbol; ``keep_broken`` as for bars."""
    scan = _with_raw(spark.read, RAW_COMPANY) if keep_broken else spark.read.schema(RAW_COMPANY)
    facts = scan.json(f"{base.rstrip('/')}/{glob}")
    return facts.withColumn(RAW_FILE, F.col("_metadata.file_path")) if keep_broken else facts


def read_source(
    spark: SparkSession, table: str | None = None, path: str | None = None
) -> DataFrame:
    """A Parquet path if given, else a catalog table."""
    if path:
        return spark.read.parquet(path)
    if table:
        return spark.table(table)
    raise ValueError("give a table name or a path")


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """The data below ``path``, or an empty frame when nothing was written there yet."""
    try:
        return spark.read.format(fmt).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
