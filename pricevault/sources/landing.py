"""Write-once landing of raw files: the first fetch of a symbol is kept.

A landing zone holds the raw rows of each batch under ``data`` and the symbols it brought
under ``symbols``. Files are sized by Spark, not one per symbol, so neither a million
small symbols nor one very large one hurt; which symbols are known is read from the small
symbol log instead of from folder names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pricevault.operators.keyed import absent_from
from pricevault.operators.skew import hash_piece, spread_join
from pricevault.sources.tablelog import BATCH, append_log, read_log

SYMBOL = T.StructType([T.StructField("Symbol", T.StringType())])


def landed_symbols(spark: SparkSession, base: str, upto: int | None = None, may_be_new: bool = False) -> DataFrame:
    """Symbols landed by batch ``upto`` (by any batch by default)."""
    return read_log(spark, f"{base}/symbols", SYMBOL, upto, may_be_new).select("Symbol").distinct()


def land_once(df: DataFrame, base: str, batch_id: int, fmt: str = "csv") -> None:
    """Land the rows of symbols that no earlier batch landed.

    Rows are written before the symbol log, and running the batch again replaces both.
    """
    landed = landed_symbols(df.sparkSession, base, upto=batch_id - 1, may_be_new=True)
    fresh = spread_join(df, landed, "Symbol", hash_piece(*df.columns), how="left_anti")
    append_log(fresh, f"{base}/data", batch_id, fmt=fmt)
    symbols = absent_from(landed, df.select("Symbol").distinct(), ["Symbol"])
    append_log(symbols, f"{base}/symbols", batch_id)


def read_landed(
    spark: SparkSession, base: str, schema: T.StructType, fmt: str = "csv"
) -> DataFrame:
    """All landed rows; ``schema`` is that of the landed frames, in their column order."""
    stored = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.format(fmt).schema(stored).options(header=True).load(f"{base}/data").drop(BATCH)
