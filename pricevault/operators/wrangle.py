"""Raw frames to the fixed bronze shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricevault.functions import parse_date, parse_datetime, ratio
from pricevault.schemas import COMPANY, DAY, Grain

#: Fixed renames from raw field to table column.
BAR_NAMES = {"Stock Splits": "Stock_Splits"}
COMPANY_NAMES = {"netIncomeToCommon": "netIncome", "bookValue": "bookValuePerShare"}


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def ensure_symbol(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Add ``Symbol`` as a constant when the frame has none."""
    if "Symbol" in df.columns:
        return df
    if not symbol:
        raise ValueError("the source has no Symbol column: pass symbol=")
    return df.withColumn("Symbol", F.lit(symbol))


def parse_time(df: DataFrame, grain: Grain) -> DataFrame:
    """Replace the raw time text by the grain's typed time column."""
    if grain is DAY:
        return df.withColumn(grain.time, parse_date(grain.raw_time))
    # The raw and the typed name differ only in case, so the text is replaced in place.
    return df.withColumn(grain.time, parse_datetime(grain.raw_time))


def bar_shape(df: DataFrame, grain: Grain) -> DataFrame:
    return df.select(*grain.bronze.columns)


def to_bronze(df: DataFrame, grain: Grain, symbol: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Raw bars to the bronze bar table; ``extra`` columns of the scan are kept behind it."""
    named = ensure_symbol(parse_time(rename(df, BAR_NAMES), grain), symbol)
    return named.select(*grain.bronze.columns, *extra)


def with_pe(df: DataFrame) -> DataFrame:
    return df.withColumn("priceToEarnings", ratio("currentPrice", "trailingEps"))


def company_shape(df: DataFrame) -> DataFrame:
    return df.select(*COMPANY.columns)


def to_bronze_company(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Raw company facts to the bronze company table; ``extra`` columns of the scan are kept behind it."""
    return rename(with_pe(df), COMPANY_NAMES).select(*COMPANY.columns, *extra)
