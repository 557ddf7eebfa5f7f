"""Price and volume analyses over bar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricevault.operators.series import calendar_piece, with_neighbour
from pricevault.operators.skew import spread_join


# Filters


def of_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.filter(F.col("Symbol") == symbol)


def symbol_like(df: DataFrame, pattern: str) -> DataFrame:
    return df.filter(F.col("Symbol").like(pattern))


def key_not_like(df: DataFrame, key: str, pattern: str) -> DataFrame:
    return df.filter(~F.col(key).like(pattern))


def after_day(df: DataFrame, time: str, day: str) -> DataFrame:
    """Rows of later days than ``day``, as a bare comparison that reaches the scan."""
    return df.filter(F.col(time) >= _day_start(df, time, F.date_add(F.lit(day).cast("date"), 1)))


def on_day(df: DataFrame, time: str, day: str) -> DataFrame:
    """Rows of one calendar day, as a range on the time column that reaches the scan."""
    start = F.lit(day).cast("date")
    return df.filter(
        (F.col(time) >= _day_start(df, time, start))
        & (F.col(time) < _day_start(df, time, F.date_add(start, 1)))
    )


def _day_start(df: DataFrame, time: str, day: Column) -> Column:
    return day.cast(df.schema[time].dataType)


def corporate_actions(df: DataFrame) -> DataFrame:
    """Bars with a dividend or a split."""
    return df.filter((F.col("Dividends") > 0) | (F.col("Stock_Splits") > 0))


# Aggregates


def profile(df: DataFrame, time: str = "Date", approximate: bool = False) -> DataFrame:
    """Symbols, first and last time, rows. ``approximate`` counts symbols by sketch."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        distinct("Symbol").alias("n_symbols"),
        F.min(time).alias("first_date"),
        F.max(time).alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def column_min(df: DataFrame, name: str, out: str) -> DataFrame:
    return df.agg(F.min(name).alias(out))


def column_mean(df: DataFrame, name: str, out: str) -> DataFrame:
    return df.agg(F.avg(name).alias(out))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def extremes(df: DataFrame) -> DataFrame:
    """All-time high and low close of each symbol."""
    return df.groupBy("Symbol").agg(
        F.max("Close").alias("ath_close"), F.min("Close").alias("atl_close")
    )


def average_volume(df: DataFrame) -> DataFrame:
    return df.groupBy("Symbol").agg(F.avg("Volume").alias("avg_volume"))


# Series


def with_previous_close(df: DataFrame) -> DataFrame:
    bars = df.select("Symbol", "Date", "Close")
    return with_neighbour(bars, "Close", "prev_close", ["Symbol"], "Date")


def daily_returns(df: DataFrame) -> DataFrame:
    """Relative change against the bar before; first bars have none and are left out."""
    change = F.try_divide(F.col("Close") - F.col("prev_close"), F.col("prev_close"))
    return (
        with_previous_close(df)
        .filter(F.col("prev_close").isNotNull())
        .withColumn("daily_return", change)
    )


def price_change(df: DataFrame) -> DataFrame:
    """Difference and percent change against the bar before; first bars keep NULL."""
    diff = F.col("Close") - F.col("prev_close")
    return with_previous_close(df).select(
        "Symbol",
        "Date",
        "Close",
        "prev_close",
        diff.alias("diff"),
        (F.try_divide(diff, F.col("prev_close")) * 100).alias("pct"),
    )


# Bars against their symbol's statistics


def with_volume_stats(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Add mean and sample deviation of the symbol's volume.

    The statistics are one row per symbol after map-side aggregation; they are joined to the
    symbol's months and those to its bars, where a window would gather a symbol in one task.
    ``stats`` (``Symbol``, ``avg_vol``, ``std_vol``) takes them from a store instead.
    """
    if stats is None:
        stats = df.groupBy("Symbol").agg(
            F.avg("Volume").alias("avg_vol"), F.stddev_samp("Volume").alias("std_vol")
        )
    stats = stats.select("Symbol", "avg_vol", "std_vol")
    bars = df.select("Symbol", "Date", "Volume")
    return spread_join(bars, stats, "Symbol", calendar_piece("Date", bars.schema["Date"].dataType))


def volume_zscore(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Deviation of a bar's volume in standard deviations; flat symbols are left out."""
    spread = F.nullif(F.col("std_vol"), F.lit(0.0))
    return (
        with_volume_stats(df, stats)
        .filter(F.col("std_vol") > 0)
        .withColumn("z_score", (F.col("Volume") - F.col("avg_vol")) / spread)
        .select("Symbol", "Date", "Volume", "avg_vol", "z_score")
    )


def volume_vs_average(df: DataFrame, symbol: str) -> DataFrame:
    """One symbol's bars against its average volume.

    The average of one symbol is one row, so its broadcast has a fixed size and the
    symbol's bars are never gathered in one task.
    """
    bars = of_symbol(df, symbol)
    average = F.broadcast(average_volume(bars))
    return bars.join(average, "Symbol").select(
        "Date", "Volume", "avg_volume", (F.col("Volume") - F.col("avg_volume")).alias("diff")
    )


# Order and limit


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a full order; planned as a top-k, not as a sort."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """A repeatable look at ``n`` rows."""
    return top(df, n, *[F.col(k) for k in keys])


def row_with_max(df: DataFrame, name: str, tie: str) -> DataFrame:
    return top(df, 1, F.col(name).desc_nulls_last(), F.col(tie))


def row_with_min(df: DataFrame, name: str, tie: str) -> DataFrame:
    return top(df, 1, F.col(name).asc_nulls_last(), F.col(tie))


def oldest(people: DataFrame) -> DataFrame:
    return row_with_max(people, "age", "name")


def youngest(people: DataFrame) -> DataFrame:
    return row_with_min(people, "age", "name")


def lowest_paid(people: DataFrame, gender: str) -> DataFrame:
    return row_with_min(people.filter(F.col("gender") == gender), "salary", "name")
