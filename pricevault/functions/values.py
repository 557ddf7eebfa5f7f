"""Parsing and derived values of bars and company facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed text form of a raw bar time: local time and offset.
RAW_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}([+-]\d{2}:\d{2}|Z)$"


def canonical(name: str) -> Column:
    """Business key without outer blanks, in upper case."""
    return F.upper(F.trim(F.col(name)))


def parse_date(name: str) -> Column:
    """Local calendar date of a raw bar time; NULL if the whole text is none."""
    raw = F.col(name)
    return F.when(raw.rlike(RAW_TIME), F.substring(raw, 1, 10).try_cast("date"))


def parse_datetime(name: str) -> Column:
    """UTC instant (zone-free type) of a raw bar time; NULL if it is none."""
    raw = F.col(name)
    local = F.substring(raw, 1, 19).try_cast("timestamp_ntz")
    offset = F.substring(raw, 20, 6)
    return F.when(raw.rlike(RAW_TIME), F.convert_timezone(offset, F.lit("UTC"), local))


def ratio(numerator: str, denominator: str) -> Column:
    """Quotient; NULL when the divisor is zero."""
    return F.try_divide(F.col(numerator), F.col(denominator))


def movement() -> Column:
    """``up`` when the bar closed above its open, else ``down`` (flat and unknown too)."""
    return F.when(F.col("Close") > F.col("Open"), "up").otherwise("down")


def price_range() -> Column:
    return F.col("High") - F.col("Low")
