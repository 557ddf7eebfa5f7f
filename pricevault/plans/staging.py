"""Typed rows with hash keys and audit columns, ready to load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricevault.functions import canonical, hash_diff, hash_key
from pricevault.operators.history import moment
from pricevault.operators.quality import key_gate
from pricevault.schemas import COMPANY, PRICE_COLUMNS, SAT_COMPANY_INFO, Grain, SatSpec


def with_audit(df: DataFrame, load_dts: datetime | str | None, source: str) -> DataFrame:
    """Add ``Load_DTS`` (one UTC value for the whole run, now by default) and ``Record_Source``."""
    now = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    at = now if load_dts is None else moment(load_dts)
    return df.withColumn("Load_DTS", at).withColumn("Record_Source", F.lit(source))


def stage_bars(
    df: DataFrame, grain: Grain, load_dts: datetime | str | None, source: str
) -> DataFrame:
    """Bars with canonical symbol, fixed types, hash keys, hash-diff and audit columns.

    Only expressions are added. A load that selects a few of them makes Spark read only
    the bar columns these need.
    """
    keyed = key_gate(df.withColumn("Symbol", canonical("Symbol")), [grain.time, "Symbol"])
    fields = [f for f in grain.bronze.schema if f.name in (grain.time, *PRICE_COLUMNS)]
    typed = keyed.select("Symbol", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    hub, link = grain.hub, grain.link
    staged = (
        typed.withColumn("Instrument_HK", hash_key("Symbol"))
        .withColumn(hub.hash_key, hash_key(grain.time))
        .withColumn(link.link_key, hash_key(*link.business_keys))
        .withColumn("Hash_Diff", hash_diff(typed.schema, PRICE_COLUMNS))
    )
    return with_audit(staged, load_dts, source)


def stage_company(
    df: DataFrame,
    load_dts: datetime | str | None,
    source: str,
    spec: SatSpec = SAT_COMPANY_INFO,
) -> DataFrame:
    """Company facts with instrument key and hash-diff over the satellite's attributes."""
    symbol = df.withColumn("Symbol", canonical("symbol"))
    types = {f.name: f.dataType for f in COMPANY.schema}
    typed = key_gate(symbol, ["Symbol"]).select(
        "Symbol", *[F.col(a).cast(types[a]).alias(a) for a in spec.attributes]
    )
    staged = typed.withColumn("Instrument_HK", hash_key("Symbol")).withColumn(
        "Hash_Diff", hash_diff(typed.schema, spec.attributes)
    )
    return with_audit(staged, load_dts, source)
