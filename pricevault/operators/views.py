"""Read views over the vault: joined bars with instrument and company."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.catalog import create_view
from pricevault.functions import movement, price_range, short_digest
from pricevault.operators.analytics import key_not_like, on_day
from pricevault.operators.history import AS_OF, LOADED, START, current, intervals, versions_at, with_moments
from pricevault.operators.keyed import latest
from pricevault.operators.skew import hash_piece, spread_join
from pricevault.schemas import DAY, MINUTE, Grain

Vault = Mapping[str, DataFrame]


def _prices(vault: Vault, grain: Grain, current_only: bool) -> DataFrame:
    prices = vault[grain.sat.table.name]
    if not current_only:
        return prices
    if grain.sat.versioned:
        return current(prices)
    # The insert-only satellite has no open mark: its newest load is the current one.
    return latest(prices, [grain.sat.parent_key], ["Load_DTS", "Hash_Diff"])


def _piece(link_key: str) -> Column:
    """One of 16 pieces of an instrument's bars: an instrument of few bars is then sent to few places."""
    return hash_piece(link_key, pieces=16)


#: Numbers of the pieces of an instrument's daily bars.
DAY_PIECES = range(4)


def _met(bars: DataFrame, named: DataFrame, grain: Grain, links: DataFrame) -> DataFrame:
    """Bars with their instrument's names, each instrument's bars in pieces.

    Daily bars are at most one a date, so the calendar bounds a piece: they have few, known ones, by year, and names go to all
    of these. Minute bars have the pieces that occur in ``links``.
    """
    if grain is DAY:
        piece = F.coalesce(F.pmod(F.year(grain.time), F.lit(len(DAY_PIECES))), F.lit(0))
        return spread_join(bars, named, "Instrument_HK", piece, pieces=DAY_PIECES)
    return spread_join(bars, named, "Instrument_HK", _piece(grain.link.link_key), pieces_from=links)


def _digest(name: str) -> str:
    """``short_digest`` in SQL."""
    return f"coalesce(unhex({name}), CAST({name} AS BINARY))"


def short_keys(vault: Vault, grain: Grain) -> tuple[Vault, bool]:
    """The vault's hash keys and hash-diffs as 16 bytes, where views move them, and whether they are.

    Only in a vault that says it is ``plain``: tables in buckets lie where the 32 digits belong. Versions are
    moved by their key before a view sees them, so their grain keeps its keys.
    """
    if not getattr(vault, "plain", False) or grain.sat.versioned:
        return vault, False
    return {
        name: table.withColumns({c: short_digest(c) for c in table.columns if c.endswith(("_HK", "_LK")) or c == "Hash_Diff"})
        for name, table in vault.items()
    }, True


def _bars(short: bool, grain: Grain, links: DataFrame, prices: DataFrame, times: DataFrame) -> DataFrame:
    """Links with prices and times. Links that are moved anyway get their short times first; those in buckets meet prices where they lie."""
    key, time_key = grain.link.link_key, grain.hub.hash_key
    if short:
        return links.join(times, time_key).drop(time_key).join(prices, key)
    return links.join(prices, key).join(times, time_key)


def instrument_view(vault: Vault, grain: Grain, current_only: bool = True) -> DataFrame:
    """Bars with symbol and company name, unsorted.

    ``current_only=False`` keeps every version of prices and company facts, which repeats
    bars once per pair of versions. Instruments without company facts are left out.

    Link and satellite meet on the link key (one shuffle each, none when both are bucketed
    by it). Instrument and company are joined with each other first, so the bars meet one
    dimension, and the bars of an instrument that dominates are spread over several tasks.
    """
    vault, short = short_keys(vault, grain)
    company = vault["sat_company_info"]
    if current_only:
        company = current(company)
    instruments = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    named = instruments.join(company.select("Instrument_HK", "longName"), "Instrument_HK")

    key, time_key = grain.link.link_key, grain.hub.hash_key
    links = vault[grain.link.table.name].select(key, "Instrument_HK", time_key)
    prices = _prices(vault, grain, current_only)
    prices = prices.select(key, "Open", "High", "Low", "Close", "Volume")
    times = vault[grain.hub.table.name].select(time_key, grain.time)
    bars = _bars(short, grain, links, prices, times)
    joined = _met(bars, named, grain, links)
    return joined.select(*_view_columns(grain))


def _view_columns(grain: Grain) -> list[str | Column]:
    return [
        grain.time,
        "Symbol",
        "longName",
        "Open",
        "Close",
        movement().alias("Movement"),
        "High",
        "Low",
        price_range().alias(grain.range_name),
        "Volume",
    ]


def instrument_view_at(vault: Vault, grain: Grain, moments: Sequence[datetime | str]) -> DataFrame:
    """The view as it stood at each of ``moments``, with the moment as ``As_Of``.

    A bar is there from its first load on, with the prices and the company facts that were valid then, and
    only if its instrument had company facts. A state of the insert-only satellite is valid until
    the bar's next one. An instrument's names at the moments are one row, so that its bars, which may be a large
    share of all, meet it piece by piece as in :func:`instrument_view`. A state of a bar is moved once, with its
    moments as an array, and becomes a row for each of them after all joins.
    """
    vault, short = short_keys(vault, grain)
    company = versions_at(vault["sat_company_info"], moments).select("Instrument_HK", AS_OF, "longName")
    names = company.groupBy(F.col("Instrument_HK").alias("_of")).agg(
        F.map_from_entries(F.collect_list(F.struct(AS_OF, "longName"))).alias("_names")
    )
    instruments = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    named = instruments.join(names, F.col("Instrument_HK") == F.col("_of")).drop("_of")

    key, time_key = grain.link.link_key, grain.hub.hash_key
    prices = vault[grain.sat.table.name]
    if not grain.sat.versioned:
        prices = intervals(prices.withColumn(START, F.col(LOADED)), [key])
    prices = with_moments(prices, moments, "_moments").select(key, "_moments", "Open", "High", "Low", "Close", "Volume")
    links = vault[grain.link.table.name].select(key, "Instrument_HK", time_key)
    times = vault[grain.hub.table.name].select(time_key, grain.time)
    bars = _bars(short, grain, links, prices, times)
    joined = _met(bars, named, grain, links)
    joined = joined.withColumn(AS_OF, F.explode("_moments"))
    joined = joined.filter(F.map_contains_key("_names", F.col(AS_OF))).withColumn("longName", F.element_at("_names", F.col(AS_OF)))
    return joined.select(AS_OF, *_view_columns(grain))


def view_name(grain: Grain) -> str:
    return "instrument_daily_view" if grain is DAY else "instrument_minute_view"


def view_sql(grain: Grain, schema: str, short: bool = False) -> str:
    """The current view over a schema's tables, for a catalog: bars with symbol and company name.

    ``short`` moves hash keys and hash-diffs as 16 bytes; tables in buckets, which lie where the 32 digits belong, do without.
    """
    link, sat, hub = (f"{schema}.{x.table.name}" for x in (grain.link, grain.sat, grain.hub))
    key, time_key = grain.link.link_key, grain.hub.hash_key

    def digest(name: str) -> str:
        return _digest(name) if short else name

    links = f"SELECT {digest(key)} AS bar, {digest('Instrument_HK')} AS instrument, {time_key} FROM {link}"
    columns = f"{digest(key)} AS bar, Open, High, Low, Close, Volume"
    prices = f"SELECT {columns} FROM {sat} WHERE End_DTS IS NULL"
    if not grain.sat.versioned:
        # The insert-only satellite has no open mark: its newest load is the current one.
        states = f"SELECT {columns}, Load_DTS, {digest('Hash_Diff')} AS state FROM {sat}"
        ranked = f"SELECT *, row_number() OVER (PARTITION BY bar ORDER BY Load_DTS DESC, state DESC) AS rank FROM ({states})"
        prices = f"SELECT * FROM ({ranked}) WHERE rank = 1"
    joins = [f"JOIN ({prices}) p ON p.bar = l.bar", f"JOIN {hub} t ON t.{time_key} = l.{time_key}"]
    met = " ".join(reversed(joins) if short else joins)  # as in ``_bars``
    return f"""
        SELECT t.{grain.time}, i.Symbol, c.longName, p.Open, p.Close,
               CASE WHEN p.Close > p.Open THEN 'up' ELSE 'down' END AS Movement,
               p.High, p.Low, p.High - p.Low AS {grain.range_name}, p.Volume
        FROM ({links}) l {met}
        JOIN {schema}.hub_instrument i ON {digest('i.Instrument_HK')} = l.instrument
        JOIN {schema}.sat_company_info c ON {digest('c.Instrument_HK')} = l.instrument AND c.End_DTS IS NULL"""


def create_views(spark: SparkSession, schema: str) -> None:
    """Create or replace both views in a schema that holds the vault's tables."""
    for grain in (DAY, MINUTE):
        stored = (x.table.name for x in (grain.link, grain.sat))
        laid_out = any(c.isBucket for x in stored for c in spark.catalog.listColumns(f"{schema}.{x}"))
        short = not laid_out and not grain.sat.versioned
        create_view(spark, f"{schema}.{view_name(grain)}", view_sql(grain, schema, short))


def instrument_daily_view(vault: Vault, current_only: bool = True) -> DataFrame:
    return instrument_view(vault, DAY, current_only)


def instrument_minute_view(vault: Vault, current_only: bool = True) -> DataFrame:
    return instrument_view(vault, MINUTE, current_only)


def intraday_volatility(vault: Vault, day: str) -> DataFrame:
    """Range of every current minute bar of one day.

    The day's few times are joined to the links first, so the large satellite is only
    matched for links of that day.
    """
    times = on_day(vault["hub_time"], "DateTime", day).select("Time_HK", "DateTime")
    links = vault["link_instrument_minute"].select(
        "Instrument_Minute_LK", "Instrument_HK", "Time_HK"
    )
    prices = current(vault["sat_instrument_minute_prices"]).select(
        "Instrument_Minute_LK", "Open", "Close", "High", "Low"
    )
    instruments = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    bars = links.join(times, "Time_HK").join(prices, "Instrument_Minute_LK")
    named = spread_join(bars, instruments, "Instrument_HK", _piece("Instrument_Minute_LK"))
    return named.select(
        "DateTime", "Symbol", "Open", "Close", price_range().alias("Intraday_Range")
    )


def company_minute_links(vault: Vault, without: str, current_only: bool = True) -> DataFrame:
    """Companies with the minute links of their instrument, minus a key pattern.

    ``current_only=False`` repeats each link for every version of the company.
    """
    links = vault["link_instrument_minute"].select(
        "Instrument_HK", "Instrument_Minute_LK", "Time_HK"
    )
    links = key_not_like(links, "Instrument_HK", without)
    company = vault["sat_company_info"]
    company = key_not_like(current(company) if current_only else company, "Instrument_HK", without)
    return spread_join(links, company, "Instrument_HK", _piece("Instrument_Minute_LK"))
