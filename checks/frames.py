"""Input frames derived from the test tables, in Spark and in SQL.

The SQL side is a chain of CTEs, written apart from the Spark side on purpose.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault import shared_dir
from pricevault.operators.views import short_keys
from pricevault.operators.wrangle import to_bronze_company
from pricevault.plans.jobs import (
    Batch,
    open_vault,
    run_vault_company,
    run_vault_daily,
    run_vault_minute,
)
from pricevault.plans.staging import stage_bars, stage_company
from pricevault.schemas import DAY, MINUTE, PRICE_COLUMNS, TableSpec
from pricevault.session import shuffles_freed
from pricevault.sources.readers import read_source
from pricevault.sources.tablelog import PACKED

SOURCE = "historicals"
LOADS = {1: "2024-01-01 00:00:00", 2: "2024-02-01 00:00:00", 3: "2024-03-01 00:00:00"}

#: Buckets of the vault that is laid out by merge key: few, for small tables.
BUCKETS = 8

#: Two overlapping feeds that together hold every bar.
EARLY_BEFORE, LATE_FROM = "1997-01-01", "1996-01-01"
MINUTE_EARLY_BEFORE, MINUTE_LATE_FROM = "2024-01-20 00:00:00", "2024-01-10 00:00:00"


# Spark side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: dict[tuple[str, str, str], str] = {}


def written_once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder of a derived table, written once per application and test folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = shared_dir(spark, name)
        with shuffles_freed(spark):
            write(path)
        _written[key] = path
    return _written[key]


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars as a stored bronze table."""
    path = written_once(spark, sf_dir, "hist", lambda p: derive_hist(spark, sf_dir).write.options(**PACKED).parquet(p))
    return read_source(spark, path=path)


def minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars as a stored bronze table."""
    path = written_once(spark, sf_dir, "minute", lambda p: derive_minute(spark, sf_dir).write.options(**PACKED).parquet(p))
    return read_source(spark, path=path)


def derive_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: one per part and ship date, whose first and last line carry their price."""
    line = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.groupBy("l_partkey", F.col("l_shipdate").cast("date").alias("Date"))
        .agg(
            F.min(line)["l_extendedprice"].alias("Open"),
            F.max("l_extendedprice").alias("High"),
            F.min("l_extendedprice").alias("Low"),
            F.max(line)["l_extendedprice"].alias("Close"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("Volume"),
            F.max("l_discount").alias("Dividends"),
            F.max("l_tax").alias("Stock_Splits"),
        )
        .select("Date", F.concat(F.lit("P"), "l_partkey").alias("Symbol"), *PRICE_COLUMNS)
    )


def derive_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars: one per user and minute of events."""
    events = table(spark, sf_dir, "events")
    minute_text = F.concat(F.substring(F.col("ts").cast("string"), 1, 16), F.lit(":00"))
    return (
        events.groupBy(
            F.concat(F.lit("P"), "user_id").alias("Symbol"),
            minute_text.cast("timestamp_ntz").alias("DateTime"),
        )
        .agg(
            F.min_by("value", "ts").alias("Open"),
            F.max("value").alias("High"),
            F.min("value").alias("Low"),
            F.max_by("value", "ts").alias("Close"),
            F.count(F.lit(1)).alias("Volume"),
            F.max(F.when(F.col("event_type") == "signup", 1.0).otherwise(0.0)).alias("Dividends"),
            F.max(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)).alias("Stock_Splits"),
        )
        .select("DateTime", "Symbol", *PRICE_COLUMNS)
    )


def restated(bars: DataFrame) -> DataFrame:
    """The bars with some closes corrected."""
    wrong = F.col("Volume") % 3 == 0 if "Date" in bars.columns else F.minute("DateTime") % 2 == 0
    return bars.withColumn("Close", F.when(wrong, F.col("Close") + 1).otherwise(F.col("Close")))


def early(bars: DataFrame) -> DataFrame:
    if "Date" in bars.columns:
        return bars.filter(F.col("Date") < F.lit(EARLY_BEFORE).cast("date"))
    return bars.filter(F.col("DateTime") < F.lit(MINUTE_EARLY_BEFORE).cast("timestamp_ntz"))


def late(bars: DataFrame) -> DataFrame:
    if "Date" in bars.columns:
        return bars.filter(F.col("Date") >= F.lit(LATE_FROM).cast("date"))
    return bars.filter(F.col("DateTime") >= F.lit(MINUTE_LATE_FROM).cast("timestamp_ntz"))


def raw_company(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Company facts of batch ``k``: some caps change, some symbols come late or pause."""
    part = table(spark, sf_dir, "part")
    if k == 1:
        part = part.filter(F.col("p_partkey") % 7 != 0)
    if k == 2:
        part = part.filter(F.col("p_partkey") % 11 != 0)
    cap = F.col("p_size").cast("bigint") * 1_000_000
    if k >= 2:
        cap += F.when(F.col("p_partkey") % 10 == 0, 1).otherwise(0)
    if k >= 3:
        cap += F.when(F.col("p_partkey") % 15 == 0, 2).otherwise(0)
    eps = (F.col("p_size") - 25).cast("double")
    return part.select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.col("p_name").alias("longName"),
        cap.alias("marketCap"),
        F.col("p_retailprice").alias("currentPrice"),
        eps.alias("trailingEps"),
        (F.col("p_retailprice") / 10000).alias("dividendYield"),
        (cap * 2).alias("totalRevenue"),
        cap.alias("netIncomeToCommon"),
        F.col("p_retailprice").alias("bookValue"),
        F.lit(1.5).alias("priceToBook"),
        eps.alias("forwardEps"),
    )


def company(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return to_bronze_company(raw_company(spark, sf_dir, k))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("age"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "female").otherwise("male").alias("gender"),
        F.col("c_acctbal").alias("salary"),
    )


def _even(symbol: str = "Symbol"):
    return F.substring(symbol, 2, 18).cast("bigint") % 2 == 0


def raw_daily(bars: DataFrame) -> DataFrame:
    """Daily bars in the raw file's shape: local midnight with an offset, as text."""
    offset = F.when(_even(), "-05:00").otherwise("+09:00")
    text = F.concat(F.col("Date").cast("string"), F.lit(" 00:00:00"), offset)
    return bars.withColumn("Date", text).withColumnRenamed("Stock_Splits", "Stock Splits")


def raw_minute(bars: DataFrame) -> DataFrame:
    """Minute bars in the raw file's shape: local time with an offset, as text."""
    utc = F.col("DateTime")
    west = (utc - F.expr("INTERVAL 5 HOURS")).cast("string")
    east = (utc + F.expr("INTERVAL 9 HOURS")).cast("string")
    text = F.when(_even(), F.concat(west, F.lit("-05:00"))).otherwise(
        F.concat(east, F.lit("+09:00"))
    )
    names = [c for c in bars.columns if c != "DateTime"]
    raw = bars.select(text.alias("Datetime"), *names)
    return raw.withColumnRenamed("Stock_Splits", "Stock Splits")


def flawed(bars: DataFrame) -> DataFrame:
    """Daily bars with missing and non-positive values and untidy symbols."""
    volume = F.col("Volume")
    untidy = F.concat(F.lit("  "), F.lower("Symbol"), F.lit(" "))
    return (
        bars.withColumn("Close", F.when((volume % 17 != 0) & (volume != 38), F.col("Close")))
        .withColumn("Open", F.when(volume % 19 == 0, -1.0).otherwise(F.col("Open")))
        .withColumn(
            "Symbol",
            F.when(volume % 29 == 0, F.lit(None))
            .when(volume % 23 == 0, untidy)
            .otherwise(F.col("Symbol")),
        )
    )


def stage_daily(bars: DataFrame, k: int) -> DataFrame:
    return stage_bars(bars, DAY, LOADS[k], SOURCE)


def stage_minute(bars: DataFrame, k: int) -> DataFrame:
    return stage_bars(bars, MINUTE, LOADS[k], SOURCE)


def staged_company(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return stage_company(company(spark, sf_dir, k), LOADS[k], SOURCE)


def empty(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


_serial = itertools.count(1)


def new_schema() -> str:
    """A schema name not used in this process before."""
    return f"checks_{next(_serial)}"


def stored_vault(
    spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None
) -> dict[str, DataFrame]:
    """A loaded vault: bars, corrected bars and the minute bars back again, three company
    batches. It is written once per application and test folder, then only read."""
    return open_vault(spark, stored_vault_base(spark, sf_dir), days=days)


def stored_vault_base(spark: SparkSession, sf_dir: str) -> str:
    return written_once(spark, sf_dir, "vault", lambda p: _load(spark, sf_dir, p))


def laid_out_vault_base(spark: SparkSession, sf_dir: str) -> str:
    """The same loads into a vault in buckets, whose histories are stored with their ends."""
    return written_once(spark, sf_dir, "vault-laid-out", lambda p: _load(spark, sf_dir, p, buckets=BUCKETS, store_ends=True))


def _load(spark: SparkSession, sf_dir: str, base: str, **layout) -> None:
    days, minutes = hist(spark, sf_dir), minute(spark, sf_dir)
    for k in LOADS:
        batch = Batch(base, k, LOADS[k], SOURCE, **layout)
        if k < 3:
            run_vault_daily(restated(days) if k == 2 else days, batch)
        run_vault_minute(restated(minutes) if k == 2 else minutes, batch)
        run_vault_company(company(spark, sf_dir, k), batch)


def bars_by_key(vault: dict[str, DataFrame]) -> DataFrame:
    """Daily satellite rows with their business keys instead of hashes.

    Links that are moved anyway get their business keys first, so that prices move once; those in buckets meet prices where they lie.
    """
    vault, short = short_keys(vault, DAY)
    links, prices = vault["link_instrument_day"].drop("Load_DTS", "Record_Source"), vault["sat_instrument_day_prices"]
    bars = with_business_keys(vault, links).join(prices, "Instrument_Day_LK") if short else with_business_keys(vault, prices.join(links, "Instrument_Day_LK"))
    return bars.select("Symbol", "Date", *PRICE_COLUMNS, "Load_DTS")


def with_business_keys(vault: dict[str, DataFrame], days: DataFrame) -> DataFrame:
    """Rows of daily links with their symbol and date instead of the hubs' hash keys."""
    dates = vault["hub_calendar"].select("Calendar_HK", "Date")
    symbols = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    return days.join(dates, "Calendar_HK").drop("Calendar_HK").join(symbols, "Instrument_HK").drop("Instrument_HK")


# SQL side

_PRICES = "Open, High, Low, Close, Volume, Dividends, Stock_Splits"


def num(x: str) -> str:
    return rf"coalesce(CAST({x} + 0.0::DOUBLE AS VARCHAR), '\N')"


def txt(x: str) -> str:
    return rf"coalesce(replace(replace(CAST({x} AS VARCHAR), '\', '\\'), '|', '\|'), '\N')"


PRICE_HASH = (
    "md5(concat_ws('|', "
    + ", ".join(
        txt(c) if c == "Volume" else num(c) for c in PRICE_COLUMNS
    )
    + "))"
)
COMPANY_HASH = f"md5(concat_ws('|', {txt('longName')}, {txt('marketCap')}))"


def _company_sql(k: int) -> str:
    cap = "CAST(p_size AS BIGINT) * 1000000"
    if k >= 2:
        cap += " + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END"
    if k >= 3:
        cap += " + CASE WHEN p_partkey % 15 = 0 THEN 2 ELSE 0 END"
    absent = {1: "WHERE p_partkey % 7 <> 0", 2: "WHERE p_partkey % 11 <> 0", 3: ""}[k]
    return f"""
      SELECT 'P' || p_partkey AS symbol, p_name AS longName, CAST({cap} AS BIGINT) AS marketCap,
             p_retailprice AS currentPrice, CAST(p_size - 25 AS DOUBLE) AS trailingEps,
             p_retailprice / 10000 AS dividendYield, CAST(({cap}) * 2 AS BIGINT) AS totalRevenue,
             CAST({cap} AS BIGINT) AS netIncomeToCommon, p_retailprice AS bookValue,
             CAST(1.5 AS DOUBLE) AS priceToBook, CAST(p_size - 25 AS DOUBLE) AS forwardEps
      FROM part {absent}"""


def _restated_sql(source: str, time: str, wrong: str) -> str:
    return f"""
      SELECT {time}, Symbol, Open, High, Low,
             CASE WHEN {wrong} THEN Close + 1 ELSE Close END AS Close,
             Volume, Dividends, Stock_Splits FROM {source}"""


_OPEN = "arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice))"
_CLOSE = "arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice))"

#: CTE name -> (names it reads, text).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "hist": (
        (),
        f"""
      SELECT CAST(l_shipdate AS DATE) AS Date, 'P' || l_partkey AS Symbol, {_OPEN} AS Open,
             max(l_extendedprice) AS High, min(l_extendedprice) AS Low, {_CLOSE} AS Close,
             CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Volume,
             max(l_discount) AS Dividends, max(l_tax) AS Stock_Splits
      FROM lineitem GROUP BY 1, 2""",
    ),
    "minute": (
        (),
        """
      SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS DateTime, 'P' || user_id AS Symbol,
             arg_min(value, ts) AS Open, max(value) AS High, min(value) AS Low,
             arg_max(value, ts) AS Close, count(*) AS Volume,
             CAST(max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS DOUBLE) AS Dividends,
             CAST(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) AS Stock_Splits
      FROM events GROUP BY 1, 2""",
    ),
    "hist2": (("hist",), _restated_sql("hist", "Date", "Volume % 3 = 0")),
    "minute2": (
        ("minute",),
        _restated_sql("minute", "DateTime", "extract(minute FROM DateTime) % 2 = 0"),
    ),
    "early": (("hist",), f"SELECT * FROM hist WHERE Date < DATE '{EARLY_BEFORE}'"),
    "late": (("hist2",), f"SELECT * FROM hist2 WHERE Date >= DATE '{LATE_FROM}'"),
    "merged": (
        ("early", "late"),
        """
      SELECT * FROM late UNION ALL
      SELECT e.* FROM early e WHERE NOT EXISTS
        (SELECT 1 FROM late l WHERE l.Symbol = e.Symbol AND l.Date = e.Date)""",
    ),
    "minute_early": (
        ("minute",),
        f"SELECT * FROM minute WHERE DateTime < TIMESTAMP '{MINUTE_EARLY_BEFORE}'",
    ),
    "minute_late": (
        ("minute2",),
        f"SELECT * FROM minute2 WHERE DateTime >= TIMESTAMP '{MINUTE_LATE_FROM}'",
    ),
    "minute_merged": (
        ("minute_early", "minute_late"),
        """
      SELECT * FROM minute_late UNION ALL
      SELECT e.* FROM minute_early e WHERE NOT EXISTS
        (SELECT 1 FROM minute_late l WHERE l.Symbol = e.Symbol AND l.DateTime = e.DateTime)""",
    ),
    "raw1": ((), _company_sql(1)),
    "raw2": ((), _company_sql(2)),
    "raw3": ((), _company_sql(3)),
    **{
        f"company{k}": (
            (f"raw{k}",),
            f"""
      SELECT symbol, longName, marketCap, currentPrice / nullif(trailingEps, 0) AS priceToEarnings,
             dividendYield, totalRevenue, netIncomeToCommon AS netIncome,
             bookValue AS bookValuePerShare, priceToBook, forwardEps FROM raw{k}""",
        )
        for k in LOADS
    },
    "people": (
        (),
        """
      SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS age,
             CASE WHEN c_mktsegment = 'MACHINERY' THEN 'female' ELSE 'male' END AS gender,
             c_acctbal AS salary FROM customer""",
    ),
    "flawed": (
        ("hist",),
        """
      SELECT Date, CASE WHEN Volume % 29 = 0 THEN NULL
                        WHEN Volume % 23 = 0 THEN '  ' || lower(Symbol) || ' '
                        ELSE Symbol END AS Symbol,
             CASE WHEN Volume % 19 = 0 THEN -1.0 ELSE Open END AS Open, High, Low,
             CASE WHEN Volume % 17 <> 0 AND Volume <> 38 THEN Close END AS Close,
             Volume, Dividends, Stock_Splits FROM hist""",
    ),
    "feed": (
        ("raw1", "raw2", "raw3"),
        " UNION ALL ".join(
            f"SELECT symbol, longName, marketCap, {COMPANY_HASH} AS Hash_Diff, "
            f"TIMESTAMP '{LOADS[k]}' AS Load_DTS FROM raw{k}"
            for k in LOADS
        ),
    ),
    "versions": (
        ("feed",),
        """
      SELECT symbol, md5(symbol) AS Instrument_HK, longName, marketCap, Hash_Diff, Load_DTS,
             Load_DTS AS Effective_DTS,
             lead(Load_DTS) OVER (PARTITION BY symbol ORDER BY Load_DTS) AS End_DTS,
             'historicals' AS Record_Source
      FROM (SELECT *, lag(Hash_Diff) OVER (PARTITION BY symbol ORDER BY Load_DTS) AS before
            FROM feed) WHERE before IS NULL OR before <> Hash_Diff""",
    ),
    "minute_feed": (
        ("minute", "minute2"),
        " UNION ALL ".join(
            f"SELECT DateTime, Symbol, {_PRICES}, {PRICE_HASH} AS Hash_Diff, "
            f"TIMESTAMP '{LOADS[k]}' AS Load_DTS FROM {'minute2' if k == 2 else 'minute'}"
            for k in LOADS
        ),
    ),
    "minute_versions": (
        ("minute_feed",),
        f"""
      SELECT md5(Symbol || '|' || strftime(DateTime, '%Y-%m-%d %H:%M:%S')) AS Instrument_Minute_LK,
             DateTime, Symbol, {_PRICES}, Hash_Diff, Load_DTS, Load_DTS AS Effective_DTS,
             lead(Load_DTS) OVER (PARTITION BY Symbol, DateTime ORDER BY Load_DTS) AS End_DTS,
             'historicals' AS Record_Source
      FROM (SELECT *, lag(Hash_Diff) OVER (PARTITION BY Symbol, DateTime ORDER BY Load_DTS) AS before
            FROM minute_feed) WHERE before IS NULL OR before <> Hash_Diff""",
    ),
    "day_versions": (
        ("hist", "hist2"),
        f"""
      SELECT *, TIMESTAMP '{LOADS[1]}' AS Load_DTS FROM hist UNION ALL
      SELECT *, TIMESTAMP '{LOADS[2]}' AS Load_DTS FROM hist2 WHERE Volume % 3 = 0""",
    ),
}


def sql(body: str, *names: str) -> str:
    """``body`` with the CTEs it reads, dependencies first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = CTES[name]
        for need in needs:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body


