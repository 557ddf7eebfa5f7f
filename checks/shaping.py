"""Queries over projections, filters, quality rules and hash keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import frames as fr
from checks.frames import PRICE_HASH, sql
from checks.registry import query
from pricevault.functions import (
    canonical,
    hash_diff,
    hash_diff_json,
    hash_key,
    movement,
    parse_date,
    price_range,
)
from pricevault.operators import analytics as an
from pricevault.operators import wrangle as wr
from pricevault.operators.history import as_of, current, scd2_history
from pricevault.operators.quality import (
    assert_not_null,
    key_gate,
    not_null_rules,
    rule_counts,
    split_by_rules,
)
from pricevault.schemas import BAR_CHECKS, DAY, HUB_INSTRUMENT, MINUTE, PRICE_COLUMNS, VAULT_TABLES

BARS = "Date, Symbol, Open, High, Low, Close, Volume, Dividends, Stock_Splits"
MINUTES = BARS.replace("Date,", "DateTime,")
DAY_TEXT = "strftime(Date, '%Y-%m-%d')"
MINUTE_TEXT = "strftime(DateTime, '%Y-%m-%d %H:%M:%S')"
AUDIT = f"TIMESTAMP '{fr.LOADS[1]}' AS Load_DTS, 'historicals' AS Record_Source"


@query(
    "prj_rename",
    sql(
        "SELECT symbol, netIncomeToCommon AS netIncome, bookValue AS bookValuePerShare FROM raw3",
        "raw3",
    ),
)
def prj_rename(spark, d):
    named = wr.rename(fr.raw_company(spark, d, 3), wr.COMPANY_NAMES)
    return named.select("symbol", "netIncome", "bookValuePerShare")


@query("prj_parse_date", sql("SELECT Symbol, Date, Close FROM hist", "hist"))
def prj_parse_date(spark, d):
    raw = fr.raw_daily(fr.hist(spark, d))
    return raw.select("Symbol", parse_date("Date").alias("Date"), "Close")


@query("prj_parse_datetime", sql("SELECT Symbol, DateTime, Close FROM minute", "minute"))
def prj_parse_datetime(spark, d):
    raw = fr.raw_minute(fr.minute(spark, d))
    return wr.parse_time(raw, MINUTE).select("Symbol", "DateTime", "Close")


@query("prj_ensure_symbol", sql("SELECT Date, Close, 'ONE' AS Symbol FROM hist", "hist"))
def prj_ensure_symbol(spark, d):
    return wr.ensure_symbol(fr.hist(spark, d).select("Date", "Close"), "ONE")


@query("prj_bar_shape", sql(f"SELECT {BARS} FROM hist", "hist"))
def prj_bar_shape(spark, d):
    return wr.bar_shape(fr.hist(spark, d).withColumn("unused", F.lit(1)), DAY)


@query(
    "prj_pe_ratio",
    sql(
        "SELECT symbol, currentPrice, trailingEps, "
        "round(currentPrice / nullif(trailingEps, 0), 6) AS priceToEarnings FROM raw3",
        "raw3",
    ),
)
def prj_pe_ratio(spark, d):
    facts = wr.with_pe(fr.raw_company(spark, d, 3))
    pe = F.round("priceToEarnings", 6).alias("priceToEarnings")
    return facts.select("symbol", "currentPrice", "trailingEps", pe)


@query("prj_company_shape", sql("SELECT * FROM company3", "company3"))
def prj_company_shape(spark, d):
    return fr.company(spark, d, 3)


@query("prj_canonical_key", sql("SELECT Date, upper(trim(Symbol)) AS Symbol FROM flawed", "flawed"))
def prj_canonical_key(spark, d):
    return fr.flawed(fr.hist(spark, d)).select("Date", canonical("Symbol").alias("Symbol"))


@query(
    "prj_movement",
    sql(
        "SELECT Symbol, Date, CASE WHEN Close > Open THEN 'up' ELSE 'down' END AS Movement "
        "FROM flawed",
        "flawed",
    ),
)
def prj_movement(spark, d):
    bars = fr.flawed(fr.hist(spark, d))
    return bars.select("Symbol", "Date", movement().alias("Movement"))


@query(
    "prj_range",
    sql(
        "SELECT Symbol, DateTime, round(High - Low, 6) AS Intra_Minute_Range FROM minute", "minute"
    ),
)
def prj_range(spark, d):
    size = F.round(price_range(), 6).alias(MINUTE.range_name)
    return fr.minute(spark, d).select("Symbol", "DateTime", size)


@query(
    "stg_daily",
    sql(
        f"SELECT {BARS}, md5(Symbol) AS Instrument_HK, md5({DAY_TEXT}) AS Calendar_HK, "
        f"md5(Symbol || '|' || {DAY_TEXT}) AS Instrument_Day_LK, {PRICE_HASH} AS Hash_Diff, {AUDIT} "
        "FROM (SELECT * REPLACE (upper(trim(Symbol)) AS Symbol) FROM flawed) "
        "WHERE Date IS NOT NULL AND Symbol IS NOT NULL AND length(Symbol) > 0",
        "flawed",
    ),
)
def stg_daily(spark, d):
    return fr.stage_daily(fr.flawed(fr.hist(spark, d)), 1)


@query(
    "stg_minute",
    sql(
        f"SELECT {MINUTES}, md5(Symbol) AS Instrument_HK, md5({MINUTE_TEXT}) AS Time_HK, "
        f"md5(Symbol || '|' || {MINUTE_TEXT}) AS Instrument_Minute_LK, "
        f"{PRICE_HASH} AS Hash_Diff, {AUDIT} FROM minute",
        "minute",
    ),
)
def stg_minute(spark, d):
    return fr.stage_minute(fr.minute(spark, d), 1)


@query(
    "stg_company",
    sql(
        f"SELECT symbol AS Symbol, longName, marketCap, md5(symbol) AS Instrument_HK, "
        f"{fr.COMPANY_HASH} AS Hash_Diff, TIMESTAMP '{fr.LOADS[3]}' AS Load_DTS, 'historicals' AS Record_Source FROM raw3",
        "raw3",
    ),
)
def stg_company(spark, d):
    return fr.staged_company(spark, d, 3)


@query(
    "flt_key_gate",
    sql(f"SELECT {BARS} FROM flawed WHERE Symbol IS NOT NULL AND length(Symbol) > 0", "flawed"),
)
def flt_key_gate(spark, d):
    return key_gate(fr.flawed(fr.hist(spark, d)), ["Date", "Symbol"])


@query("flt_symbol", sql(f"SELECT {BARS} FROM hist WHERE Symbol = 'P7'", "hist"))
def flt_symbol(spark, d):
    return an.of_symbol(fr.hist(spark, d), "P7")


@query("flt_like", sql(f"SELECT {MINUTES} FROM minute WHERE Symbol LIKE 'P1%'", "minute"))
def flt_like(spark, d):
    return an.symbol_like(fr.minute(spark, d), "P1%")


@query(
    "flt_not_like",
    sql("SELECT Symbol, Date, md5(Symbol) AS Instrument_HK FROM hist "
        "WHERE md5(Symbol) NOT LIKE '19f%'", "hist"),
)
def flt_not_like(spark, d):
    keyed = fr.hist(spark, d).select("Symbol", "Date", hash_key("Symbol").alias("Instrument_HK"))
    return an.key_not_like(keyed, "Instrument_HK", "19f%")


@query("flt_date_after", sql(f"SELECT {BARS} FROM hist WHERE Date > DATE '1997-06-01'", "hist"))
def flt_date_after(spark, d):
    return an.after_day(fr.hist(spark, d), "Date", "1997-06-01")


@query(
    "flt_on_day",
    sql(
        f"SELECT {MINUTES} FROM minute WHERE CAST(DateTime AS DATE) = DATE '2024-01-10'", "minute"
    ),
)
def flt_on_day(spark, d):
    return an.on_day(fr.minute(spark, d), "DateTime", "2024-01-10")


@query(
    "flt_corporate_actions",
    sql(f"SELECT {MINUTES} FROM minute WHERE Dividends > 0 OR Stock_Splits > 0", "minute"),
)
def flt_corporate_actions(spark, d):
    return an.corporate_actions(fr.minute(spark, d))


VERSION = (
    "Instrument_HK, longName, marketCap, Hash_Diff, Load_DTS, Effective_DTS, End_DTS, Record_Source"
)


def _company_versions(spark, d):
    batches = [fr.staged_company(spark, d, k) for k in fr.LOADS]
    feed = batches[0].union(batches[1]).union(batches[2]).drop("Symbol")
    return scd2_history(feed, ["Instrument_HK"])


@query("flt_current", sql(f"SELECT {VERSION} FROM versions WHERE End_DTS IS NULL", "versions"))
def flt_current(spark, d):
    return current(_company_versions(spark, d))


@query(
    "flt_point_in_time",
    sql(
        f"SELECT {VERSION} FROM versions WHERE Effective_DTS <= TIMESTAMP '2024-02-15 00:00:00' "
        "AND (End_DTS IS NULL OR End_DTS > TIMESTAMP '2024-02-15 00:00:00')",
        "versions",
    ),
)
def flt_point_in_time(spark, d):
    return as_of(_company_versions(spark, d), "2024-02-15 00:00:00")


_CASES = {
    "date_check": "Date IS NULL",
    "symbol_check": "Symbol IS NULL",
    **{
        f"positive_{c.lower()}": f"NOT coalesce({c} > 0, FALSE)"
        for c in ("Open", "High", "Low", "Close", "Volume")
    },
}


@query(
    "dq_rejects",
    sql(
        f"SELECT * FROM (SELECT {BARS}, concat_ws(',', "
        + ", ".join(f"CASE WHEN {bad} THEN '{rule}' END" for rule, bad in _CASES.items())
        + ") AS broken_rules FROM flawed) WHERE broken_rules <> ''",
        "flawed",
    ),
)
def dq_rejects(spark, d):
    return split_by_rules(fr.flawed(fr.hist(spark, d)), BAR_CHECKS)[1]


@query(
    "dq_accepts",
    sql(
        f"SELECT {BARS} FROM flawed WHERE NOT ("
        + " OR ".join(f"({bad})" for bad in _CASES.values())
        + ")",
        "flawed",
    ),
)
def dq_accepts(spark, d):
    return split_by_rules(fr.flawed(fr.hist(spark, d)), BAR_CHECKS)[0]


@query(
    "dq_rule_counts",
    sql(
        " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, count(*) AS n_broken FROM flawed WHERE {bad}"
            for rule, bad in _CASES.items()
        ),
        "flawed",
    ),
)
def dq_rule_counts(spark, d):
    return rule_counts(fr.flawed(fr.hist(spark, d)), BAR_CHECKS)


def _gaps(time: str, unit: str, prefix: str) -> dict[str, str]:
    """Columns of a grain's vault rows in SQL, with gaps: no time, symbol, load time or source here and there."""
    at = f"CASE WHEN Volume % 11 <> 0 THEN {time} END"
    symbol = "CASE WHEN Volume % 29 <> 0 THEN Symbol END"
    load = f"CASE WHEN Volume % 13 <> 0 THEN CAST('{fr.LOADS[1]}' AS {{ntz}}) END"
    return {
        "Symbol": symbol,
        time: at,
        "Instrument_HK": f"md5({symbol})",
        f"{prefix}_HK": f"md5(CAST({at} AS {{text}}))",
        f"Instrument_{unit}_LK": f"md5({symbol} || '|' || CAST({at} AS {{text}}))",
        "Load_DTS": load,
        "Effective_DTS": load,
        "Record_Source": f"CASE WHEN Volume % 31 <> 0 THEN '{fr.SOURCE}' END",
    }


DAY_GAPS, MINUTE_GAPS = _gaps("Date", "Day", "Calendar"), _gaps("DateTime", "Minute", "Time")


def _of_minutes(spec) -> bool:
    return any(x in spec.columns for x in ("Time_HK", "Instrument_Minute_LK"))


@query(
    "dq_not_null",
    sql(
        " UNION ALL ".join(
            f"SELECT '{t.name}' AS table_name, '{c}_not_null' AS rule, count(*) AS n_broken FROM {'minute' if _of_minutes(t) else 'hist'} "
            f"WHERE ({(MINUTE_GAPS if _of_minutes(t) else DAY_GAPS)[c].format(ntz='TIMESTAMP', text='VARCHAR')}) IS NULL"
            for t in VAULT_TABLES
            for c in t.not_null
        ),
        "hist",
        "minute",
    ),
)
def dq_not_null(spark, d):
    """NULLs in the required columns of all vault tables, over rows with gaps in every one."""
    counts = []
    for spec in VAULT_TABLES:
        bars, gaps = (fr.minute(spark, d), MINUTE_GAPS) if _of_minutes(spec) else (fr.hist(spark, d), DAY_GAPS)
        rows = bars.selectExpr(*[f"{gaps[c].format(ntz='TIMESTAMP_NTZ', text='STRING')} AS {c}" for c in spec.not_null])
        counts.append(rule_counts(rows, not_null_rules(spec)).select(F.lit(spec.name).alias("table_name"), "rule", "n_broken"))
    return reduce(DataFrame.unionByName, counts)


@query(
    "dq_assert_not_null",
    sql(f"SELECT DISTINCT md5(Symbol) AS Instrument_HK, Symbol, {AUDIT} FROM hist", "hist"),
)
def dq_assert_not_null(spark, d):
    rows = fr.stage_daily(fr.hist(spark, d), 1).select(*HUB_INSTRUMENT.table.columns).distinct()
    return assert_not_null(rows, HUB_INSTRUMENT.table)


@query("key_hub", sql("SELECT Date, Symbol, md5(Symbol) AS Instrument_HK FROM hist", "hist"))
def key_hub(spark, d):
    return fr.hist(spark, d).select("Date", "Symbol", hash_key("Symbol").alias("Instrument_HK"))


@query("key_date", sql(f"SELECT Date, Symbol, md5({DAY_TEXT}) AS Calendar_HK FROM hist", "hist"))
def key_date(spark, d):
    return fr.hist(spark, d).select("Date", "Symbol", hash_key("Date").alias("Calendar_HK"))


@query(
    "key_time", sql(f"SELECT DateTime, Symbol, md5({MINUTE_TEXT}) AS Time_HK FROM minute", "minute")
)
def key_time(spark, d):
    return fr.minute(spark, d).select("DateTime", "Symbol", hash_key("DateTime").alias("Time_HK"))


@query(
    "key_link_day",
    sql(f"SELECT md5(Symbol || '|' || {DAY_TEXT}) AS Instrument_Day_LK, Close FROM hist", "hist"),
)
def key_link_day(spark, d):
    key = hash_key("Symbol", "Date").alias("Instrument_Day_LK")
    return fr.hist(spark, d).select(key, "Close")


@query(
    "key_link_minute",
    sql(
        f"SELECT md5(Symbol || '|' || {MINUTE_TEXT}) AS Instrument_Minute_LK, Close FROM minute",
        "minute",
    ),
)
def key_link_minute(spark, d):
    key = hash_key("Symbol", "DateTime").alias("Instrument_Minute_LK")
    return fr.minute(spark, d).select(key, "Close")


@query(
    "hashdiff_json",
    sql(
        "SELECT Symbol, Date, md5('{' || concat_ws(',', "
        + ", ".join(f"'\"{c}\":' || CAST({c} AS VARCHAR)" for c in PRICE_COLUMNS)
        + ") || '}') AS Hash_Diff FROM hist",
        "hist",
    ),
)
def hashdiff_json(spark, d):
    value = hash_diff_json(PRICE_COLUMNS).alias("Hash_Diff")
    return fr.hist(spark, d).select("Symbol", "Date", value)


@query("hashdiff_prices", sql(f"SELECT Symbol, Date, {PRICE_HASH} AS Hash_Diff FROM flawed", "flawed"))
def hashdiff_prices(spark, d):
    bars = fr.flawed(fr.hist(spark, d))
    return bars.select("Symbol", "Date", hash_diff(bars.schema, PRICE_COLUMNS).alias("Hash_Diff"))


@query("hashdiff_company", sql(f"SELECT symbol, {fr.COMPANY_HASH} AS Hash_Diff FROM raw3", "raw3"))
def hashdiff_company(spark, d):
    facts = fr.company(spark, d, 3)
    value = hash_diff(facts.schema, ["longName", "marketCap"])
    return facts.select("symbol", value.alias("Hash_Diff"))


@query(
    "fn_scalar_sampler",
    sql(
        """
        SELECT Symbol, Date, lower(upper(trim('  ' || Symbol || ' '))) AS tidy,
               length(Symbol) AS n_chars, Symbol || '/' || CAST(Volume AS VARCHAR) AS joined,
               concat_ws('|', Symbol, CAST(Date AS VARCHAR)) AS joined_ws, Symbol LIKE 'P1%' AS is_p1,
               md5(Symbol) AS hashed, CAST('1997-05-06' AS DATE) AS parsed_date,
               strftime(Date, '%Y-%m-%d') AS date_text, coalesce(nullif(Volume, 38), 0) AS no_38,
               Close IS NOT NULL AS has_close,
               CASE WHEN Close > Open THEN 'up' ELSE 'down' END AS movement,
               CAST(Volume AS DOUBLE) AS volume_double, CAST(CAST(Volume AS VARCHAR) AS BIGINT) AS volume_back,
               round((High + Low) / 2 - Open * 3, 6) AS mixed,
               round(Open / nullif(Stock_Splits, 0), 6) AS per_split
        FROM hist""",
        "hist",
    ),
)
def fn_scalar_sampler(spark, d):
    symbol, volume = F.col("Symbol"), F.col("Volume")
    return fr.hist(spark, d).select(
        "Symbol",
        "Date",
        F.lower(F.upper(F.trim(F.concat(F.lit("  "), symbol, F.lit(" "))))).alias("tidy"),
        F.length(symbol).cast("bigint").alias("n_chars"),
        F.concat(symbol, F.lit("/"), volume.cast("string")).alias("joined"),
        F.concat_ws("|", symbol, F.col("Date").cast("string")).alias("joined_ws"),
        symbol.like("P1%").alias("is_p1"),
        F.md5(symbol).alias("hashed"),
        F.to_date(F.lit("1997-05-06")).alias("parsed_date"),
        F.date_format("Date", "yyyy-MM-dd").alias("date_text"),
        F.coalesce(F.nullif(volume, F.lit(38)), F.lit(0)).alias("no_38"),
        F.col("Close").isNotNull().alias("has_close"),
        movement().alias("movement"),
        volume.cast("double").alias("volume_double"),
        volume.cast("string").cast("bigint").alias("volume_back"),
        F.round((F.col("High") + F.col("Low")) / 2 - F.col("Open") * 3, 6).alias("mixed"),
        F.round(F.try_divide(F.col("Open"), F.col("Stock_Splits")), 6).alias("per_split"),
    )
