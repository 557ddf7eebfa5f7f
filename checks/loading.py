"""Queries over merges, vault loads, history, views and whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import frames as fr
from checks.frames import LOADS, PRICE_HASH, sql
from checks.registry import ORACLES, query
from pricevault import shared_dir
from pricevault.operators.history import scd2_apply, scd2_history
from pricevault.operators.keyed import absent_from, dedupe, duplicated_keys, unique_keys, upsert
from pricevault.operators.views import (
    company_minute_links,
    instrument_daily_view,
    instrument_minute_view,
    intraday_volatility,
    short_keys,
)
from pricevault.plans.jobs import (
    PERIOD,
    Batch,
    OpenVault,
    compact_bronze,
    open_vault,
    read_bronze,
    read_rejects,
    replay_vault,
    run_bronze_company,
    run_bronze_daily,
    run_bronze_minute,
    run_vault_company,
    run_vault_daily,
    run_vault_minute,
)
from pricevault.plans.vault import gathered_feed, load_hub, load_link, load_sat_insert_only
from pricevault.schemas import (
    COMPANY,
    DAY,
    HISTORICALS,
    HUB_CALENDAR,
    HUB_INSTRUMENT,
    HUB_TIME,
    LINK_INSTRUMENT_DAY,
    LINK_INSTRUMENT_MINUTE,
    MINUTE_HISTORICALS,
    SAT_COMPANY_INFO,
    SAT_DAY_PRICES,
    SAT_MINUTE_PRICES,
)
from pricevault.sources.tablelog import detail

PRICES = "Open, High, Low, Close, Volume, Dividends, Stock_Splits"
BARS = f"Date, Symbol, {PRICES}"
MINUTES = f"DateTime, Symbol, {PRICES}"
DAY_KEY = "md5(Symbol || '|' || strftime(Date, '%Y-%m-%d'))"
MINUTE_KEY = "md5(Symbol || '|' || strftime(DateTime, '%Y-%m-%d %H:%M:%S'))"
T1, T2 = f"TIMESTAMP '{LOADS[1]}'", f"TIMESTAMP '{LOADS[2]}'"
VERSION = (
    "Instrument_HK, longName, marketCap, Hash_Diff, Load_DTS, Effective_DTS, End_DTS, Record_Source"
)
MINUTE_VERSION = (
    f"Instrument_Minute_LK, {PRICES}, Hash_Diff, Load_DTS, Effective_DTS, End_DTS, Record_Source"
)


# Merges


@query(
    "mrg_upsert_company",
    sql(
        "SELECT * FROM company2 UNION ALL SELECT a.* FROM company1 a "
        "WHERE NOT EXISTS (SELECT 1 FROM company2 b WHERE b.symbol = a.symbol)",
        "company1",
        "company2",
    ),
)
def mrg_upsert_company(spark, d):
    return upsert(fr.company(spark, d, 1), fr.company(spark, d, 2), COMPANY.keys)


@query("mrg_upsert_historicals", sql(f"SELECT {BARS} FROM merged", "merged"))
def mrg_upsert_historicals(spark, d):
    bars = fr.hist(spark, d)
    return upsert(fr.early(bars), fr.late(fr.restated(bars)), HISTORICALS.keys)


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "mrg_dup_source_keys",
    f"""
    SELECT {', '.join(LINE)} FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def mrg_dup_source_keys(spark, d):
    lines = fr.table(spark, d, "lineitem").select(*LINE)
    return unique_keys(lines, LINE[:2], LINE[2:], on_duplicate="first")


@query(
    "mrg_dup_key_report",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
    "GROUP BY 1, 2 HAVING count(*) > 1",
)
def mrg_dup_key_report(spark, d):
    return duplicated_keys(fr.table(spark, d, "lineitem"), LINE[:2])


@query(
    "mrg_unique_source",
    sql("SELECT Symbol, Date, Close FROM hist", "hist"),
)
def mrg_unique_source(spark, d):
    bars = fr.hist(spark, d).select("Symbol", "Date", "Close")
    return unique_keys(bars, ["Symbol", "Date"], ["Close"])


@query(
    "join_left_anti_new_keys",
    sql(
        "SELECT symbol FROM raw3 WHERE symbol NOT IN (SELECT symbol FROM raw1)", "raw1", "raw3"
    ),
)
def join_left_anti_new_keys(spark, d):
    fresh = fr.company(spark, d, 3).select("symbol")
    return absent_from(fr.company(spark, d, 1), fresh, ["symbol"])


def _two_batches(spark, load, spec, first, second) -> DataFrame:
    """Target after two batches through a pure insert-only load."""
    target = load(fr.empty(spark, spec.table), first, spec)
    return target.unionByName(load(target, second, spec))


def _daily_batches(spark, d):
    bars = fr.hist(spark, d)
    return fr.stage_daily(fr.early(bars), 1), fr.stage_daily(fr.late(fr.restated(bars)), 2)


def _minute_batches(spark, d):
    bars = fr.minute(spark, d)
    return fr.stage_minute(fr.early(bars), 1), fr.stage_minute(fr.late(fr.restated(bars)), 2)


def _first_seen(key: str, early: str, late: str) -> str:
    return (
        f"SELECT {key}, min(Load_DTS) AS Load_DTS, 'historicals' AS Record_Source FROM "
        f"(SELECT *, {T1} AS Load_DTS FROM {early} UNION ALL SELECT *, {T2} AS Load_DTS FROM {late}) "
        f"GROUP BY {key}"
    )


DAILY_CTES, MINUTE_CTES = ("early", "late"), ("minute_early", "minute_late")


@query(
    "hub_instrument",
    sql(f"SELECT md5(Symbol) AS Instrument_HK, * FROM ({_first_seen('Symbol', *DAILY_CTES)})", *DAILY_CTES),
)
def hub_instrument(spark, d):
    return _two_batches(spark, load_hub, HUB_INSTRUMENT, *_daily_batches(spark, d))


@query(
    "hub_calendar",
    sql(
        "SELECT md5(strftime(Date, '%Y-%m-%d')) AS Calendar_HK, * "
        f"FROM ({_first_seen('Date', *DAILY_CTES)})",
        *DAILY_CTES,
    ),
)
def hub_calendar(spark, d):
    return _two_batches(spark, load_hub, HUB_CALENDAR, *_daily_batches(spark, d))


@query(
    "hub_time",
    sql(
        "SELECT md5(strftime(DateTime, '%Y-%m-%d %H:%M:%S')) AS Time_HK, * "
        f"FROM ({_first_seen('DateTime', *MINUTE_CTES)})",
        *MINUTE_CTES,
    ),
)
def hub_time(spark, d):
    return _two_batches(spark, load_hub, HUB_TIME, *_minute_batches(spark, d))


@query(
    "link_instrument_day",
    sql(
        f"SELECT {DAY_KEY} AS Instrument_Day_LK, md5(Symbol) AS Instrument_HK, "
        "md5(strftime(Date, '%Y-%m-%d')) AS Calendar_HK, Load_DTS, Record_Source "
        f"FROM ({_first_seen('Symbol, Date', *DAILY_CTES)})",
        *DAILY_CTES,
    ),
)
def link_instrument_day(spark, d):
    return _two_batches(spark, load_link, LINK_INSTRUMENT_DAY, *_daily_batches(spark, d))


@query(
    "link_instrument_minute",
    sql(
        f"SELECT {MINUTE_KEY} AS Instrument_Minute_LK, md5(Symbol) AS Instrument_HK, "
        "md5(strftime(DateTime, '%Y-%m-%d %H:%M:%S')) AS Time_HK, Load_DTS, Record_Source "
        f"FROM ({_first_seen('Symbol, DateTime', *MINUTE_CTES)})",
        *MINUTE_CTES,
    ),
)
def link_instrument_minute(spark, d):
    return _two_batches(spark, load_link, LINK_INSTRUMENT_MINUTE, *_minute_batches(spark, d))


@query(
    "sat_day_prices",
    sql(
        f"SELECT {DAY_KEY} AS Instrument_Day_LK, {PRICES}, Hash_Diff, min(Load_DTS) AS Load_DTS, "
        f"'historicals' AS Record_Source FROM (SELECT *, {PRICE_HASH} AS Hash_Diff, {T1} AS Load_DTS "
        f"FROM early UNION ALL SELECT *, {PRICE_HASH}, {T2} FROM late) GROUP BY ALL",
        *DAILY_CTES,
    ),
)
def sat_day_prices(spark, d):
    return _two_batches(spark, load_sat_insert_only, SAT_DAY_PRICES, *_daily_batches(spark, d))


# History


def _company_feed(spark, d) -> list[DataFrame]:
    return [fr.staged_company(spark, d, k).drop("Symbol") for k in LOADS]


def _minute_feed(spark, d) -> list[DataFrame]:
    bars = fr.minute(spark, d)
    kept = [c for c in SAT_MINUTE_PRICES.table.columns if c not in ("Effective_DTS", "End_DTS")]
    feed = [fr.restated(bars) if k == 2 else bars for k in LOADS]
    return [fr.stage_minute(b, k).select(*kept) for k, b in zip(LOADS, feed)]


def _fold(spark, spec, batches: list[DataFrame]) -> DataFrame:
    """Materialised history: each batch applied to what the batches before left."""
    keys = [spec.parent_key]
    history = fr.empty(spark, spec.table)
    for k, staged in zip(LOADS, batches):
        rows = dedupe(staged, keys, ["Hash_Diff"])
        history = scd2_apply(history, rows, keys, LOADS[k])
    return history


@query("mrg_scd2_company", sql(f"SELECT {VERSION} FROM versions", "versions"))
def mrg_scd2_company(spark, d):
    return _fold(spark, SAT_COMPANY_INFO, _company_feed(spark, d))


@query("mrg_scd2_minute", sql(f"SELECT {MINUTE_VERSION} FROM minute_versions", "minute_versions"))
def mrg_scd2_minute(spark, d):
    return _fold(spark, SAT_MINUTE_PRICES, _minute_feed(spark, d))


@query("win_scd2_history", sql(f"SELECT {VERSION} FROM versions", "versions"))
def win_scd2_history(spark, d):
    feed = reduce(DataFrame.unionByName, _company_feed(spark, d))
    return scd2_history(feed, ["Instrument_HK"]).select(*SAT_COMPANY_INFO.table.columns)


@query("win_scd2_minute", sql(f"SELECT {MINUTE_VERSION} FROM minute_versions", "minute_versions"))
def win_scd2_minute(spark, d):
    bars = fr.minute(spark, d)
    staged = [fr.stage_minute(fr.restated(bars) if k == 2 else bars, k) for k in LOADS]
    feed = gathered_feed(reduce(DataFrame.unionByName, staged), SAT_MINUTE_PRICES, LINK_INSTRUMENT_MINUTE.business_keys)
    return scd2_history(feed, ["Instrument_Minute_LK"]).select(*SAT_MINUTE_PRICES.table.columns)


@query(
    "win_scd2_daily",
    sql(
        f"SELECT {DAY_KEY} AS Instrument_Day_LK, {PRICES}, {PRICE_HASH} AS Hash_Diff, Load_DTS, "
        "Load_DTS AS Effective_DTS, lead(Load_DTS) OVER (PARTITION BY Symbol, Date ORDER BY Load_DTS) "
        "AS End_DTS, 'historicals' AS Record_Source FROM day_versions",
        "day_versions",
    ),
)
def win_scd2_daily(spark, d):
    bars = fr.hist(spark, d)
    staged = [fr.stage_daily(bars, 1), fr.stage_daily(fr.restated(bars), 2)]
    feed = gathered_feed(staged[0].unionByName(staged[1]), SAT_DAY_PRICES, LINK_INSTRUMENT_DAY.business_keys)
    return scd2_history(feed, ["Instrument_Day_LK"])


# Views over the stored vault

VIEW = (
    "h.{time}, h.Symbol, c.longName, h.Open, h.Close, "
    "CASE WHEN h.Close > h.Open THEN 'up' ELSE 'down' END AS Movement, h.High, h.Low, "
    "round(h.High - h.Low, 6) AS {range}, h.Volume"
)
DAY_VIEW = VIEW.format(time="Date", range="Intraday_Range")
MINUTE_VIEW = VIEW.format(time="DateTime", range="Intra_Minute_Range")


def first_load(spark, d) -> dict[str, DataFrame]:
    """Daily vault tables after a first load, as one lazy plan: nothing is written."""
    bars = fr.stage_daily(fr.derive_hist(spark, d), 1)
    facts = fr.staged_company(spark, d, 3)
    unhashed, made_of = bars.drop("Hash_Diff", LINK_INSTRUMENT_DAY.link_key), LINK_INSTRUMENT_DAY.business_keys
    loads = [
        (HUB_INSTRUMENT, bars, load_hub, {}),
        (HUB_CALENDAR, bars, load_hub, {}),
        (LINK_INSTRUMENT_DAY, unhashed, load_link, {}),
        (SAT_DAY_PRICES, unhashed, load_sat_insert_only, {"by_parent": True, "made_of": made_of}),
    ]
    vault = OpenVault(plain=True)
    for spec, rows, load, how in loads:
        vault[spec.table.name] = load(fr.empty(spark, spec.table), rows, spec, **how)
    company = fr.empty(spark, SAT_COMPANY_INFO.table)
    vault["sat_company_info"] = scd2_apply(company, facts, ["Instrument_HK"], LOADS[1])
    return vault


@query(
    "view_daily_first_load",
    sql(f"SELECT {DAY_VIEW} FROM hist h JOIN raw3 c ON c.symbol = h.Symbol", "hist", "raw3"),
)
def view_daily_first_load(spark, d):
    view = instrument_daily_view(first_load(spark, d))
    return view.withColumn("Intraday_Range", F.round("Intraday_Range", 6))


@query(
    "view_daily",
    sql(
        f"SELECT {DAY_VIEW} FROM hist2 h JOIN versions c ON c.symbol = h.Symbol "
        "WHERE c.End_DTS IS NULL",
        "hist2",
        "versions",
    ),
)
def view_daily(spark, d):
    view = instrument_daily_view(fr.stored_vault(spark, d))
    return view.withColumn("Intraday_Range", F.round("Intraday_Range", 6))


@query(
    "view_daily_all_versions",
    sql(
        f"SELECT {DAY_VIEW} FROM day_versions h JOIN versions c ON c.symbol = h.Symbol",
        "day_versions",
        "versions",
    ),
)
def view_daily_all_versions(spark, d):
    view = instrument_daily_view(fr.stored_vault(spark, d), current_only=False)
    return view.withColumn("Intraday_Range", F.round("Intraday_Range", 6))


@query(
    "view_daily_sorted",
    sql(
        f"SELECT {DAY_VIEW} FROM hist2 h JOIN versions c ON c.symbol = h.Symbol "
        "WHERE c.End_DTS IS NULL AND h.Date > DATE '1997-06-01' ORDER BY h.Date DESC, h.Symbol",
        "hist2",
        "versions",
    ),
)
def view_daily_sorted(spark, d):
    view = instrument_daily_view(fr.stored_vault(spark, d, days=("1997-06-01", "9999-12-31")))
    recent = view.filter(F.col("Date") > F.lit("1997-06-01").cast("date"))
    size = F.round("Intraday_Range", 6)
    return recent.withColumn("Intraday_Range", size).orderBy(F.desc("Date"), "Symbol")


@query(
    "view_minute",
    sql(
        f"SELECT {MINUTE_VIEW} FROM minute_versions h JOIN versions c ON c.symbol = h.Symbol "
        "WHERE c.End_DTS IS NULL AND h.End_DTS IS NULL",
        "minute_versions",
        "versions",
    ),
)
def view_minute(spark, d):
    view = instrument_minute_view(fr.stored_vault(spark, d))
    return view.withColumn("Intra_Minute_Range", F.round("Intra_Minute_Range", 6))


@query(
    "view_minute_all_versions",
    sql(
        f"SELECT {MINUTE_VIEW} FROM minute_versions h JOIN versions c ON c.symbol = h.Symbol",
        "minute_versions",
        "versions",
    ),
)
def view_minute_all_versions(spark, d):
    view = instrument_minute_view(fr.stored_vault(spark, d), current_only=False)
    return view.withColumn("Intra_Minute_Range", F.round("Intra_Minute_Range", 6))


@query(
    "join_intraday_volatility",
    sql(
        "SELECT DateTime, Symbol, Open, Close, round(High - Low, 6) AS Intraday_Range FROM minute "
        "WHERE CAST(DateTime AS DATE) = DATE '2024-01-10' ORDER BY DateTime, Symbol",
        "minute",
    ),
)
def join_intraday_volatility(spark, d):
    day = "2024-01-10"
    bars = intraday_volatility(fr.stored_vault(spark, d, days=(day, day)), day)
    size = F.round("Intraday_Range", 6)
    return bars.withColumn("Intraday_Range", size).orderBy("DateTime", "Symbol")


@query(
    "join_company_minute_link",
    sql(
        f"SELECT c.Instrument_HK, c.longName, c.marketCap, c.Effective_DTS, c.End_DTS, "
        f"md5(m.Symbol || '|' || strftime(m.DateTime, '%Y-%m-%d %H:%M:%S')) AS Instrument_Minute_LK, "
        "md5(strftime(m.DateTime, '%Y-%m-%d %H:%M:%S')) AS Time_HK "
        "FROM versions c JOIN minute m ON m.Symbol = c.symbol "
        "WHERE c.End_DTS IS NULL AND c.Instrument_HK NOT LIKE '19f%'",
        "versions",
        "minute",
    ),
)
def join_company_minute_link(spark, d):
    joined = company_minute_links(fr.stored_vault(spark, d), "19f%")
    return joined.drop("Hash_Diff", "Load_DTS", "Record_Source")


@query("join_company_minute_link_all", ORACLES["join_company_minute_link"].replace("c.End_DTS IS NULL AND ", ""))
def join_company_minute_link_all(spark, d):
    joined = company_minute_links(fr.stored_vault(spark, d), "19f%", current_only=False)
    return joined.drop("Hash_Diff", "Load_DTS", "Record_Source")


# Jobs


@query("job_bronze_company", sql(
    "SELECT * FROM company3", "company3"))
def job_bronze_company(spark, d):
    base = shared_dir(spark, "bronze-company")
    for k in LOADS:
        run_bronze_company(fr.raw_company(spark, d, k), Batch(base, k, LOADS[k]))
    return read_bronze(spark, base, COMPANY)


@query("job_bronze_daily", sql(f"SELECT {BARS} FROM merged", "merged"))
def job_bronze_daily(spark, d):
    base, bars = shared_dir(spark, "bronze-daily"), fr.hist(spark, d)
    run_bronze_daily(fr.raw_daily(fr.early(bars)), Batch(base, 1, LOADS[1]))
    run_bronze_daily(fr.raw_daily(fr.late(fr.restated(bars))), Batch(base, 2, LOADS[2]))
    return read_bronze(spark, base, HISTORICALS)


@query("job_bronze_minute", sql(f"SELECT {MINUTES} FROM minute_merged", "minute_merged"))
def job_bronze_minute(spark, d):
    base, bars = shared_dir(spark, "bronze-minute"), fr.minute(spark, d)
    run_bronze_minute(fr.raw_minute(fr.early(bars)), Batch(base, 1, LOADS[1]))
    run_bronze_minute(fr.raw_minute(fr.late(fr.restated(bars))), Batch(base, 2, LOADS[2]))
    return read_bronze(spark, base, MINUTE_HISTORICALS)


@query(
    "job_vault_daily",
    sql(
        f"SELECT Symbol, Date, {PRICES}, {T1} AS Load_DTS FROM early UNION ALL "
        f"SELECT Symbol, Date, {PRICES}, {T2} FROM (SELECT {BARS} FROM late EXCEPT "
        f"SELECT {BARS} FROM early)",
        *DAILY_CTES,
    ),
)
def job_vault_daily(spark, d):
    base, bars = shared_dir(spark, "vault-daily"), fr.hist(spark, d)
    run_vault_daily(fr.early(bars), Batch(base, 1, LOADS[1]))
    run_vault_daily(fr.late(fr.restated(bars)), Batch(base, 2, LOADS[2]))
    return fr.bars_by_key(open_vault(spark, base))


@query("job_vault_company", sql(f"SELECT symbol AS Symbol, {VERSION} FROM versions", "versions"))
def job_vault_company(spark, d):
    base = shared_dir(spark, "vault-company")
    for k in LOADS:
        run_vault_company(fr.company(spark, d, k), Batch(base, k, LOADS[k]))
    vault = open_vault(spark, base)
    hub = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    return vault["sat_company_info"].join(hub, "Instrument_HK")


@query(
    "job_vault_minute",
    sql(f"SELECT Symbol, DateTime, {MINUTE_VERSION} FROM minute_versions", "minute_versions"),
)
def job_vault_minute(spark, d):
    base, bars = shared_dir(spark, "vault-minute"), fr.minute(spark, d)
    for k in LOADS:
        run_vault_minute(fr.restated(bars) if k == 2 else bars, Batch(base, k, LOADS[k]))
    vault = open_vault(spark, base)
    links = vault["link_instrument_minute"].drop("Load_DTS", "Record_Source")
    hubs = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    times = vault["hub_time"].select("Time_HK", "DateTime")
    joined = vault["sat_instrument_minute_prices"].join(links, "Instrument_Minute_LK")
    joined = joined.join(hubs, "Instrument_HK").join(times, "Time_HK")
    return joined.select("Symbol", "DateTime", *SAT_MINUTE_PRICES.table.columns)


CORRECTED_SYMBOLS = "(SELECT Symbol FROM early UNION SELECT symbol FROM raw1)"


@query(
    "mrg_correct_earlier",
    sql(
        f"""
        SELECT 'hub' AS part, Symbol, CAST(NULL AS DATE) AS Date, CAST(NULL AS DOUBLE) AS Close, {T1} AS Load_DTS FROM {CORRECTED_SYMBOLS}
        UNION ALL SELECT 'hub', Symbol, NULL, NULL, {T2} FROM (SELECT Symbol FROM late UNION SELECT symbol FROM raw2)
          WHERE Symbol NOT IN {CORRECTED_SYMBOLS}
        UNION ALL SELECT 'link', Symbol, Date, NULL, {T1} FROM early
        UNION ALL SELECT 'link', Symbol, Date, NULL, {T2} FROM late WHERE (Symbol, Date) NOT IN (SELECT (Symbol, Date) FROM early)
        UNION ALL SELECT 'satellite', Symbol, Date, Close, {T1} FROM early
        UNION ALL SELECT 'satellite', Symbol, Date, Close, {T2} FROM (SELECT {BARS} FROM late EXCEPT SELECT {BARS} FROM early)
        UNION ALL SELECT 'view', Symbol, Date, Close, NULL FROM merged WHERE Symbol IN (SELECT symbol FROM raw1 UNION SELECT symbol FROM raw2)
        """,
        *DAILY_CTES,
        "merged",
        "raw1",
        "raw2",
    ),
)
def mrg_correct_earlier(spark, d):
    """Batch 1 was loaded with bars missing and wrong; it is corrected and what was merged on it runs again."""
    return corrected_vault(spark, d)


def corrected_vault(spark, d, **layout) -> DataFrame:
    base, bars = shared_dir(spark, "vault-correct"), fr.hist(spark, d)
    wrong = fr.early(bars).filter("Symbol NOT LIKE '%7'").withColumn("Close", F.col("Close") + 5)
    feeds = {
        ("historicals", 1): wrong,
        ("sat_company_info", 1): fr.company(spark, d, 1),
        ("historicals", 2): fr.late(fr.restated(bars)),
        ("sat_company_info", 2): fr.company(spark, d, 2),
    }
    runs = {"historicals": run_vault_daily, "sat_company_info": run_vault_company}
    for (load, k), rows in feeds.items():
        runs[load](rows, Batch(base, k, LOADS[k], **layout))
    feeds["historicals", 1] = fr.early(bars)
    replay_vault(spark, base, 1, lambda load, k: (feeds[load, k], Batch(base, k, LOADS[k], **layout)))

    vault = open_vault(spark, base)
    hubs = vault["hub_instrument"].select("Symbol", "Load_DTS")
    short, _ = short_keys(vault, DAY)
    links = fr.with_business_keys(short, short["link_instrument_day"])
    none, at = F.lit(None).cast("double").alias("Close"), F.lit(None).cast("timestamp_ntz").alias("Load_DTS")
    parts = (
        hubs.select(F.lit("hub").alias("part"), "Symbol", F.lit(None).cast("date").alias("Date"), none, "Load_DTS"),
        links.select(F.lit("link"), "Symbol", "Date", none, "Load_DTS"),
        fr.bars_by_key(vault).select(F.lit("satellite"), "Symbol", "Date", "Close", "Load_DTS"),
        instrument_daily_view(vault).select(F.lit("view"), "Symbol", "Date", "Close", at),
    )
    return reduce(DataFrame.union, parts)


COUNTED = (
    "hub_instrument",
    "hub_calendar",
    "link_instrument_day",
    "sat_instrument_day_prices",
)


@query("src_compacted", ORACLES["job_bronze_daily"])
def src_compacted(spark, d):
    """Batch 1 compacted, batch 2 on top of it."""
    base, bars = shared_dir(spark, "bronze-compacted"), fr.hist(spark, d)
    run_bronze_daily(fr.raw_daily(fr.early(bars)), Batch(base, 1, LOADS[1]))
    compact_bronze(spark, base, HISTORICALS, 1)
    run_bronze_daily(fr.raw_daily(fr.late(fr.restated(bars))), Batch(base, 2, LOADS[2]))
    return read_bronze(spark, base, HISTORICALS)


@query("src_compacted_rerun", ORACLES["job_bronze_daily"])
def src_compacted_rerun(spark, d):
    """Both batches compacted, then batch 1 corrected: the compaction no longer fits and is not read."""
    base, bars = shared_dir(spark, "bronze-compacted-rerun"), fr.hist(spark, d)
    wrong = fr.early(bars).filter("Symbol NOT LIKE '%7'").withColumn("Close", F.col("Close") + 5)
    run_bronze_daily(fr.raw_daily(wrong), Batch(base, 1, LOADS[1]))
    run_bronze_daily(fr.raw_daily(fr.late(fr.restated(bars))), Batch(base, 2, LOADS[2]))
    compact_bronze(spark, base, HISTORICALS, 2)
    run_bronze_daily(fr.raw_daily(fr.early(bars)), Batch(base, 1, LOADS[1]))
    compact_bronze(spark, base, HISTORICALS, 1)
    return read_bronze(spark, base, HISTORICALS)


@query(
    "src_detail",
    sql(
        "SELECT CAST(1 AS BIGINT) AS batch_id, count(*) AS n_rows, count(DISTINCT year(Date)) AS n_partitions FROM early UNION ALL "
        "SELECT 2, count(*), count(DISTINCT year(Date)) FROM late",
        "early",
        "late",
    ),
)
def src_detail(spark, d):
    """Rows and calendar periods of each batch of a bronze log, by its files."""
    base, bars = shared_dir(spark, "bronze-detail"), fr.hist(spark, d)
    run_bronze_daily(fr.raw_daily(fr.early(bars)), Batch(base, 1, LOADS[1]))
    run_bronze_daily(fr.raw_daily(fr.late(fr.restated(bars))), Batch(base, 2, LOADS[2]))
    return detail(spark, HISTORICALS.location(base), PERIOD).select("batch_id", "n_rows", "n_partitions")


@query(
    "job_bronze_minute_rejects",
    sql(
        f"SELECT CASE WHEN Volume % 2 <> 0 THEN DateTime END AS DateTime, CASE WHEN minute(DateTime) % 5 <> 0 THEN Symbol END AS Symbol, {PRICES}, "
        "concat_ws(',', CASE WHEN Volume % 2 = 0 THEN 'datetime_check' END, CASE WHEN minute(DateTime) % 5 = 0 THEN 'symbol_check' END) AS broken_rules "
        "FROM minute WHERE Volume % 2 = 0 OR minute(DateTime) % 5 = 0",
        "minute",
    ),
)
def job_bronze_minute_rejects(spark, d):
    """Minute bars whose time can't be parsed or that have no symbol, with the rules that they break."""
    base, raw = shared_dir(spark, "bronze-minute-rejects"), fr.raw_minute(fr.minute(spark, d))
    minute = F.substring("Datetime", 15, 2).cast("int")
    raw = raw.withColumn("Symbol", F.when(minute % 5 != 0, F.col("Symbol")))
    raw = raw.withColumn("Datetime", F.when(F.col("Volume") % 2 == 0, "no time").otherwise(F.col("Datetime")))
    run_bronze_minute(raw, Batch(base, 1, LOADS[1]))
    return read_rejects(spark, base, MINUTE_HISTORICALS, 1)


@query("job_bronze_rejects", ORACLES["dq_rejects"])
def job_bronze_rejects(spark, d):
    """What a bronze load turned away, each row with the rules that it breaks."""
    base = shared_dir(spark, "bronze-rejects")
    run_bronze_daily(fr.flawed(fr.raw_daily(fr.hist(spark, d))), Batch(base, 1, LOADS[1]))
    return read_rejects(spark, base, HISTORICALS, 1)


SECOND = "NOT LIKE '%7'"


@query(
    "mrg_rerun_replaces",
    sql(
        f"SELECT 'day' AS grain, Symbol, CAST(Date AS VARCHAR) AS at, Close FROM hist WHERE Symbol {SECOND} AND year(Date) <> 1996 "
        f"UNION ALL SELECT 'minute', Symbol, CAST(CAST(DateTime AS DATE) AS VARCHAR), Close FROM minute "
        f"WHERE Symbol {SECOND} AND CAST(DateTime AS DATE) <> DATE '2024-01-10' "
        f"UNION ALL SELECT 'company', symbol, NULL, CAST(marketCap AS DOUBLE) FROM raw3 WHERE symbol {SECOND}",
        "hist",
        "minute",
        "raw3",
    ),
)
def mrg_rerun_replaces(spark, d):
    """Batch 1 runs whole, then again with fewer rows and periods: only the second run is left."""
    base = shared_dir(spark, "vault-rerun")
    bars, minutes, facts = fr.hist(spark, d), fr.minute(spark, d), fr.raw_company(spark, d, 3)
    batch = Batch(base, 1, LOADS[1])
    for again in (False, True):
        if again:
            bars = bars.filter(f"Symbol {SECOND} AND year(Date) <> 1996")
            minutes = minutes.filter(f"Symbol {SECOND} AND CAST(DateTime AS DATE) <> DATE'2024-01-10'")
            facts = facts.filter(f"symbol {SECOND}")
        run_vault_daily(bars, batch)
        run_vault_minute(minutes, batch)
        run_vault_company(facts, batch)
    vault = open_vault(spark, base)
    hubs = vault["hub_instrument"].select("Instrument_HK", "Symbol")
    day = fr.bars_by_key(vault).select("Symbol", F.lit("day").alias("grain"), F.col("Date").cast("string").alias("at"), "Close")
    minute = vault["link_instrument_minute"].join(vault["sat_instrument_minute_prices"], "Instrument_Minute_LK")
    minute = minute.join(vault["hub_time"], "Time_HK").select(
        "Instrument_HK", F.lit("minute").alias("grain"), F.col("DateTime").cast("date").cast("string").alias("at"), "Close"
    )
    company = vault["sat_company_info"].select(
        "Instrument_HK", F.lit("company").alias("grain"), F.lit(None).cast("string").alias("at"), F.col("marketCap").cast("double").alias("Close")
    )
    named = minute.unionByName(company).join(hubs, "Instrument_HK").drop("Instrument_HK")
    return day.unionByName(named).select("grain", "Symbol", "at", "Close")


@query(
    "mrg_idempotent_counts",
    sql(
        "SELECT 'hub_instrument' AS table_name, count(DISTINCT Symbol) AS n_once, "
        "count(DISTINCT Symbol) AS n_twice FROM hist UNION ALL "
        "SELECT 'hub_calendar', count(DISTINCT Date), count(DISTINCT Date) FROM hist UNION ALL "
        "SELECT 'link_instrument_day', count(*), count(*) FROM hist UNION ALL "
        "SELECT 'sat_instrument_day_prices', count(*), count(*) FROM hist",
        "hist",
    ),
)
def mrg_idempotent_counts(spark, d):
    base, bars = shared_dir(spark, "vault-twice"), fr.hist(spark, d)
    run_vault_daily(bars, Batch(base, 1, LOADS[1]))
    run_vault_daily(bars, Batch(base, 2, LOADS[2]))
    states = {"n_once": open_vault(spark, base, upto=1), "n_twice": open_vault(spark, base)}
    counts = [
        vault[name].agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(state).alias("state"), "n"
        )
        for state, vault in states.items()
        for name in COUNTED
    ]
    rows = reduce(DataFrame.unionByName, counts)
    return rows.groupBy("table_name").pivot("state", list(states)).agg(F.sum("n"))
