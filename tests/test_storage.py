"""Raw layouts, batch logs, the registry and the shared folder."""

from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import frames as fr
from pricevault import catalog as cat
from pricevault import shared_dir
from pricevault.plans.jobs import (
    Batch,
    PERIOD,
    compact_bronze,
    compacted_folder,
    open_vault,
    publish,
    read_batch,
    read_bronze,
    read_rejects,
    reject_counts,
    replay_vault,
    run_bronze_company,
    run_bronze_daily,
    run_bronze_minute,
    run_vault_company,
    run_vault_daily,
    run_vault_minute,
)
from pricevault.operators.views import instrument_daily_view
from pricevault.schemas import BRONZE_TABLES, COMPANY, DAY, HISTORICALS, MINUTE, VAULT_TABLES
from pricevault.sources.landing import land_once, landed_symbols, read_landed
from pricevault.sources.readers import RAW_FILE, RAW_LINE, read_bars_csv, read_company_json, read_source
from pricevault.sources.tablelog import append_log, detail, ensure_table, read_as_of, read_log

HEADER = "{},Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
FACTS = {
    "longName": "A Company", "marketCap": 10, "currentPrice": 6.0, "trailingEps": 2.0,
    "dividendYield": 0.1, "totalRevenue": 20, "netIncomeToCommon": 5, "bookValue": 3.0,
    "priceToBook": 2.0, "forwardEps": 2.5, "country": "not used",
}


@pytest.fixture
def raw(tmp_path):
    """Raw files in the one-folder-per-symbol layout."""
    for symbol, shift in (("AB.TO", 0), ("C D", 1)):
        daily = tmp_path / symbol / "historical"
        minute = tmp_path / symbol / "historical_minute"
        info = tmp_path / symbol / "info"
        for folder in (daily, minute, info):
            folder.mkdir(parents=True)
        rows = [f"2025-01-0{n + shift} 00:00:00-05:00,1.5,2.0,1.0,{n}.0,{n}00,0.0,0.0\n" for n in (2, 3)]
        (daily / "daily.csv").write_text(HEADER.format("Date") + "".join(rows))
        rows = [f"2025-01-02 09:3{n}:00-05:00,1.5,2.0,1.0,{n}.0,{n}00,0.0,0.0\n" for n in (2, 3)]
        (minute / "minute.csv").write_text(HEADER.format("Datetime") + "".join(rows))
        (info / "meta.json").write_text(json.dumps({"symbol": symbol, **FACTS}))
    return str(tmp_path)


def test_raw_folders_to_vault(spark, raw):
    daily = read_bars_csv(spark, raw, DAY)
    assert {r.Symbol for r in daily.collect()} == {"AB.TO", "C D"}
    assert read_bars_csv(spark, raw, MINUTE).count() == 4
    base = shared_dir(spark, "test")
    run_bronze_daily(daily, Batch(base, 1, "2025-02-01 00:00:00"))
    run_bronze_company(read_company_json(spark, raw), Batch(base, 1, "2025-02-01 00:00:00"))
    bars = read_bronze(spark, base, HISTORICALS)
    assert bars.schema == HISTORICALS.schema
    assert read_batch(spark, base, HISTORICALS, 1).exceptAll(bars).count() == 0
    assert read_batch(spark, base, HISTORICALS, 2).count() == 0
    assert {r.Date for r in bars.filter("Symbol = 'C D'").collect()} == {date(2025, 1, 3), date(2025, 1, 4)}
    company = read_bronze(spark, base, COMPANY)
    assert company.filter("priceToEarnings = 3.0 AND netIncome = 5").count() == 2
    run_vault_daily(bars, Batch(base, 1, "2025-02-01 00:00:00", "test", register_in="reg"))
    run_vault_company(company, Batch(base, 1, "2025-02-01 00:00:00", "test", register_in="reg"))
    vault = open_vault(spark, base)
    named = spark.table("reg.sat_company_info")
    assert named.columns == vault["sat_company_info"].columns
    assert sorted(map(str, named.collect())) == sorted(map(str, vault["sat_company_info"].collect()))
    for spec in VAULT_TABLES:
        assert vault[spec.name].columns == spec.columns
    assert instrument_daily_view(vault).count() == 4
    publish(vault)
    assert spark.sql("SELECT count(*) FROM sat_instrument_day_prices").first()[0] == 4
    assert spark.table("reg.sat_instrument_day_prices").count() == 4
    assert spark.table("reg.hub_instrument").count() == 2


def test_batches_can_be_run_again(spark, sf_dir):
    from checks import frames as fr

    base, bars = shared_dir(spark, "again"), fr.hist(spark, sf_dir)
    names = ("hub_instrument", "link_instrument_day", "sat_instrument_day_prices")
    run_vault_daily(fr.early(bars), Batch(base, 1, fr.LOADS[1]))
    run_vault_daily(fr.late(fr.restated(bars)), Batch(base, 2, fr.LOADS[2]))
    before = {n: sorted(map(str, open_vault(spark, base)[n].collect())) for n in names}
    run_vault_daily(fr.late(fr.restated(bars)), Batch(base, 2, fr.LOADS[2]))
    after = {n: sorted(map(str, open_vault(spark, base)[n].collect())) for n in names}
    assert before == after
    assert open_vault(spark, base, upto=1)["link_instrument_day"].count() == fr.early(bars).count()


def test_earlier_versions_stay_readable(spark):
    base = shared_dir(spark, "versions")
    schema = "k string, v int"
    for batch, rows in {1: [("a", 1), ("b", 1)], 2: [("a", 2)], 3: [("a", 3), ("c", 3)]}.items():
        append_log(spark.createDataFrame(rows, schema), base, batch)
    log = read_log(spark, base, spark.createDataFrame([], schema).schema)
    versions = {n: dict(map(tuple, read_as_of(log, ["k"], n).collect())) for n in (1, 2, 3)}
    assert versions == {
        1: {"a": 1, "b": 1},
        2: {"a": 2, "b": 1},
        3: {"a": 3, "b": 1, "c": 3},
    }


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_first_landing_wins(spark, fmt):
    base = shared_dir(spark, "land")
    schema = spark.createDataFrame([], "Symbol string, v int").schema
    first = spark.createDataFrame([("a/b", 1), ("c", 1)], schema)
    second = spark.createDataFrame([("c", 2), ("d", 2), ("d", 3)], schema)
    land_once(first, base, 1, fmt)
    for _ in range(2):  # the second batch is run twice
        land_once(second, base, 2, fmt)
    rows = read_landed(spark, base, schema, fmt).collect()
    assert sorted(map(tuple, rows)) == [("a/b", 1), ("c", 1), ("d", 2), ("d", 3)]
    assert landed_symbols(spark, base).count() == 3


def test_ensured_table_is_empty_and_typed(spark):
    base = shared_dir(spark, "empty")
    ensure_table(spark, base, HISTORICALS.schema)
    table = spark.read.parquet(base)
    assert table.count() == 0
    assert table.columns == HISTORICALS.columns


def test_definitions_create_all_tables_with_layout(spark):
    base = shared_dir(spark, "defs")
    cat.create_tables(spark, (*BRONZE_TABLES, *VAULT_TABLES), base, "defs", buckets=4)
    listed = {r.tableName for r in cat.list_tables(spark, "defs").collect() if not r.isTemporary}
    assert listed == {s.name for s in (*BRONZE_TABLES, *VAULT_TABLES)}
    for spec in (*BRONZE_TABLES, *VAULT_TABLES):
        made = spark.table(f"defs.{spec.name}").schema
        assert {(f.name, f.dataType) for f in made} == {(f.name, f.dataType) for f in spec.schema}
    described = {r.col_name: r.data_type for r in cat.describe_table(spark, "defs.hub_time").collect()}
    assert described["DateTime"] == "timestamp_ntz"
    assert cat.table_properties(spark, "defs.hub_time").columns == ["key", "value"]
    assert "spark_catalog" in {r.catalog for r in cat.list_catalogs(spark).collect()}
    assert "defs" in {r.namespace for r in cat.list_schemas(spark).collect()}


def test_source_needs_a_name_or_a_path(spark):
    with pytest.raises(ValueError):
        read_source(spark)


def test_scratch_is_below_the_shared_folder(spark):
    place = shared_dir(spark, "x")
    assert place.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert place != shared_dir(spark, "x")
    assert not os.path.exists(place)


def test_a_dead_batch_leaves_no_rows(spark):
    """A write that fails half-way does not change the log."""
    base = shared_dir(spark, "dead")
    good = spark.range(10).select(F.col("id").alias("v"))
    append_log(good, base, 1)
    bad = spark.range(100).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("v")
    )
    with pytest.raises(Exception, match="stop"):
        append_log(bad, base, 2)
    assert read_log(spark, base, good.schema).count() == 10


def test_a_batch_run_again_leaves_nothing_of_its_first_run(spark):
    base = shared_dir(spark, "again")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "k string, _period int")
    append_log(two, base, 1, ["_period"])
    append_log(two, base, 2, ["_period"])
    append_log(two.filter("_period = 2"), base, 1, ["_period"])
    rows = sorted(map(tuple, read_log(spark, base, two.schema).select("k", "_batch_id").collect()))
    assert rows == [("a", 2), ("b", 1), ("b", 2)]
    append_log(two.limit(0), base, 1, ["_period"])
    assert read_log(spark, base, two.schema, upto=1).count() == 0


def test_missing_tables_are_refused(spark):
    base = shared_dir(spark, "nothing-here")
    for read in (
        lambda: open_vault(spark, base),
        lambda: read_bronze(spark, base, HISTORICALS),
        lambda: read_landed(spark, base, HISTORICALS.schema),
    ):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read()


MINUTE_BARS = "Symbol string, DateTime timestamp_ntz, Open double, High double, Low double, Close double, Volume bigint, Dividends double, Stock_Splits double"


def minute_bars(spark, *closes, symbol="P1"):
    rows = [(symbol, datetime(2024, 1, 2, 9, 30), 1.0, 2.0, 0.5, float(c), 5, 0.0, 0.0) for c in closes]
    return spark.createDataFrame(rows, MINUTE_BARS)


def test_versions_load_in_order_and_without_double_keys(spark):
    base = shared_dir(spark, "order")
    run_vault_minute(minute_bars(spark, 1.0, 1.0), Batch(base, 1, "2024-02-01 00:00:00"))
    for batch, at in ((2, "2024-02-01 00:00:00"), (3, "2024-01-31 00:00:00")):
        with pytest.raises(Exception, match="not later than the newest version"):
            run_vault_minute(minute_bars(spark, 2.0), Batch(base, batch, at))
    with pytest.raises(Exception, match="duplicate merge key"):
        run_vault_minute(minute_bars(spark, 1.0).union(minute_bars(spark, 7.0, symbol="p1 ")), Batch(base, 4, "2024-03-01 00:00:00"))
    run_vault_minute(minute_bars(spark, 2.0 + 1e-9), Batch(base, 5, "2024-03-01 00:00:00"))
    run_vault_minute(minute_bars(spark, 2.0), Batch(base, 6, "2024-04-01 00:00:00"))
    sat = open_vault(spark, base)["sat_instrument_minute_prices"].orderBy("Effective_DTS")
    assert [(r.Close, r.End_DTS is None) for r in sat.collect()] == [(1.0, False), (2.0 + 1e-9, False), (2.0, True)]


def test_loads_of_one_batch_share_a_hub(spark):
    base = shared_dir(spark, "hub")
    batch = Batch(base, 1, "2024-02-01 00:00:00")
    for _ in range(2):
        run_vault_minute(minute_bars(spark, 1.0, symbol="A").union(minute_bars(spark, 1.0, symbol="B")), batch)
        facts = spark.createDataFrame([("B", "b", 1), ("C", "c", 2)], "symbol string, longName string, marketCap bigint")
        run_vault_company(facts, batch)
        assert sorted(r.Symbol for r in open_vault(spark, base)["hub_instrument"].collect()) == ["A", "B", "C"]


def test_bronze_reads_prune_periods_and_use_the_compacted_batch(spark, sf_dir):
    base, bars = shared_dir(spark, "compact"), fr.hist(spark, sf_dir)
    run_bronze_daily(fr.raw_daily(bars), Batch(base, 1, "2024-01-01 00:00:00"))
    whole = read_bronze(spark, base, HISTORICALS)
    compact_bronze(spark, base, HISTORICALS, 1)
    again = read_bronze(spark, base, HISTORICALS)
    assert again.exceptAll(whole).count() == 0 and again.count() == whole.count()
    month = read_bronze(spark, base, HISTORICALS, days=("1996-03-04", "1996-03-05"))
    text = month._jdf.queryExecution().executedPlan().toString()
    assert "(_period" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert 0 < month.count() < whole.count() / 3
    assert read_bronze(spark, base, HISTORICALS, upto=0).count() == 0


def test_broken_lines_are_kept_with_their_file(spark, raw, tmp_path):
    bad = tmp_path / "AB.TO" / "historical" / "daily.csv"
    bad.write_text(bad.read_text() + "2025-01-06 00:00:00-05:00,1.5,oops,1.0,2.0,7,0.0,0.0\nnot a bar\n")
    facts = tmp_path / "C D" / "info" / "meta.json"
    facts.write_text(facts.read_text() + '\n{"symbol": "C D", "marketCap": \n')
    base, batch = shared_dir(spark, "broken"), "2025-02-01 00:00:00"
    run_bronze_daily(read_bars_csv(spark, raw, DAY, keep_broken=True), Batch(base, 1, batch))
    run_bronze_company(read_company_json(spark, raw, keep_broken=True), Batch(base, 1, batch))
    assert read_bronze(spark, base, HISTORICALS).count() == 4
    assert sorted(r.symbol for r in read_bronze(spark, base, COMPANY).collect()) == ["AB.TO", "C D"]
    found = read_rejects(spark, base, HISTORICALS, 1, raw=True).collect()
    assert sorted(r[RAW_LINE] for r in found) == ["2025-01-06 00:00:00-05:00,1.5,oops,1.0,2.0,7,0.0,0.0", "not a bar"]
    assert all(r[RAW_FILE].endswith("AB.TO/historical/daily.csv") and r.broken_rules.startswith("readable") for r in found)
    found = read_rejects(spark, base, COMPANY, 1, raw=True).collect()
    assert [(r[RAW_LINE].startswith('{"symbol": "C D"'), r.broken_rules) for r in found] == [(True, "readable,symbol_check")]
    counts = {r.rule: r.n_broken for r in reject_counts(spark, base, HISTORICALS, 1).collect()}
    assert counts["readable"] == 2 and counts["date_check"] == 1


def test_minute_bars_without_a_time_are_rejected(spark):
    rows = [("x", "A"), ("y", "A"), ("2025-01-02 09:30:00Z", None), ("2025-01-02 09:30:00Z", "A")]
    bars = spark.createDataFrame(rows, "Datetime string, Symbol string")
    for name in ("Open", "High", "Low", "Close", "Volume", "Dividends", "Stock Splits"):
        bars = bars.withColumn(name, F.lit(1).cast("bigint" if name == "Volume" else "double"))
    base = shared_dir(spark, "minute-rejects")
    run_bronze_minute(bars, Batch(base, 1, "2025-02-01 00:00:00"))
    assert read_bronze(spark, base, MINUTE.bronze).count() == 1
    broken = sorted(r.broken_rules for r in read_rejects(spark, base, MINUTE.bronze, 1).collect())
    assert broken == ["datetime_check", "datetime_check", "symbol_check"]


def test_bronze_is_written_by_one_scan(spark, sf_dir, monkeypatch):
    from pricevault.plans import jobs

    plans = []
    monkeypatch.setattr(jobs, "append_log", lambda df, *args, **more: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    monkeypatch.setattr(jobs, "start_run", lambda *args, **more: None)
    run_bronze_daily(fr.raw_daily(fr.hist(spark, sf_dir)), Batch(shared_dir(spark, "plan"), 1, "2024-01-01 00:00:00"))
    assert len(plans) == 1 and plans[0].count("FileScan") == 1


def test_an_earlier_batch_is_corrected_only_by_replay(spark):
    base = shared_dir(spark, "correct")

    def bars(close, *symbols):
        rows = [(date(2024, 1, 2), s, close, close, close, close, 5, 0.0, 0.0) for s in symbols]
        return spark.createDataFrame(rows, HISTORICALS.schema)

    facts = spark.createDataFrame([(s, s, 1) for s in "AB"], "symbol string, longName string, marketCap bigint")
    first, second = Batch(base, 1, "2024-02-01 00:00:00"), Batch(base, 2, "2024-03-01 00:00:00")
    run_vault_daily(bars(1.0, "A"), first)
    run_vault_daily(bars(1.0, "A", "B"), second)
    run_vault_company(facts, second)
    with pytest.raises(ValueError, match="replay from batch 1"):
        run_vault_daily(bars(1.0, "A", "B"), first)
    feeds = {("historicals", 1): (bars(1.0, "A", "B"), first), ("historicals", 2): (bars(1.0, "A", "B"), second)}
    with pytest.raises(KeyError):  # stops half-way: the company load of batch 2 is not run again
        replay_vault(spark, base, 1, lambda load, k: feeds[load, k])
    with pytest.raises(ValueError, match="batch 2 sat_company_info"):
        open_vault(spark, base)
    assert open_vault(spark, base, upto=1)["hub_instrument"].count() == 2
    feeds["sat_company_info", 2] = (facts, second)
    replay_vault(spark, base, 1, lambda load, k: feeds[load, k])
    vault = open_vault(spark, base)
    counts = {n: vault[n].count() for n in ("hub_instrument", "link_instrument_day", "sat_instrument_day_prices")}
    assert counts == {"hub_instrument": 2, "link_instrument_day": 2, "sat_instrument_day_prices": 2}
    assert sorted(r.Symbol for r in instrument_daily_view(vault).collect()) == ["A", "B"]


def test_a_compaction_of_replaced_runs_is_not_read(spark):
    base = shared_dir(spark, "compact-stale")

    def load(k, *rows):
        bars = spark.createDataFrame([("2024-01-02 00:00:00Z", s, c) for s, c in rows], "Date string, Symbol string, Close double")
        for name in ("Open", "High", "Low", "Volume", "Dividends", "Stock Splits"):
            bars = bars.withColumn(name, F.lit(1).cast("bigint" if name == "Volume" else "double"))
        run_bronze_daily(bars, Batch(base, k, "2024-02-01 00:00:00"))

    def closes(upto=None):
        return sorted((r.Symbol, r.Close) for r in read_bronze(spark, base, HISTORICALS, upto).collect())

    load(1, ("A", 1.0))
    compact_bronze(spark, base, HISTORICALS, 1)
    load(2, ("C", 4.0))
    assert compacted_folder(spark, base, HISTORICALS, None)[0] == 1 and closes() == [("A", 1.0), ("C", 4.0)]
    load(1, ("A", 2.0), ("B", 3.0))
    assert compacted_folder(spark, base, HISTORICALS, None) is None
    assert closes() == [("A", 2.0), ("B", 3.0), ("C", 4.0)] and closes(1) == [("A", 2.0), ("B", 3.0)]
    compact_bronze(spark, base, HISTORICALS, 1)
    assert compacted_folder(spark, base, HISTORICALS, None)[0] == 1 and closes() == [("A", 2.0), ("B", 3.0), ("C", 4.0)]


def test_table_detail_counts_files_and_bytes(spark, tmp_path, sf_dir):
    base, bars = shared_dir(spark, "detail"), fr.hist(spark, sf_dir)
    run_bronze_daily(fr.raw_daily(bars), Batch(base, 1, "2024-01-01 00:00:00"))
    row = detail(spark, HISTORICALS.location(base), PERIOD).collect()[0]
    place = HISTORICALS.location(base).removeprefix("file:")
    files = [os.path.join(d, f) for d, _, names in os.walk(place) for f in names if f.endswith(".parquet")]
    assert (row.n_files, row.n_bytes, row.n_rows) == (len(files), sum(map(os.path.getsize, files)), bars.count())
