"""Rows are moved and stored once: shuffles of merges and views, and the packing of what is written."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks import frames as fr
from pricevault import catalog as cat
from pricevault import shared_dir
from pricevault.operators.skew import spread_join
from pricevault.operators.views import _piece, instrument_daily_view, instrument_view_at
from pricevault.plans import jobs
from pricevault.plans.jobs import Batch, open_vault, read_bronze, run_bronze_daily, run_vault_daily, run_vault_minute
from pricevault.plans.vault import load_link, load_sat_insert_only, load_sat_versions
from pricevault.schemas import DAY, HISTORICALS, MINUTE

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def day(symbol, date, close):
    return (datetime.date.fromisoformat(date), symbol, close, close, close, close, 5, 0.0, 0.0)


def daily(spark, *rows):
    return spark.createDataFrame([day(*r) for r in rows], HISTORICALS.schema)


def test_states_become_rows_by_moment_after_all_joins(spark, sf_dir, no_broadcast):
    view = instrument_view_at(fr.stored_vault(spark, sf_dir), DAY, ["2024-01-15 00:00:00", "2024-02-15 00:00:00"])
    text = plan(view)
    assert text.index("Generate explode(_moments") < text.index("Join")
    assert text.count("Generate explode(_moments") == 1


def test_pieces_of_a_key_are_one_set(spark, no_broadcast):
    facts = spark.createDataFrame([("A", 1), ("A", None), ("B", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("A", 10), (None, 30)], "k string, v int")
    joined = spread_join(facts, dim, "k", F.col("n"))
    text = plan(joined)
    assert sorted(map(tuple, joined.collect()), key=str) == [("A", 1, 10), ("A", None, 10), (None, 3, 30)]
    # The sets once by key, the dimension by key, pairs and rows by key and piece.
    assert text.count("Exchange hashpartitioning") == 4


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_satellite_batch_is_moved_once_without_its_hash_diffs(spark, sf_dir, no_broadcast, buckets):
    for grain, rows, load in (
        (DAY, fr.stage_daily(fr.hist(spark, sf_dir), 1), load_sat_insert_only),
        (MINUTE, fr.stage_minute(fr.minute(spark, sf_dir), 1), load_sat_versions),
    ):
        more = {"by_parent": True} if load is load_sat_insert_only else {}
        none = spark.createDataFrame([], grain.sat.table.schema)
        loaded = load(none, rows.drop("Hash_Diff"), grain.sat, buckets=buckets, **more)
        text = plan(loaded)
        moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        batch = [line for line in moved if "REPARTITION_BY" in line]
        assert len(moved) == 2 and len(batch) == 1 and grain.link.link_key in batch[0]  # the batch and the target
        assert "Hash_Diff" not in text[text.index("REPARTITION_BY") :].split("FileScan")[0]
        whole = load(none, rows, grain.sat, **more)
        assert loaded.columns == whole.columns and loaded.exceptAll(whole).count() == 0 == whole.exceptAll(loaded).count()


@pytest.mark.parametrize("buckets", [None, 3])
def test_merged_rows_are_written_where_they_are(spark, monkeypatch, buckets):
    base, seen = shared_dir(spark, "where"), []
    for name in ("append_log", "write_bucketed"):
        write = getattr(jobs, name)

        def note(df, path, *args, _write=write, **more):
            if "Instrument_Day_LK" in df.columns:
                seen.append((more.get("gathered"), plan(df)))
            return _write(df, path, *args, **more)

        monkeypatch.setattr(jobs, name, note)
    first = daily(spark, ("A", "2023-01-02", 1.0), ("A", "2023-01-02", 1.0), ("B", "2024-01-02", 2.0))
    run_vault_daily(first, Batch(base, 1, T1, buckets=buckets))
    run_vault_daily(daily(spark, ("A", "2023-01-02", 1.0), ("B", "2024-01-02", 3.0)), Batch(base, 2, T2))
    assert len(seen) == 4 and all(gathered for gathered, _ in seen)
    sat = open_vault(spark, base)["sat_instrument_day_prices"]
    assert sorted((r.Close, str(r.Load_DTS)) for r in sat.collect()) == [(1.0, T1), (2.0, T1), (3.0, T2)]


def test_what_is_stored_is_packed(spark, tmp_path):
    base = str(tmp_path / "vault")
    bars = spark.createDataFrame([(datetime.datetime(2024, 1, 2, 10), *day("A", "2024-01-02", 1.0)[1:])], MINUTE.bronze.schema)
    run_vault_minute(bars, Batch(base, 1, T1, buckets=2, store_ends=True))
    run_vault_daily(daily(spark, ("A", "2024-01-02", 1.0)), Batch(base, 1, T1))
    cat.create_tables(spark, [HISTORICALS], str(tmp_path / "tables"), "packed_tables", buckets=2)
    daily(spark, ("A", "2024-01-02", 1.0)).write.insertInto("packed_tables.historicals")
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    tables = ("link_", "sat_", "hub_", "historicals")
    stored = [f for f in files if any(t in os.path.relpath(f, tmp_path) for t in tables)]
    assert len(stored) > 6 and not [f for f in stored if ".snappy." in f]


def test_a_bronze_batch_is_written_where_its_keys_were_checked(spark, monkeypatch):
    base, seen, write = shared_dir(spark, "bronze-where"), [], jobs.append_log
    monkeypatch.setattr(jobs, "append_log", lambda *args, **more: (seen.append(more.get("gathered")), write(*args, **more)))
    bars = daily(spark, ("A", "2023-01-02", 1.0), ("B", "2024-01-02", 2.0), ("B", "2024-01-03", -1.0))
    run_bronze_daily(fr.raw_daily(bars.withColumn("Symbol", F.lit("P1"))), Batch(base, 1, T1))
    assert seen == [True]
    assert sorted(r.Close for r in read_bronze(spark, base, HISTORICALS).collect()) == [1.0, 2.0]


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_bar_batch_moves_business_keys_and_a_plain_target_moves_short_ones(spark, sf_dir, no_broadcast, buckets):
    for grain, staged in ((DAY, fr.stage_daily(fr.hist(spark, sf_dir), 1)), (MINUTE, fr.stage_minute(fr.minute(spark, sf_dir), 1))):
        key, made_of = grain.link.link_key, grain.link.business_keys
        bare = staged.drop("Hash_Diff", key)
        link, sat = (spark.createDataFrame([], x.table.schema) for x in (grain.link, grain.sat))
        loads = [(load_link(link, bare, grain.link, buckets=buckets), load_link(link, staged, grain.link))]
        if grain is DAY:
            short = load_sat_insert_only(sat, bare, DAY.sat, by_parent=True, buckets=buckets, made_of=made_of)
            loads.append((short, load_sat_insert_only(sat, staged, DAY.sat)))
        else:
            loads.append((load_sat_versions(sat, bare, MINUTE.sat, buckets=buckets, made_of=made_of), load_sat_versions(sat, staged, MINUTE.sat)))
        for loaded, whole in loads:
            text = plan(loaded)
            assert text.count("Exchange hashpartitioning") == 2  # the batch and the target
            moved = text[text.index("REPARTITION_BY") :].split("FileScan")[0]
            assert "md5" not in moved.split("\n", 1)[1]  # hashed after the move
            if not buckets and "_key" in text:
                assert "unhex" in text[text.index("ENSURE_REQUIREMENTS") :]
            assert loaded.columns == whole.columns and loaded.exceptAll(whole).count() == 0 == whole.exceptAll(loaded).count()


@pytest.mark.parametrize("buckets", [None, 3])
def test_states_held_already_are_found_by_short_keys(spark, buckets):
    base = shared_dir(spark, "short")
    run_vault_daily(daily(spark, ("A", "2023-01-02", 1.0), ("B", "2024-01-02", 2.0)), Batch(base, 1, T1, buckets=buckets))
    again = daily(spark, ("A", "2023-01-02", 3.0), ("A", "2023-01-02", 3.0), ("B", "2024-01-02", 2.0), ("B", "2024-01-02", 4.0))
    run_vault_daily(again, Batch(base, 2, T2))
    run_vault_daily(daily(spark, ("A", "2023-01-02", 1.0), ("C", "2022-01-02", -0.0)), Batch(base, 3, "2024-03-01 00:00:00"))
    vault = open_vault(spark, base)
    states = sorted((r.Close, str(r.Load_DTS)) for r in vault["sat_instrument_day_prices"].collect())
    assert states == [(0.0, "2024-03-01 00:00:00"), (1.0, T1), (2.0, T1), (3.0, T2), (4.0, T2)]
    assert vault["link_instrument_day"].count() == 3 == vault["link_instrument_day"].select("Instrument_Day_LK").distinct().count()


def test_daily_views_of_a_plain_vault_move_short_keys(spark, sf_dir, no_broadcast):
    vault = fr.stored_vault(spark, sf_dir)
    view = instrument_daily_view(vault)
    assert "unhex(Instrument_Day_LK" in plan(view) and plan(view).count("Exchange hashpartitioning(Instrument_Day_LK") == 2
    as_stored = instrument_daily_view(dict(vault))  # does not say that it is plain
    assert "unhex" not in plan(as_stored)
    assert view.count() > 0 == view.exceptAll(as_stored).count() == as_stored.exceptAll(view).count()
    laid_out = open_vault(spark, fr.laid_out_vault_base(spark, sf_dir))
    assert "unhex" not in plan(instrument_daily_view(laid_out)) and "Exchange hashpartitioning(Instrument_Day_LK" not in plan(instrument_daily_view(laid_out))


def test_named_daily_view_moves_short_keys_unless_in_buckets(spark, sf_dir, no_broadcast):
    for name, short in (("cat_job_view_daily", True), ("cat_job_view_bucketed", False)):
        text = plan(QUERIES[name](spark, sf_dir))
        assert ("unhex(Instrument_Day_LK" in text) is short


def test_an_instrument_of_few_bars_is_sent_to_few_places(spark):
    links = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert links.select(_piece("k").alias("p")).distinct().count() == 16


def minute_bars(spark, *rows):
    at = datetime.datetime(2024, 1, 2, 10)
    return spark.createDataFrame([(at, *day(symbol, "2024-01-02", close)[1:]) for symbol, close in rows], MINUTE.bronze.schema)


def test_versions_of_a_plain_target_are_moved_by_short_keys(spark, no_broadcast):
    staged = fr.stage_minute(minute_bars(spark, ("A", 1.0)), 1).drop("Hash_Diff", MINUTE.link.link_key)
    none = spark.createDataFrame([], MINUTE.sat.table.schema)
    text = plan(load_sat_versions(none, staged, MINUTE.sat, made_of=MINUTE.link.business_keys))
    assert "Exchange hashpartitioning(_key" in text and "Exchange hashpartitioning(Instrument_Minute_LK" not in text


@pytest.mark.parametrize("buckets", [None, 3])
def test_versions_follow_changes_and_a_repeated_key_is_named(spark, buckets):
    base, t3 = shared_dir(spark, "versions"), "2024-03-01 00:00:00"
    run_vault_minute(minute_bars(spark, ("A", 1.0), ("B", 2.0), ("B", 2.0)), Batch(base, 1, T1, buckets=buckets))
    run_vault_minute(minute_bars(spark, ("A", 3.0), ("B", 2.0), ("C", -0.0)), Batch(base, 2, T2))
    run_vault_minute(minute_bars(spark, ("A", 1.0), ("C", 0.0)), Batch(base, 3, t3))
    rows = open_vault(spark, base)["sat_instrument_minute_prices"].collect()
    found = sorted((r.Close, str(r.Effective_DTS), str(r.End_DTS)) for r in rows)
    assert found == [(0.0, T2, "None"), (1.0, T1, T2), (1.0, t3, "None"), (2.0, T1, "None"), (3.0, T2, t3)]
    key = minute_bars(spark, ("A", 1.0)).select(F.md5(F.lit("A|2024-01-02 10:00:00"))).first()[0]
    with pytest.raises(Exception, match=f"duplicate merge key: {key}"):
        run_vault_minute(minute_bars(spark, ("A", 5.0), ("A", 6.0)), Batch(base, 4, "2024-04-01 00:00:00"))


def test_bars_by_key_get_business_keys_before_prices_move(spark, no_broadcast):
    base = shared_dir(spark, "by-key")
    run_vault_daily(daily(spark, ("A", "2023-01-02", 1.0), ("B", "2024-01-02", 2.0)), Batch(base, 1, T1))
    run_vault_daily(daily(spark, ("A", "2023-01-02", 3.0), ("B", "2024-01-02", 2.0)), Batch(base, 2, T2))
    vault = open_vault(spark, base)
    short, as_stored = fr.bars_by_key(vault), fr.bars_by_key(dict(vault))
    assert plan(short).count("unhex(Instrument_Day_LK") >= 2 and "unhex" not in plan(as_stored)
    for rows in (short, as_stored):
        found = sorted((r.Symbol, str(r.Date), r.Close, str(r.Load_DTS)) for r in rows.collect())
        assert found == [("A", "2023-01-02", 1.0, T1), ("A", "2023-01-02", 3.0, T2), ("B", "2024-01-02", 2.0, T1)]


def test_derived_bars_carry_the_price_of_a_day_once_for_each_end(spark, tmp_path):
    lines = [(7, 2, 1, 30.0), (7, 1, 1, 10.0), (9, 1, 1, 20.0), (1, 1, 2, 5.0)]
    rows = [(*line, "1995-01-02", 1, 0.0, 0.0) for line in lines]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_extendedprice double, l_shipdate string, l_quantity long, l_discount double, l_tax double"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    bars = fr.derive_hist(spark, str(tmp_path))
    assert "min_by" not in plan(bars) and "max_by" not in plan(bars)
    assert sorted((r.Symbol, r.Open, r.High, r.Low, r.Close, r.Volume) for r in bars.collect()) == [("P1", 10.0, 30.0, 10.0, 20.0, 3), ("P2", 5.0, 5.0, 5.0, 5.0, 1)]
