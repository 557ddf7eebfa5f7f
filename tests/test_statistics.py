"""Statistics stored by batch, and views as of given moments."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from checks import frames as fr
from pricevault import shared_dir
from pricevault.operators import analytics as an
from pricevault.operators.history import versions_at
from pricevault.operators.views import instrument_daily_view, instrument_view_at
from pricevault.plans import statistics
from pricevault.plans.jobs import PERIOD, Batch, read_bronze, run_bronze_daily, run_bronze_minute
from pricevault.plans.statistics import run_bar_statistics, stored_extremes, stored_profile, volume_stats
from pricevault.schemas import DAY, HISTORICALS, MINUTE, MINUTE_HISTORICALS

T = "2024-01-01 00:00:00"


def bars(spark, *rows):
    raw = spark.createDataFrame(rows, "Date string, Symbol string, Volume bigint")
    for name in ("Open", "High", "Low", "Close", "Dividends", "Stock Splits"):
        raw = raw.withColumn(name, F.lit(1.0))
    return raw


def load(spark, base, k, *rows):
    run_bronze_daily(bars(spark, *rows), Batch(base, k, T))


def stats(spark, base, upto=None):
    return {r.Symbol: (r.n, r.avg_vol, r.std_vol) for r in volume_stats(spark, base, DAY, upto).collect()}


def folders(base, name):
    place = f"{HISTORICALS.location(base)}_statistics/{name}".removeprefix("file:")
    return [os.path.relpath(p, place) for p, _, files in os.walk(place) if any(f.endswith(".parquet") for f in files)]


def test_merged_periods_equal_the_whole(spark, sf_dir):
    base, all_bars = shared_dir(spark, "stats"), fr.hist(spark, sf_dir)
    for k, feed in enumerate([fr.early(all_bars), fr.late(all_bars), all_bars.filter("Date >= '1998-06-01'")], 1):
        run_bronze_daily(fr.raw_daily(feed), Batch(base, k, T))
        run_bar_statistics(spark, base, DAY, k)
    exact = all_bars.groupBy("Symbol").agg(F.count("*").alias("n"), F.avg("Volume").alias("avg_vol"), F.stddev_samp("Volume").alias("std_vol"))
    exact = {r.Symbol: tuple(r)[1:] for r in exact.collect()}
    found = stats(spark, base)
    assert found.keys() == exact.keys()
    for symbol, values in exact.items():
        assert found[symbol] == pytest.approx(values, rel=1e-9, abs=1e-9) if None not in values else found[symbol] == values
    row, whole = stored_profile(spark, base, DAY).first(), an.profile(all_bars).first()
    assert abs(row.n_symbols - whole.n_symbols) <= 0.02 * whole.n_symbols
    assert (row.first_date, row.last_date, row.n_rows) == (whole.first_date, whole.last_date, whole.n_rows)
    third = [f for f in folders(base, "moments") if f.startswith("_batch_id=3")]
    assert third and min(f.split(f"{PERIOD}=")[1] for f in third) == "1998-01-01"  # no earlier period is written again


def test_large_means_keep_their_deviation(spark):
    base = shared_dir(spark, "stats-far")
    big = 10**15
    load(spark, base, 1, *[(f"199{y}-01-0{d} 00:00:00Z", "A", big + d) for y in range(4) for d in range(1, 4)])
    run_bar_statistics(spark, base, DAY, 1)
    n, mean, deviation = stats(spark, base)["A"]
    assert (n, mean) == (12, big + 2) and deviation == pytest.approx((8 / 11) ** 0.5, rel=1e-9)


def test_single_bars_and_early_batches(spark):
    base = shared_dir(spark, "stats-small")
    load(spark, base, 1, ("1996-01-02 00:00:00Z", "A", 5), ("1997-01-02 00:00:00Z", "B", 7))
    run_bar_statistics(spark, base, DAY, 1)
    load(spark, base, 2, ("1996-01-02 00:00:00Z", "A", 9), ("1997-01-03 00:00:00Z", "A", 11))
    run_bar_statistics(spark, base, DAY, 2)
    assert stats(spark, base, 1) == {"A": (1, 5.0, None), "B": (1, 7.0, None)}
    assert stats(spark, base) == {"A": (2, 10.0, pytest.approx(2**0.5)), "B": (1, 7.0, None)}


def test_a_batch_without_accepted_bars(spark):
    base = shared_dir(spark, "stats-none")
    load(spark, base, 1, ("1996-01-02 00:00:00Z", "A", 5))
    run_bar_statistics(spark, base, DAY, 1)
    load(spark, base, 2, ("no date", "A", 5))
    run_bar_statistics(spark, base, DAY, 2)
    assert stats(spark, base) == {"A": (1, 5.0, None)}


def test_statistics_of_replaced_or_unfinished_runs_are_refused(spark, monkeypatch):
    base = shared_dir(spark, "stats-stale")
    load(spark, base, 1, ("1996-01-02 00:00:00Z", "A", 5), ("1997-01-02 00:00:00Z", "A", 6))
    with pytest.raises(ValueError, match=r"batches \[1\]"):
        volume_stats(spark, base, DAY)
    run_bar_statistics(spark, base, DAY, 1)
    load(spark, base, 2, ("1998-01-02 00:00:00Z", "A", 7))
    run_bar_statistics(spark, base, DAY, 2)
    load(spark, base, 1, ("1996-01-02 00:00:00Z", "A", 50))
    with pytest.raises(ValueError, match=r"batches \[1, 2\]"):
        volume_stats(spark, base, DAY)
    for k in (1, 2):
        run_bar_statistics(spark, base, DAY, k)
    assert stats(spark, base)["A"][:2] == (2, 28.5)

    write = statistics.append_log

    def dies(df, path, *args, **more):
        if path.endswith("profile"):
            raise OSError("lost")
        write(df, path, *args, **more)

    monkeypatch.setattr(statistics, "append_log", dies)
    with pytest.raises(OSError, match="lost"):
        run_bar_statistics(spark, base, DAY, 2)
    assert stats(spark, base)["A"][:2] == (2, 28.5)  # what the run left behind has no record


def test_minute_statistics_go_by_month(spark, sf_dir):
    base, all_bars = shared_dir(spark, "stats-minute"), fr.minute(spark, sf_dir)
    run_bronze_minute(fr.raw_minute(all_bars), Batch(base, 1, T))
    run_bar_statistics(spark, base, MINUTE, 1)
    exact = {r.Symbol: (r.n, r.m) for r in all_bars.groupBy("Symbol").agg(F.count("*").alias("n"), F.avg("Volume").alias("m")).collect()}
    assert {r.Symbol: (r.n, pytest.approx(r.avg_vol)) for r in volume_stats(spark, base, MINUTE).collect()} == exact
    assert read_bronze(spark, base, MINUTE_HISTORICALS).count() == stored_profile(spark, base, MINUTE).first().n_rows


def test_stored_statistics_open_no_bars(spark, sf_dir):
    base = shared_dir(spark, "stats-plan")
    run_bronze_daily(fr.raw_daily(fr.hist(spark, sf_dir)), Batch(base, 1, T))
    run_bar_statistics(spark, base, DAY, 1)
    for df in (volume_stats(spark, base, DAY), stored_extremes(spark, base, DAY), stored_profile(spark, base, DAY)):
        assert all("_statistics/" in f for f in df.inputFiles())


def test_the_view_as_of_the_last_load_is_the_current_one(spark, sf_dir):
    vault = fr.stored_vault(spark, sf_dir)
    latest = instrument_view_at(vault, DAY, ["2030-01-01 00:00:00"]).drop("As_Of")
    current = instrument_daily_view(vault)
    assert latest.exceptAll(current).count() == 0 and latest.count() == current.count()
    assert instrument_view_at(vault, DAY, ["2000-01-01 00:00:00"]).count() == 0


def test_versions_at_include_their_start_and_not_their_end(spark):
    rows = [("a", "2024-01-01 00:00:00", "2024-02-01 00:00:00"), ("b", "2024-02-01 00:00:00", None)]
    log = spark.createDataFrame(rows, "v string, s string, e string")
    log = log.select("v", F.col("s").cast("timestamp_ntz").alias("Effective_DTS"), F.col("e").cast("timestamp_ntz").alias("End_DTS"))
    at = ["2023-01-01 00:00:00", "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-02-01 00:00:00"]
    assert sorted((str(r.As_Of), r.v) for r in versions_at(log, at).collect()) == [("2024-01-01 00:00:00", "a"), ("2024-02-01 00:00:00", "b")]
    with pytest.raises(ValueError, match="no moments"):
        versions_at(log, [])
