"""Plans the operators must keep: pushdown, pruning, top-k, map-side limits, no Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks import frames as fr
from pricevault import catalog as cat
from pricevault import shared_dir
from pricevault.operators import analytics as an
from pricevault.operators.keyed import latest, upsert
from pricevault.operators.views import instrument_daily_view
from pricevault.plans.vault import load_hub, load_link
from pricevault.schemas import (
    HUB_INSTRUMENT,
    LINK_INSTRUMENT_DAY,
    SAT_DAY_PRICES,
    VAULT_TABLES,
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("+- == Initial Plan")[0]


@pytest.fixture(scope="module")
def bars(spark, sf_dir):
    return fr.hist(spark, sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("job_", "cat_", "snk_"))])
def test_no_cartesian_product_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(bars):
    text = plan(an.after_day(bars, "Date", "1997-01-01").select("Symbol", "Close"))
    assert "GreaterThanOrEqual(Date,1997-01-02)" in text
    assert "ReadSchema: struct<Date:date,Symbol:string,Close:double>" in text
    assert "EqualTo(Symbol,P7)" in plan(an.of_symbol(bars, "P7"))


def test_day_filter_on_times_reaches_the_scan(spark, sf_dir):
    text = plan(an.on_day(fr.minute(spark, sf_dir), "DateTime", "2024-01-10"))
    assert "GreaterThanOrEqual(DateTime,2024-01-10T00:00)" in text
    assert "LessThan(DateTime,2024-01-11T00:00)" in text


def test_reports_are_top_k(bars):
    assert "TakeOrderedAndProject(limit=10" in plan(an.top(bars, 10, F.desc("Volume"), F.col("Date")))


def test_latest_is_limited_before_the_shuffle(bars):
    text = plan(latest(bars, ["Symbol"], "Date"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_series_are_one_plan_of_two_scans(spark, bars):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no hint forces a broadcast
    try:
        text = plan(an.with_previous_close(bars))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("FileScan") == 2 and "approx_top_k" not in text and "BroadcastExchange" not in text
    # Rows are shuffled once by key and piece; so are edges, after a partial aggregate.
    assert text.count("Exchange hashpartitioning(_place") == 2
    assert text.count("partial_max_by") == 1


def test_statistics_never_gather_a_symbol(bars):
    text = plan(an.volume_zscore(bars))
    assert "Window" not in text and "approx_top_k" not in text


def test_small_upsert_source_leaves_the_target_in_place(spark, bars):
    source = bars.limit(10)
    text = final_plan(upsert(bars, source, ["Symbol", "Date"]))
    assert "SortMergeJoin" not in text


def test_hub_load_reads_one_column_and_aggregates_first(spark, bars):
    staged = fr.stage_daily(bars, 1)
    text = plan(load_hub(fr.empty(spark, HUB_INSTRUMENT.table), staged, HUB_INSTRUMENT))
    assert "ReadSchema: struct<Date:date,Symbol:string>" in text  # the date only for the gate
    by_hash = text.index("Exchange hashpartitioning(Instrument_HK")
    assert by_hash < text.index("Exchange hashpartitioning(Symbol") < text.index("partial_min")


def test_link_load_reads_two_columns_and_shuffles_once(spark, bars):
    staged = fr.stage_daily(bars, 1)
    spec = LINK_INSTRUMENT_DAY
    text = plan(load_link(fr.empty(spark, spec.table), staged, spec))
    assert "ReadSchema: struct<Date:date,Symbol:string>" in text
    assert text.count("Exchange hashpartitioning(Instrument_Day_LK") == 2  # batch and target


def test_bucketed_vault_needs_no_shuffle_of_stored_bars(spark, bars):
    base = shared_dir(spark, "bucketed")
    cat.create_tables(spark, VAULT_TABLES, base, "bucketed", buckets=4)
    staged = fr.stage_daily(bars, 1)
    stored = spark.table("bucketed.link_instrument_day")
    load_link(stored, staged, LINK_INSTRUMENT_DAY).write.insertInto("bucketed.link_instrument_day")
    text = plan(load_link(spark.table("bucketed.link_instrument_day"), staged, LINK_INSTRUMENT_DAY))
    assert text.count("Exchange hashpartitioning(Instrument_Day_LK") == 1  # the batch only
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vault = {s.name: spark.table(f"bucketed.{s.name}") for s in VAULT_TABLES}
        assert "Exchange hashpartitioning(Instrument_Day_LK" not in plan(instrument_daily_view(vault))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_satellite_merge_scans_only_the_touched_periods(spark, sf_dir):
    from pricevault.plans.jobs import PERIOD, Batch, _touched

    fr.stored_vault(spark, sf_dir)
    base = fr._written[(spark.sparkContext.applicationId, sf_dir, "vault")]
    import datetime

    day = datetime.date(1996, 1, 1)
    target = _touched(spark, SAT_DAY_PRICES.table, Batch(base, 3, fr.LOADS[3]), (day, day))
    assert {r[0] for r in target.select(PERIOD).distinct().collect()} == {day}
    assert "PartitionFilters: [isnotnull(_batch_id" in plan(target)


def test_a_day_of_the_vault_opens_one_period(spark, sf_dir):
    vault = fr.stored_vault(spark, sf_dir, days=("1996-03-04", "1996-03-05"))
    for name in ("link_instrument_day", "sat_instrument_day_prices"):
        text = plan(vault[name])
        assert "(_period" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
        assert vault[name].count() < fr.stored_vault(spark, sf_dir)[name].count() / 3
