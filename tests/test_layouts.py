"""Vaults in buckets and stored histories: plans, crashes, corrections, periods that stay."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from checks import frames as fr
from pricevault import shared_dir
from pricevault.operators.views import instrument_daily_view, instrument_minute_view
from pricevault.plans import histories
from pricevault.plans import jobs
from pricevault.plans.jobs import Batch, open_vault, replay_vault, run_vault_daily, run_vault_minute, store_ends, vault_buckets
from pricevault.plans.vault import load_link, load_sat_insert_only, load_sat_versions, version_columns
from pricevault.schemas import DAY, MINUTE, SAT_MINUTE_PRICES

T1, T2, T3 = "2024-05-01 00:00:00", "2024-05-02 00:00:00", "2024-05-03 00:00:00"
SAT = SAT_MINUTE_PRICES
BAR = "Symbol string, DateTime timestamp_ntz, Open double, High double, Low double, Close double, Volume bigint, Dividends double, Stock_Splits double"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def nodes_up_to_join(text: str) -> list[str]:
    """The plan's nodes from the bucketed scan up to the join that it takes part in."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    indent, found = len(lines[at]) - len(lines[at].lstrip(" :+-*")), [lines[at]]
    for line in reversed(lines[:at]):
        depth = len(line) - len(line.lstrip(" :+-*"))
        if depth < indent:
            if "Join" in line:
                return found
            indent = depth
            found.append(line)
    raise AssertionError("no join above the stored side")


def bars(spark, *rows):
    """Minute bars of (symbol, time, close)."""
    made = [(s, datetime.datetime.fromisoformat(t), c, c, c, c, 1, 0.0, 0.0) for s, t, c in rows]
    return spark.createDataFrame(made, BAR)


def versions(spark, base, upto=None) -> list[tuple]:
    rows = open_vault(spark, base, upto)[SAT.table.name].collect()
    return sorted((r.Instrument_Minute_LK, r.Close, str(r.Effective_DTS), str(r.End_DTS)) for r in rows)


def derived(spark, base, monkeypatch, upto=None) -> list[tuple]:
    with monkeypatch.context() as m:
        m.setattr(jobs, "live_versions", lambda *a: None)
        return versions(spark, base, upto)


def stored(spark, base, upto=None):
    runs = jobs._sat_runs(spark, base, SAT, upto)
    place = jobs._history_place(base, SAT, vault_buckets(spark, base))
    return histories.live_versions(spark, place, runs, upto)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("grain", "view"), [(DAY, instrument_daily_view), (MINUTE, instrument_minute_view)])
def test_views_move_no_stored_link_or_price_by_key(spark, sf_dir, no_broadcast, grain, view):
    text = plan(view(open_vault(spark, fr.laid_out_vault_base(spark, sf_dir))))
    assert f"Exchange hashpartitioning({grain.link.link_key}" not in text
    assert text.count("Bucketed: true") >= 2


def test_minute_view_has_no_window(spark, sf_dir):
    text = plan(instrument_minute_view(open_vault(spark, fr.laid_out_vault_base(spark, sf_dir))))
    assert "Window" not in text and "IsNull(End_DTS)" in text


def test_merges_move_the_batch_only(spark, sf_dir, no_broadcast):
    base, span = fr.laid_out_vault_base(spark, sf_dir), (datetime.date(1992, 1, 1), datetime.date(2030, 1, 1))

    def touched(spec, columns=None):
        return jobs._touched(spark, spec, Batch(base, 9, T3), span, columns, fr.BUCKETS)

    day, minute = fr.stage_daily(fr.hist(spark, sf_dir), 3), fr.stage_minute(fr.minute(spark, sf_dir), 3)
    merges = {
        "Instrument_Day_LK": [
            load_link(touched(DAY.link.table), day, DAY.link),
            load_sat_insert_only(touched(DAY.sat.table), day, DAY.sat, by_parent=True),
        ],
        "Instrument_Minute_LK": [
            load_link(touched(MINUTE.link.table), minute, MINUTE.link),
            load_sat_versions(touched(SAT.table, version_columns(SAT)), minute, SAT),
        ],
    }
    for key, loads in merges.items():
        for load in loads:
            above = nodes_up_to_join(plan(load))
            assert above and not any("Exchange" in node for node in above)
            text = plan(load)
            assert "Exchange hashpartitioning(" + key in text  # the batch is moved


@pytest.mark.parametrize("buckets", [None, 3])
def test_only_touched_periods_are_written_again(spark, monkeypatch, buckets):
    base = shared_dir(spark, "ends")
    batch = {"buckets": buckets, "store_ends": True}
    run_vault_minute(bars(spark, ("A", "2024-01-02T10:00", 1.0), ("B", "2024-03-02T10:00", 2.0)), Batch(base, 1, T1, **batch))
    before = stored(spark, base)[1]
    assert len(before) == 2 and len(set(before.values())) == 1
    run_vault_minute(bars(spark, ("B", "2024-03-02T10:00", 3.0), ("C", "2024-03-02T10:01", 4.0)), Batch(base, 2, T2, **batch))
    after = stored(spark, base)[1]
    same = {p for p in after if after[p] == before.get(p)}
    assert len(after) == 2 and len(same) == 1
    assert versions(spark, base) == derived(spark, base, monkeypatch)
    assert sorted(v[1:] for v in versions(spark, base)) == [
        (1.0, T1, "None"), (2.0, T1, T2), (3.0, T2, "None"), (4.0, T2, "None"),
    ]
    assert sorted(v[1:] for v in versions(spark, base, upto=1)) == [(1.0, T1, "None"), (2.0, T1, "None")]


def test_a_crash_before_the_manifest_changes_nothing(spark, monkeypatch):
    base = shared_dir(spark, "crash")
    run_vault_minute(bars(spark, ("A", "2024-01-02T10:00", 1.0)), Batch(base, 1, T1, buckets=3, store_ends=True))
    run_vault_minute(bars(spark, ("A", "2024-01-02T10:00", 2.0)), Batch(base, 2, T2))
    before = versions(spark, base)
    with monkeypatch.context() as m:
        def dies(*args, **kwargs):
            raise RuntimeError("lost the driver")
        m.setattr(histories, "append_log", dies)
        with pytest.raises(RuntimeError):
            store_ends(spark, base, 2, SAT)
    assert stored(spark, base)[0] == 1  # the folder is written, but nothing names it
    assert versions(spark, base) == before == derived(spark, base, monkeypatch)
    store_ends(spark, base, 2, SAT)
    assert stored(spark, base)[0] == 2 and versions(spark, base) == before
    live = stored(spark, base)[1]
    store_ends(spark, base, 2, SAT)  # nothing new: nothing is written
    assert stored(spark, base)[1] == live


def test_a_corrected_batch_drops_the_stored_history(spark, monkeypatch):
    base = shared_dir(spark, "ends-corrected")
    feeds = {1: bars(spark, ("A", "2024-01-02T10:00", 1.0)), 2: bars(spark, ("A", "2024-01-02T10:00", 2.0))}
    for k, at in ((1, T1), (2, T2)):
        run_vault_minute(feeds[k], Batch(base, k, at, buckets=3, store_ends=True))
    feeds[1] = bars(spark, ("A", "2024-01-02T10:00", 2.0), ("B", "2024-02-02T10:00", 5.0))
    replay_vault(spark, base, 1, lambda load, k: (feeds[k], Batch(base, k, (T1, T2)[k - 1])))
    assert stored(spark, base) is None  # the loads were run again without storing ends
    assert sorted(v[1:] for v in versions(spark, base)) == [(2.0, T1, "None"), (5.0, T1, "None")]
    store_ends(spark, base, 2, SAT)
    assert versions(spark, base) == derived(spark, base, monkeypatch)


def test_the_first_load_fixes_the_buckets(spark, sf_dir):
    base, day = shared_dir(spark, "layout"), fr.hist(spark, sf_dir).limit(20)
    run_vault_daily(day, Batch(base, 1, T1, buckets=3))
    assert vault_buckets(spark, base) == 3
    with pytest.raises(ValueError, match="3 buckets"):
        run_vault_daily(day, Batch(base, 2, T2, buckets=5))
    run_vault_daily(day.withColumn("Close", F.col("Close") + 1), Batch(base, 2, T2))
    sat = open_vault(spark, base)["sat_instrument_day_prices"]
    assert sat.count() == 40 and sat.select("Instrument_Day_LK").distinct().count() == 20
    run_vault_daily(day.limit(0), Batch(base, 3, T3))  # an empty batch
    assert open_vault(spark, base)["sat_instrument_day_prices"].count() == 40


def test_a_rerun_with_fewer_periods_leaves_no_old_partition(spark):
    base = shared_dir(spark, "rerun")
    run_vault_minute(bars(spark, ("A", "2024-01-02T10:00", 1.0), ("B", "2024-03-02T10:00", 2.0)), Batch(base, 1, T1, buckets=3))
    assert len(versions(spark, base)) == 2
    run_vault_minute(bars(spark, ("A", "2024-01-02T10:00", 1.0)), Batch(base, 1, T1))
    assert [v[1] for v in versions(spark, base)] == [1.0]
