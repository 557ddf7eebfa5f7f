"""What large runs leave on disk: narrow moves of histories, merges and daily views."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks import frames as fr
from checks.loading import first_load
from pricevault import shared_dir
from pricevault.operators.history import scd2_history
from pricevault.operators.skew import spread_join
from pricevault.operators.views import DAY_PIECES, instrument_daily_view, instrument_view_at
from pricevault.plans import jobs
from pricevault.plans.jobs import Batch, open_vault, run_vault_company, run_vault_daily
from pricevault.plans.vault import gathered_feed, load_link, load_sat_insert_only
from pricevault.schemas import DAY, HISTORICALS

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def daily(spark, *rows):
    made = [(date and datetime.date.fromisoformat(date), symbol, close, close, close, close, 5, 0.0, None) for symbol, date, close in rows]
    return spark.createDataFrame(made, HISTORICALS.schema)


def test_a_history_moves_business_keys_once_and_hashes_afterwards(spark, sf_dir):
    for name in ("win_scd2_daily", "win_scd2_minute"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert text.count("Exchange ") == 1 and "REPARTITION_BY" in text
        assert "md5" not in text[text.index("REPARTITION_BY") :].split("\n", 1)[1]


def test_a_gathered_feed_gives_the_history_of_staged_rows(spark):
    first = daily(spark, ("A", "2023-01-02", 1.0), ("A", "2023-01-02", 1.0), ("B", "2024-01-02", None), (None, "2024-01-02", 2.0), ("C", None, 2.0))
    second = daily(spark, ("A", "2023-01-02", 3.0), ("B", "2024-01-02", None), ("C", "2024-01-02", -0.0))
    staged = fr.stage_daily(first, 1).unionByName(fr.stage_daily(second, 2))
    whole = scd2_history(staged.select(*DAY.sat.table.columns), ["Instrument_Day_LK"])
    moved = scd2_history(gathered_feed(staged, DAY.sat, DAY.link.business_keys), ["Instrument_Day_LK"])
    assert moved.schema == whole.schema
    assert whole.count() == 4 and whole.exceptAll(moved).count() == 0 == moved.exceptAll(whole).count()


@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_known_pieces_need_no_sets(spark, how):
    facts = spark.createDataFrame([("A", 1), ("A", 2), ("A", 2), ("B", 3), (None, 1), ("C", 0)], "k string, n int")
    dim = spark.createDataFrame([("A", 10), ("A", 11), (None, 30), ("D", 40)], "k string, v int")
    renamed = dim.withColumnRenamed("k", "d")
    plain = facts.join(renamed, F.col("k").eqNullSafe(F.col("d")), how).drop("d")
    joined = spread_join(facts, dim, "k", F.col("n"), how, pieces=range(4))
    assert joined.columns == plain.columns and "collect_set" not in plan(joined)
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))


def test_names_go_to_all_pieces_of_daily_bars(spark, sf_dir, no_broadcast):
    for vault in (fr.stored_vault(spark, sf_dir), open_vault(spark, fr.laid_out_vault_base(spark, sf_dir))):
        for view in (instrument_daily_view(vault), instrument_view_at(vault, DAY, ["2024-01-15 00:00:00"])):
            assert "collect_set" not in plan(view)


def test_a_view_keeps_bars_of_all_years_and_versions(spark):
    base = shared_dir(spark, "years")
    dates = [f"{year}-03-01" for year in (1899, 1969, 1970, 1995, 1996, 1997, 1998, 2024)]
    assert {int(d[:4]) % len(DAY_PIECES) for d in dates} == set(DAY_PIECES)
    facts = spark.createDataFrame([("A", "a", 1), ("B", "b", 1)], "symbol string, longName string, marketCap long")
    run_vault_daily(daily(spark, *[("A", d, 1.0) for d in dates]), Batch(base, 1, T1))
    run_vault_company(facts, Batch(base, 1, T1))
    run_vault_daily(daily(spark, ("A", dates[0], 2.0), ("B", dates[1], 3.0)), Batch(base, 2, T2))
    run_vault_company(facts.filter("symbol = 'A'").withColumn("marketCap", F.lit(2).cast("long")), Batch(base, 2, T2))
    vault = open_vault(spark, base)
    found = sorted((r.Symbol, str(r.Date), r.longName, r.Close) for r in instrument_daily_view(vault).collect())
    assert found == [("A", dates[0], "a", 2.0), *[("A", d, "a", 1.0) for d in dates[1:]], ("B", dates[1], "b", 3.0)]
    assert instrument_daily_view(vault, current_only=False).count() == 2 * 9 + 1


def test_a_first_load_is_read_where_its_merges_left_it(spark, sf_dir, no_broadcast):
    text = plan(QUERIES["view_daily_first_load"](spark, sf_dir))
    # Prices stay where their merge left them; links move once more, from where joins without broadcasts gave them their date.
    assert text.count("REPARTITION_BY") == 2 and text.count("Exchange hashpartitioning(Instrument_Day_LK") == 1
    assert "collect_set" not in text
    vault, bars = first_load(spark, sf_dir), fr.stage_daily(fr.derive_hist(spark, sf_dir), 1)
    for spec, load in ((DAY.link, load_link), (DAY.sat, load_sat_insert_only)):
        whole, loaded = load(fr.empty(spark, spec.table), bars, spec), vault[spec.table.name]
        assert loaded.schema == whole.schema and whole.count() > 0 == whole.exceptAll(loaded).count() == loaded.exceptAll(whole).count()


def test_a_plain_daily_merge_sends_one_digest_of_each_state(spark, monkeypatch, no_broadcast):
    base, seen, write = shared_dir(spark, "states"), [], jobs.append_log

    def note(df, path, *args, **more):
        if "Hash_Diff" in df.columns:
            seen.append(plan(df))
        return write(df, path, *args, **more)

    monkeypatch.setattr(jobs, "append_log", note)
    first = daily(spark, ("A", "2023-01-02", 1.0), ("A", "2023-01-02", 1.0), ("A", "2023-01-02", 5.0), ("B", "2024-01-02", None))
    run_vault_daily(first, Batch(base, 1, T1))
    run_vault_daily(daily(spark, ("A", "2023-01-02", 5.0), ("A", "2023-01-02", 3.0), ("B", "2024-01-02", None), ("B", "2024-01-03", None)), Batch(base, 2, T2))
    moved = [line for line in seen[-1].splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and "_held" not in seen[-1]  # the batch and the target, by one key
    assert "concat(Instrument_Day_LK" in seen[-1]
    states = [(str(r.Close), str(r.Load_DTS)) for r in open_vault(spark, base)["sat_instrument_day_prices"].collect()]
    assert sorted(states) == [("1.0", T1), ("3.0", T2), ("5.0", T1), ("None", T1), ("None", T2)]


def test_a_batch_without_keys_adds_the_states_of_one_with_them(spark):
    staged = fr.stage_daily(daily(spark, ("A", "2023-01-02", 1.0), ("A", "2023-01-02", 1.0), ("A", "2023-01-03", None), ("B", "2024-01-02", 2.0)), 2)
    held = load_sat_insert_only(fr.empty(spark, DAY.sat.table), fr.stage_daily(daily(spark, ("A", "2023-01-02", 1.0)), 1), DAY.sat)
    bare = staged.drop("Hash_Diff", "Instrument_Day_LK")
    whole = load_sat_insert_only(held, staged, DAY.sat)
    for rows in (bare, staged.drop("Instrument_Day_LK")):
        loaded = load_sat_insert_only(held, rows, DAY.sat, made_of=DAY.link.business_keys)
        assert loaded.schema == whole.schema and sorted(map(str, loaded.collect())) == sorted(map(str, whole.collect()))
    assert whole.count() == 2
