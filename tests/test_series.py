"""Neighbour values of cut series must equal plain windows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricevault.operators.analytics import with_volume_stats
from pricevault.operators.history import intervals, scd2_history
from pricevault.operators.series import with_neighbour
from pricevault.operators.skew import hash_piece, spread_join


@pytest.fixture(scope="module")
def bars(spark):
    """A third of the rows belong to one symbol; dates and symbols may be missing."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        symbol = "HOT" if i % 3 == 0 else rng.choice(["A", "B", "C", None, *[f"S{n}" for n in range(200)]])
        day = None if rng.random() < 0.01 else date(2020, 1, 1) + timedelta(days=rng.randrange(900))
        value = None if rng.random() < 0.05 else float(rng.randrange(1000))
        rows.append((symbol, day, i, value))
    return spark.createDataFrame(rows, "Symbol string, Date date, n int, Close double").cache()


@pytest.mark.parametrize("ahead", [False, True])
def test_equals_plain_window(bars, ahead):
    window = Window.partitionBy("Symbol").orderBy("Date", "n")
    plain = bars.withColumn("p", (F.lead if ahead else F.lag)("Close").over(window))
    cut = with_neighbour(bars, "Close", "p", ["Symbol"], "Date", ["n"], ahead)
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).count() == 0
    assert plain.exceptAll(cut).count() == 0


@pytest.mark.parametrize("ahead", [False, True])
def test_equals_plain_window_without_ties(bars, ahead):
    once = bars.groupBy("Symbol", "Date").agg(F.max_by("Close", "n").alias("Close"), F.max("n").alias("n"))
    window = Window.partitionBy("Symbol").orderBy("Date")
    plain = once.withColumn("p", (F.lead if ahead else F.lag)("Close").over(window))
    cut = with_neighbour(once, "Close", "p", ["Symbol"], "Date", ahead=ahead)
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0
    aggregates = [x for x in cut._jdf.queryExecution().executedPlan().toString().split("\n") if "max_by" in x or "min_by" in x]
    assert aggregates and all(" HashAggregate" in x for x in aggregates)


@pytest.fixture(scope="module")
def feed(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    rows = set()
    for i in range(3000):
        key = "HOT" if i % 3 == 0 else f"K{rng.randrange(300)}"
        rows.add((key, start + timedelta(hours=rng.randrange(2000))))
    rows = [(k, t, rng.choice("ABC")) for k, t in sorted(rows)]
    return spark.createDataFrame(rows, "k string, Load_DTS timestamp_ntz, Hash_Diff string").cache()


def test_history_equals_brute_force(feed):
    expected, last = [], {}
    for k, t, h in sorted(tuple(r) for r in feed.collect()):
        if k in last and expected[last[k]][2] == h:
            continue
        if k in last:
            expected[last[k]][3] = t
        last[k] = len(expected)
        expected.append([k, t, h, None])
    got = scd2_history(feed, ["k"])
    rows = [[r.k, r.Effective_DTS, r.Hash_Diff, r.End_DTS] for r in got.collect()]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    log = got.drop("End_DTS")
    again = intervals(log, ["k"])
    assert again.select(got.columns).exceptAll(got).count() == 0


@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_spread_join_equals_plain_join(spark, bars, how):
    dim = spark.createDataFrame(
        [("HOT", 1), ("HOT", 2), ("A", 3), (None, 4), ("unused", 5)], "Symbol string, v int"
    )
    renamed = dim.withColumnRenamed("Symbol", "s")
    plain = bars.join(renamed, F.col("Symbol").eqNullSafe(F.col("s")), how).drop("s")
    spread = spread_join(bars, dim, "Symbol", hash_piece("n", pieces=7), how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).count() == 0
    assert plain.exceptAll(spread).count() == 0


def test_volume_stats_equal_a_window(bars):
    frame = bars.withColumn("Volume", F.col("n").cast("long"))
    window = Window.partitionBy("Symbol")
    plain = frame.select("Symbol", "Date", "Volume", F.avg("Volume").over(window).alias("avg_vol"))
    spread = with_volume_stats(frame).drop("std_vol")
    assert spread.exceptAll(plain).count() == 0
    assert spread.count() == plain.count()
