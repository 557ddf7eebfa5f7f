"""Queries over aggregates, windows, top-k and the small people reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import frames as fr
from checks.frames import sql
from checks.registry import query
from pricevault.operators import analytics as an
from pricevault.operators.keyed import dedupe, latest
from pricevault.schemas import PRICE_COLUMNS

BARS = "Date, Symbol, Open, High, Low, Close, Volume, Dividends, Stock_Splits"

PREV = (
    "SELECT Symbol, Date, Close, "
    "lag(Close) OVER (PARTITION BY Symbol ORDER BY Date) AS prev_close FROM hist"
)
STATS = (
    "SELECT Symbol, Date, Volume, avg(Volume) OVER (PARTITION BY Symbol) AS avg_vol, "
    "stddev_samp(Volume) OVER (PARTITION BY Symbol) AS std_vol FROM hist"
)
RETURNS = (
    "SELECT Symbol, Date, Close, prev_close, "
    f"round((Close - prev_close) / prev_close, 6) AS daily_return FROM ({PREV}) "
    "WHERE prev_close IS NOT NULL"
)
CHANGES = (
    "SELECT Symbol, Date, Close, prev_close, round(Close - prev_close, 6) AS diff, "
    f"round((Close - prev_close) / prev_close * 100, 6) AS pct FROM ({PREV})"
)
ZSCORES = (
    "SELECT Symbol, Date, Volume, round(avg_vol, 6) AS avg_vol, "
    f"round((Volume - avg_vol) / nullif(std_vol, 0), 6) AS z_score FROM ({STATS}) WHERE std_vol > 0"
)


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "agg_profile",
    sql(
        "SELECT count(DISTINCT Symbol) AS n_symbols, min(Date) AS first_date, "
        "max(Date) AS last_date, count(*) AS n_rows FROM hist",
        "hist",
    ),
)
def agg_profile(spark, d):
    return an.profile(fr.hist(spark, d))


@query("agg_min_close", sql("SELECT min(Close) AS min_close FROM hist", "hist"))
def agg_min_close(spark, d):
    return an.column_min(fr.hist(spark, d), "Close", "min_close")


@query(
    "agg_ath_atl",
    sql(
        "SELECT Symbol, max(Close) AS ath_close, min(Close) AS atl_close FROM hist GROUP BY Symbol",
        "hist",
    ),
)
def agg_ath_atl(spark, d):
    return an.extremes(fr.hist(spark, d))


@query(
    "agg_avg_volume",
    sql("SELECT Symbol, round(avg(Volume), 6) AS avg_volume FROM hist GROUP BY Symbol", "hist"),
)
def agg_avg_volume(spark, d):
    return rounded(an.average_volume(fr.hist(spark, d)), "avg_volume")


@query("agg_row_count", sql("SELECT count(*) AS n_rows FROM hist", "hist"))
def agg_row_count(spark, d):
    return an.row_count(fr.hist(spark, d))


@query("agg_mean", sql("SELECT round(avg(age), 6) AS mean_age FROM people", "people"))
def agg_mean(spark, d):
    return rounded(an.column_mean(fr.people(spark, d), "age", "mean_age"), "mean_age")


@query(
    "agg_distinct",
    sql(
        "SELECT DISTINCT md5(strftime(Date, '%Y-%m-%d')) AS Calendar_HK, Date, "
        f"TIMESTAMP '{fr.LOADS[1]}' AS Load_DTS, 'historicals' AS Record_Source FROM hist",
        "hist",
    ),
)
def agg_distinct(spark, d):
    staged = fr.stage_daily(fr.hist(spark, d), 1)
    return staged.select("Calendar_HK", "Date", "Load_DTS", "Record_Source").distinct()


@query(
    "agg_dedupe_by_key",
    """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
)
def agg_dedupe_by_key(spark, d):
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    return dedupe(fr.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@query("win_prev_close", sql(PREV, "hist"))
def win_prev_close(spark, d):
    return an.with_previous_close(fr.hist(spark, d))


@query("win_daily_return", sql(RETURNS, "hist"))
def win_daily_return(spark, d):
    return rounded(an.daily_returns(fr.hist(spark, d)), "daily_return")


@query("win_price_change", sql(CHANGES, "hist"))
def win_price_change(spark, d):
    return rounded(an.price_change(fr.hist(spark, d)), "diff", "pct")


@query(
    "win_avg_std",
    sql(
        "SELECT Symbol, Date, Volume, round(avg_vol, 6) AS avg_vol, round(std_vol, 6) AS std_vol "
        f"FROM ({STATS})",
        "hist",
    ),
)
def win_avg_std(spark, d):
    return rounded(an.with_volume_stats(fr.hist(spark, d)), "avg_vol", "std_vol")


@query("win_volume_zscore", sql(ZSCORES, "hist"))
def win_volume_zscore(spark, d):
    return rounded(an.volume_zscore(fr.hist(spark, d)), "avg_vol", "z_score")


@query(
    "win_latest_per_key",
    sql(f"SELECT {BARS} FROM merged", "merged"),
)
def win_latest_per_key(spark, d):
    bars = fr.hist(spark, d)
    log = fr.early(bars).withColumn("batch", F.lit(1)).union(
        fr.late(fr.restated(bars)).withColumn("batch", F.lit(2))
    )
    return latest(log, ["Symbol", "Date"], "batch").drop("batch")


@query(
    "join_volume_vs_avg",
    sql(
        "SELECT h.Date, h.Volume, round(v.avg_volume, 6) AS avg_volume, "
        "round(h.Volume - v.avg_volume, 6) AS diff FROM hist h JOIN "
        "(SELECT Symbol, avg(Volume) AS avg_volume FROM hist WHERE Symbol = 'P7' GROUP BY Symbol) v "
        "ON h.Symbol = v.Symbol ORDER BY diff DESC, h.Date LIMIT 10",
        "hist",
    ),
)
def join_volume_vs_avg(spark, d):
    rows = rounded(an.volume_vs_average(fr.hist(spark, d), "P7"), "avg_volume", "diff")
    return an.top(rows, 10, F.desc("diff"), F.col("Date"))


@query(
    "top_volume",
    sql(f"SELECT {BARS} FROM hist WHERE Symbol = 'P7' ORDER BY Volume DESC, Date LIMIT 10", "hist"),
)
def top_volume(spark, d):
    bars = an.of_symbol(fr.hist(spark, d), "P7")
    return an.top(bars, 10, F.desc("Volume"), F.col("Date"))


@query(
    "top_latest",
    sql(f"SELECT {BARS} FROM hist WHERE Symbol = 'P7' ORDER BY Date DESC LIMIT 10", "hist"),
)
def top_latest(spark, d):
    return an.top(an.of_symbol(fr.hist(spark, d), "P7"), 10, F.desc("Date"))


@query(
    "top_daily_return",
    sql(RETURNS + " ORDER BY daily_return DESC, Symbol, Date LIMIT 10", "hist"),
)
def top_daily_return(spark, d):
    returns = rounded(an.daily_returns(fr.hist(spark, d)), "daily_return")
    return an.top(returns, 10, F.desc("daily_return"), F.col("Symbol"), F.col("Date"))


@query(
    "sort_price_change",
    sql(CHANGES + " ORDER BY pct DESC NULLS LAST, Symbol, Date", "hist"),
)
def sort_price_change(spark, d):
    changes = rounded(an.price_change(fr.hist(spark, d)), "diff", "pct")
    return changes.orderBy(F.desc_nulls_last("pct"), "Symbol", "Date")


@query("top_zscore", sql(ZSCORES + " ORDER BY z_score DESC, Symbol, Date LIMIT 20", "hist"))
def top_zscore(spark, d):
    scores = rounded(an.volume_zscore(fr.hist(spark, d)), "avg_vol", "z_score")
    return an.top(scores, 20, F.desc("z_score"), F.col("Symbol"), F.col("Date"))


@query(
    "sort_preview",
    sql(f"SELECT {BARS} FROM hist ORDER BY Symbol, Date LIMIT 10", "hist"),
)
def sort_preview(spark, d):
    return an.preview(fr.hist(spark, d).select("Date", "Symbol", *PRICE_COLUMNS), ["Symbol", "Date"], 10)


@query(
    "sort_corporate_actions",
    sql(
        f"SELECT {BARS} FROM hist WHERE Dividends > 0 OR Stock_Splits > 0 ORDER BY Date, Symbol",
        "hist",
    ),
)
def sort_corporate_actions(spark, d):
    return an.corporate_actions(fr.hist(spark, d)).orderBy("Date", "Symbol")


PEOPLE = "SELECT name, age, gender, salary FROM people"


@query("row_oldest", sql(PEOPLE + " ORDER BY age DESC, name LIMIT 1", "people"))
def row_oldest(spark, d):
    return an.oldest(fr.people(spark, d))


@query("row_youngest", sql(PEOPLE + " ORDER BY age, name LIMIT 1", "people"))
def row_youngest(spark, d):
    return an.youngest(fr.people(spark, d))


@query(
    "row_lowest_paid_female",
    sql(PEOPLE + " WHERE gender = 'female' ORDER BY salary, name LIMIT 1", "people"),
)
def row_lowest_paid_female(spark, d):
    return an.lowest_paid(fr.people(spark, d), "female")
