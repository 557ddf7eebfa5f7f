"""Queries over statistics stored by batch, and over views as of given moments."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import frames as fr
from checks.frames import LOADS, sql
from checks.loading import DAY_VIEW, MINUTE_VIEW
from checks.registry import query
from pricevault import shared_dir
from pricevault.operators import analytics as an
from pricevault.operators.views import instrument_view_at
from pricevault.plans.jobs import Batch, read_bronze, run_bronze_daily
from pricevault.plans.statistics import run_bar_statistics, stored_extremes, stored_profile, volume_stats
from pricevault.schemas import DAY, HISTORICALS, MINUTE


def _three_batches(spark, d) -> str:
    """Early bars, late and restated ones, then all from 1998 on as they were; statistics after each."""

    def write(base: str) -> None:
        bars = fr.hist(spark, d)
        third = bars.filter("Date >= DATE '1998-01-01'").withColumn("Volume", F.col("Volume") * 2)
        feeds = {1: fr.early(bars), 2: fr.late(fr.restated(bars)), 3: third}
        for k, feed in feeds.items():
            run_bronze_daily(fr.raw_daily(feed), Batch(base, k, LOADS[k]))
            run_bar_statistics(spark, base, DAY, k)

    return fr.written_once(spark, d, "bronze-statistics", write)


AFTER_THREE = (
    "SELECT Date, Symbol, CASE WHEN Date >= DATE '1998-01-01' THEN Volume * 2 ELSE Volume END AS Volume FROM merged"
)
AFTER_STATS = (
    "SELECT Symbol, Date, Volume, avg(Volume) OVER (PARTITION BY Symbol) AS avg_vol, "
    f"stddev_samp(Volume) OVER (PARTITION BY Symbol) AS std_vol FROM ({AFTER_THREE})"
)


@query(
    "win_avg_std_stored",
    sql(f"SELECT Symbol, Date, Volume, round(avg_vol, 6) AS avg_vol, round(std_vol, 6) AS std_vol FROM ({AFTER_STATS})", "merged"),
)
def win_avg_std_stored(spark, d):
    """Bars with the mean and deviation merged from stored periods after three batches."""
    base = _three_batches(spark, d)
    bars = an.with_volume_stats(read_bronze(spark, base, HISTORICALS), volume_stats(spark, base, DAY))
    return bars.withColumns({n: F.round(n, 6) for n in ("avg_vol", "std_vol")})


@query(
    "win_volume_zscore_stored",
    sql(
        "SELECT Symbol, Date, Volume, round(avg_vol, 6) AS avg_vol, round((Volume - avg_vol) / nullif(std_vol, 0), 6) AS z_score "
        f"FROM ({AFTER_STATS}) WHERE std_vol > 0",
        "merged",
    ),
)
def win_volume_zscore_stored(spark, d):
    base = _three_batches(spark, d)
    scores = an.volume_zscore(read_bronze(spark, base, HISTORICALS), volume_stats(spark, base, DAY))
    return scores.withColumns({n: F.round(n, 6) for n in ("avg_vol", "z_score")})


@query(
    "agg_ath_atl_stored",
    sql(
        "SELECT Symbol, max(Close) AS ath_close, min(Close) AS atl_close FROM ("
        "SELECT Symbol, Close FROM merged WHERE Date < DATE '1998-01-01' UNION ALL "
        "SELECT Symbol, Close FROM hist WHERE Date >= DATE '1998-01-01') GROUP BY Symbol",
        "merged",
    ),
)
def agg_ath_atl_stored(spark, d):
    return stored_extremes(spark, _three_batches(spark, d), DAY)


@query(
    "agg_profile_sketch",
    sql(
        "SELECT TRUE AS within_2_percent, min(Date) AS first_date, max(Date) AS last_date, count(*) AS n_rows FROM merged",
        "merged",
    ),
)
def agg_profile_sketch(spark, d):
    """The profile from stored sketches; the symbols it estimates are held against the exact number."""
    base = _three_batches(spark, d)
    found = stored_profile(spark, base, DAY).withColumn("exact", F.lit(None).cast("bigint"))
    absent = [F.lit(None).alias(c) for c in found.columns[:-1]]
    exact = an.profile(read_bronze(spark, base, HISTORICALS)).select(*absent, F.col("n_symbols").alias("exact"))
    both = found.union(exact).agg(*(F.max(c).alias(c) for c in found.columns))
    near = F.abs(F.col("n_symbols") - F.col("exact")) <= F.col("exact") * 0.02
    return both.select(near.alias("within_2_percent"), "first_date", "last_date", "n_rows")


#: Before the first load, after the first and the second, at the start of the third, and long after.
MOMENTS = ("2023-12-31 00:00:00", "2024-01-15 00:00:00", "2024-02-15 12:00:00", LOADS[3], "2030-01-01 00:00:00")
_MOMENTS = "(VALUES " + ", ".join(f"(TIMESTAMP '{m}')" for m in MOMENTS) + ") m(As_Of)"
_COMPANY = "c.symbol = h.Symbol AND c.Effective_DTS <= m.As_Of AND (c.End_DTS IS NULL OR c.End_DTS > m.As_Of)"


@query(
    "view_daily_as_of",
    sql(
        f"SELECT m.As_Of, {DAY_VIEW} FROM {_MOMENTS} JOIN day_versions h ON h.Load_DTS <= m.As_Of JOIN versions c ON {_COMPANY} "
        "QUALIFY row_number() OVER (PARTITION BY m.As_Of, h.Symbol, h.Date ORDER BY h.Load_DTS DESC) = 1",
        "day_versions",
        "versions",
    ),
)
def view_daily_as_of(spark, d):
    view = instrument_view_at(fr.stored_vault(spark, d), DAY, MOMENTS)
    return view.withColumn("Intraday_Range", F.round("Intraday_Range", 6))


@query(
    "view_minute_as_of",
    sql(
        f"SELECT m.As_Of, {MINUTE_VIEW} FROM {_MOMENTS} JOIN minute_versions h "
        "ON h.Effective_DTS <= m.As_Of AND (h.End_DTS IS NULL OR h.End_DTS > m.As_Of) "
        f"JOIN versions c ON {_COMPANY}",
        "minute_versions",
        "versions",
    ),
)
def view_minute_as_of(spark, d):
    view = instrument_view_at(fr.stored_vault(spark, d), MINUTE, MOMENTS)
    return view.withColumn("Intra_Minute_Range", F.round("Intra_Minute_Range", 6))
