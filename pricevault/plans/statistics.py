"""Statistics that grow by batch: stored for each calendar period, combined on read.

After a bronze batch, ``run_bar_statistics`` computes the periods that the batch touched anew and no
others, so its work follows the batch and not the table. A period holds what can be merged: count, mean and sum of
squared deviations of each symbol's volume, its least and greatest close, and a sketch of the symbols.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.plans.jobs import PERIOD, PERIOD_FIELD, bronze_runs, period, read_batch, read_bronze
from pricevault.schemas import BIGINT, DOUBLE, STRING, Grain, struct
from pricevault.sources.runs import fingerprint
from pricevault.sources.tablelog import BATCH, LOAD, append_log, read_as_of, read_log

#: Sketch size as a power of two: a relative standard error of about 0.8 percent, 16 kB a period.
LOG_REGISTERS = 14

_RECORD = struct(("folder", STRING), ("reads", STRING))


def _places(base: str, grain: Grain) -> tuple[str, str, str]:
    """Paths of the moments, the profile and the records."""
    root = f"{grain.bronze.location(base)}_statistics"
    return f"{root}/moments", f"{root}/profile", f"{root}/records"


def _schemas(grain: Grain) -> tuple[T.StructType, T.StructType]:
    time = grain.bronze.schema[grain.time].dataType
    seen = (("first_time", time), ("last_time", time), ("n_rows", BIGINT))
    closes = (("low", DOUBLE), ("high", DOUBLE))
    moments = struct(("Symbol", STRING), ("n", BIGINT), ("mean", DOUBLE), ("m2", DOUBLE), *closes, *seen, (LOAD, STRING))
    profile = struct(("symbols", T.BinaryType()), *seen, (LOAD, STRING))
    return moments.add(PERIOD_FIELD), profile.add(PERIOD_FIELD)


def run_bar_statistics(spark: SparkSession, base: str, grain: Grain, batch_id: int) -> None:
    """Statistics of the periods that bronze batch ``batch_id`` touched, as they stand after it.

    A run writes to folders of its own, which count once its record is there; the record names the bronze
    runs that it read. A run that dies leaves the statistics of the batch as they were.
    """
    moments_path, profile_path, records = _places(base, grain)
    reads = fingerprint(bronze_runs(spark, base, grain.bronze, batch_id))
    touched = read_batch(spark, base, grain.bronze, batch_id).withColumn(PERIOD, period(grain))
    first, last = touched.agg(F.min(PERIOD), F.max(PERIOD)).first()
    folder = f"run-{uuid.uuid4().hex}"
    if first is None:  # nothing was accepted; a span that holds no bar
        first = last = "0001-01-01"
    bars = read_bronze(spark, base, grain.bronze, batch_id, days=(str(first), str(last))).withColumn(PERIOD, period(grain))
    seen = F.min(grain.time).alias("first_time"), F.max(grain.time).alias("last_time"), F.count(F.lit(1)).alias("n_rows")
    volume = F.col("Volume").cast("double")
    m2 = F.var_pop(volume) * F.count("Volume")
    closes = F.min("Close").alias("low"), F.max("Close").alias("high")
    moments = bars.groupBy("Symbol", PERIOD).agg(F.count("Volume").alias("n"), F.avg(volume).alias("mean"), m2.alias("m2"), *closes, *seen)
    append_log(moments, moments_path, batch_id, [PERIOD], load=folder)

    stored = read_log(spark, moments_path, _schemas(grain)[0]).filter((F.col(BATCH) == batch_id) & (F.col(LOAD) == folder))
    whole = F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), F.sum("n_rows").alias("n_rows")
    profile = stored.groupBy(PERIOD).agg(F.hll_sketch_agg("Symbol", F.lit(LOG_REGISTERS)).alias("symbols"), *whole)
    append_log(profile, profile_path, batch_id, load=folder)
    append_log(spark.createDataFrame([(folder, reads)], _RECORD).coalesce(1), records, batch_id)


def _newest(spark: SparkSession, base: str, grain: Grain, of: int, keys: list[str], upto: int | None) -> DataFrame:
    """Newest statistics of each period; every bronze batch must have its own, made from the runs that count now."""
    runs = bronze_runs(spark, base, grain.bronze, upto)
    records = {r[BATCH]: r for r in read_log(spark, _places(base, grain)[2], _RECORD, upto, may_be_new=True).collect()}
    fits = {
        k: k in records and records[k].reads == fingerprint(r for r in runs if r.batch_id <= k)
        for k in sorted({r.batch_id for r in runs})
    }
    if not fits or not all(fits.values()):
        raise ValueError(f"statistics to be run: batches {[k for k, good in fits.items() if not good]}")
    log = read_log(spark, _places(base, grain)[of], _schemas(grain)[of], upto)
    log = log.filter(F.col(LOAD).isin([records[k].folder for k in fits])).drop(LOAD)
    return read_as_of(log, keys, max(fits))


def merged_moments(a: Column, b: Column) -> Column:
    """Count, mean and sum of squared deviations of two sets together, by Chan's rule; ``b`` isn't empty."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    mean = a["mean"] + apart * b["n"] / n
    return F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))


def volume_stats(spark: SparkSession, base: str, grain: Grain, upto: int | None = None) -> DataFrame:
    """``Symbol``, ``n``, ``avg_vol`` and ``std_vol`` (sample deviation) after a batch, from the stored periods.

    Null volumes don't count; a symbol without any has ``n`` 0 and nulls. Periods are merged in their order, so
    results do not depend on partitioning; a symbol has as many of them as the calendar has years or months.
    """
    rows = _newest(spark, base, grain, 0, ["Symbol", PERIOD], upto)
    part = F.when(F.col("n") > 0, F.struct(PERIOD, "n", "mean", "m2"))
    parts = rows.groupBy("Symbol").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    all_of = parts.select("Symbol", F.aggregate("parts", none, merged_moments).alias("all"))
    n, mean, m2 = (F.col(f"all.{x}") for x in ("n", "mean", "m2"))
    deviation = F.when(n > 1, F.sqrt(m2 / (n - 1)))
    return all_of.select("Symbol", n.alias("n"), F.when(n > 0, mean).alias("avg_vol"), deviation.alias("std_vol"))


def stored_extremes(spark: SparkSession, base: str, grain: Grain, upto: int | None = None) -> DataFrame:
    """All-time high and low close of each symbol after a batch, without reading a bar."""
    rows = _newest(spark, base, grain, 0, ["Symbol", PERIOD], upto)
    return rows.groupBy("Symbol").agg(F.max("high").alias("ath_close"), F.min("low").alias("atl_close"))


def stored_profile(spark: SparkSession, base: str, grain: Grain, upto: int | None = None) -> DataFrame:
    """Symbols (estimated), first and last time and rows after a batch, without reading a bar."""
    rows = _newest(spark, base, grain, 1, [PERIOD], upto)
    return rows.agg(
        F.hll_sketch_estimate(F.hll_union_agg("symbols")).alias("n_symbols"),
        F.min("first_time").alias("first_date"),
        F.max("last_time").alias("last_date"),
        F.sum("n_rows").alias("n_rows"),
    )
