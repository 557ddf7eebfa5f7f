"""Operators that work on keys: one row per key, upsert, insert-only merge.

Every function takes and returns DataFrames; nothing is written and nothing runs
until the caller's action. ``row_number() <= k`` over a key is planned by Spark as
a limit per key inside each map task *and* after the shuffle, so a key that holds
a large share of the rows sends at most ``k`` rows per map task over the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], limit: int):
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) <= limit)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in ``order``. Name enough order columns to be exact."""
    return _ranked(df, keys, order, 1).drop(RANK)


def latest(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The last row of each key by the ``order`` columns."""
    names = [order] if isinstance(order, str) else list(order)
    return dedupe(df, keys, [F.col(n).desc() for n in names])


def unique_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    on_duplicate: str = "fail",
    shown: Sequence[str] | None = None,
) -> DataFrame:
    """Make sure a merge source holds each key once.

    ``on_duplicate="first"`` keeps the first row in ``order``; ``"fail"`` stops the job
    when any key comes twice. Either way at most two rows per key and task are moved. ``shown`` columns name
    the key in the error, where ``keys`` are not for reading.
    """
    if on_duplicate == "first":
        return dedupe(df, keys, order)
    if on_duplicate != "fail":
        raise ValueError("on_duplicate must be 'fail' or 'first'")
    error = F.raise_error(F.concat_ws(" ", F.lit("duplicate merge key:"), *(shown or keys)))
    only = F.when(F.col(RANK) == 1, True).otherwise(error.cast("boolean"))
    return _ranked(df, keys, order, 2).filter(only).drop(RANK)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that come more than once, with their row counts."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def absent_from(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``target``; only the target's key columns are read.

    A NULL key matches nothing, so such a row counts as absent.
    """
    return rows.join(target.select(*keys), list(keys), "left_anti").select(*rows.columns)


def insert_new(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Rows an insert-only merge adds: one per new key.

    The window leaves the rows hashed and sorted on ``keys``, which is what the
    anti-join needs, so staging is shuffled once for both.
    """
    return absent_from(target, dedupe(staged, keys, order), keys)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after update-all / insert-all by key; ``source`` must be unique on ``keys``.

    Untouched target rows come from an anti-join against the source's keys, so a
    small source is broadcast by Spark's own size check and the target stays in place.
    """
    untouched = absent_from(source, target, keys)
    return untouched.unionByName(source.select(*target.columns))
