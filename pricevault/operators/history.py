"""Type-2 history: validity intervals, change detection and point-in-time reads.

Two forms are kept. The *version log* is append-only and holds one row per change; the
end of a version is the start of the key's next one. The *materialised history* stores
``End_DTS`` and is rewritten by :func:`scd2_apply`. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, LOADED = "Effective_DTS", "End_DTS", "Load_DTS"
AS_OF = "As_Of"


def moment(value: datetime | str | Column) -> Column:
    """A zone-free UTC timestamp column from a parameter."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime) and value.tzinfo:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(value)).cast("timestamp_ntz")


def current(df: DataFrame) -> DataFrame:
    """Versions that are open."""
    return df.filter(F.col(END).isNull())


def as_of(df: DataFrame, at: datetime | str) -> DataFrame:
    """Versions that were valid at ``at``: start included, end excluded."""
    t = moment(at)
    return df.filter((F.col(START) <= t) & (F.col(END).isNull() | (F.col(END) > t)))


def with_moments(df: DataFrame, moments: Sequence[datetime | str], name: str) -> DataFrame:
    """Versions that were valid at some of ``moments``, with these as the array ``name``.

    The moments are a parameter, so each version finds its own in its row: no join of intervals, and
    versions that hold at none of them are gone before anything is shuffled. Equal moments count once.
    """
    if not moments:
        raise ValueError("no moments")
    given = F.array_distinct(F.array(*[moment(m) for m in moments]))
    held = F.filter(given, lambda t: (F.col(START) <= t) & (F.col(END).isNull() | (F.col(END) > t)))
    return df.withColumn(name, held).filter(F.size(name) > 0)


def versions_at(df: DataFrame, moments: Sequence[datetime | str]) -> DataFrame:
    """The version of each key that was valid at each of ``moments``, one row each, with the moment as ``As_Of``."""
    return with_moments(df, moments, AS_OF).withColumn(AS_OF, F.explode(AS_OF))


def scd2_history(
    feed: DataFrame,
    keys: Sequence[str],
    hash_col: str = "Hash_Diff",
    at: str = LOADED,
) -> DataFrame:
    """Versions with validity intervals from a feed of all batches, in any order.

    A row that repeats the hash before it is dropped; ``End_DTS`` is the start of the next
    remaining row. Both steps run on one shuffle by key. A key of a history is one bar or one
    company, so its rows are its versions and plain windows hold few rows per key.
    """
    along = Window.partitionBy(*keys).orderBy(at, hash_col)
    seen = feed.withColumn("_before", F.lag(F.struct(hash_col)).over(along))
    repeated = F.col("_before").isNotNull() & F.col("_before").eqNullSafe(F.struct(hash_col))
    changed = seen.filter(~repeated).drop("_before").withColumn(START, F.col(at))
    return changed.withColumn(END, F.lead(START).over(along))


def intervals(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Version log -> history: derive ``End_DTS`` from the next version's start."""
    along = Window.partitionBy(*keys).orderBy(START)
    return log.drop(END).withColumn(END, F.lead(START).over(along))


def scd2_changes(
    newest: DataFrame, staged: DataFrame, keys: Sequence[str], hash_col: str = "Hash_Diff"
) -> DataFrame:
    """Staged rows that start a version: the key is new or its newest hash differs.

    ``newest`` holds one row per key with its start. A change that is not later than the
    version it would follow stops the job: versions are loaded in order.
    """
    known = newest.select(*[F.col(c).alias(f"_{c}") for c in (*keys, hash_col, START)])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k) == F.col(f"_{k}")
    differs = F.col(f"_{keys[0]}").isNull() | ~F.col(hash_col).eqNullSafe(F.col(f"_{hash_col}"))
    found = staged.join(known, same, "left").filter(differs)
    late = F.raise_error(F.lit("batch is not later than the newest version")).cast("timestamp_ntz")
    start = F.when(F.col(f"_{START}").isNull() | (F.col(f"_{START}") < F.col(LOADED)), F.col(LOADED)).otherwise(late)
    return found.withColumn(START, start).select(*dict.fromkeys([*staged.columns, START]))


def scd2_apply(
    history: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    load_dts: datetime | str,
    hash_col: str = "Hash_Diff",
) -> DataFrame:
    """Materialised history after one batch; ``staged`` must be unique on ``keys``.

    A changed key has its open version closed and its new one opened in the same pass.
    Absent keys stay open. Closed versions pass through without a shuffle. A batch that
    is not later than the open version it would close stops the job.
    """
    columns = history.columns
    opened = current(history).select(F.struct(*columns).alias("_old"))
    fresh = staged.withColumn(START, F.col(LOADED)).withColumn(END, F.lit(None).cast("timestamp_ntz"))
    fresh = fresh.select(F.struct(*columns).alias("_new"))

    on = F.lit(True)
    for k in keys:
        on &= F.col(f"_old.{k}") == F.col(f"_new.{k}")
    old, new, t = F.col("_old"), F.col("_new"), moment(load_dts)
    differs = ~F.col(f"_old.{hash_col}").eqNullSafe(F.col(f"_new.{hash_col}"))
    changed = old.isNotNull() & new.isNotNull() & differs
    late = F.raise_error(F.lit("batch is not later than the open version")).cast("timestamp_ntz")
    end = F.when(F.col(f"_old.{START}") < t, t).otherwise(late)

    kept = F.when(changed, old.withField(END, end)).otherwise(old)
    added = F.when(changed | old.isNull(), new)
    rows = opened.join(fresh, on, "full_outer").select(
        F.explode(F.filter(F.array(kept, added), lambda r: r.isNotNull())).alias("_row")
    )
    closed = history.filter(F.col(END).isNotNull())
    return closed.unionByName(rows.select("_row.*").select(*columns))
