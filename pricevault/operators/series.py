"""Neighbour values along ordered series, safe for keys of any size.

A plain ``lag``/``lead`` sends all rows of one key to one task. Here every key's series is cut
into calendar pieces, the window runs per piece, and the value that crosses from one piece to
the next comes from a table of piece edges: one row per key and piece, found by map-side
aggregation. The plan is the same for all sizes, and the edges meet the rows on the
partitioning that the window has already made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def calendar_piece(name: str, dtype: T.DataType) -> Column:
    """Month of a date, day of a timestamp: an ordered cut of the calendar.

    NULL sorts first, so it gets the piece before all others.
    """
    day = F.col(name)
    piece = F.trunc(day, "month") if isinstance(dtype, T.DateType) else day.cast("date")
    return F.coalesce(piece, F.lit("0001-01-01").cast("date"))


def with_neighbour(
    df: DataFrame,
    value: str,
    out: str,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    ahead: bool = False,
) -> DataFrame:
    """Add ``out``: ``value`` of the key's previous row (the next one if ``ahead``).

    ``order`` is a date or timestamp, then ``ties``. Rows whose keys are NULL are a series
    as well. Keys and piece are one struct, which a join compares NULL for NULL.
    """
    shift, edge = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    place = F.struct(*keys, calendar_piece(order, df.schema[order].dataType).alias("_piece"))
    cut = df.withColumn("_place", place)
    window = Window.partitionBy("_place").orderBy(order, *ties)

    # Without ties the edge is found by plain columns, which Spark aggregates by hash in the map tasks. A piece whose
    # order is all NULL has any of its rows as its edge.
    if ties:
        last = edge(F.struct(value), F.struct(order, *ties))[value]
    else:
        last = F.when(F.max(order).isNull(), F.first(value)).otherwise(edge(value, order))
    along = Window.partitionBy(*[F.col(f"_at.{k}") for k in keys]).orderBy("_at._piece")
    edges = (
        cut.groupBy(F.col("_place").alias("_at"))
        .agg(last.alias("_last"))
        .withColumn("_edge", shift(F.struct("_last")).over(along))
        .filter(F.col("_edge").isNotNull())
        .drop("_last")
    )
    # ``shift`` of a constant is NULL exactly on the row that has no neighbour in its piece.
    inside = shift(F.lit(True)).over(window)
    near = cut.withColumn(out, shift(value).over(window)).withColumn("_inside", inside)
    crossed = F.when(F.col("_inside").isNull(), F.col("_edge._last")).otherwise(F.col(out))
    joined = near.join(edges, F.col("_place") == F.col("_at"), "left")
    return joined.withColumn(out, crossed).drop("_place", "_inside", "_edge", "_at")
