"""Number the rows of ordered groups, however large a group is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricevault.llm.stored import stored

INDEX, TOTAL = "__index", "__total"


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``__index`` (from 0, along ``order`` within ``group``) and ``__total`` of the group.

    Rows are dealt into ranges of (group, order), so a group lies in as many tasks as it fills.
    A range numbers its own rows; where they start in their group follows from the counts of the
    ranges before, of which there is one for each group and range. Equal rows are numbered
    in the order in which the input holds them. ``group`` must not be NULL.
    """
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(group, *order, "__tie").withColumn("__range", F.spark_partition_id())
    ranged = stored(ranged, "ranged")
    counts = stored(ranged.groupBy(F.col(group).alias("__of"), F.col("__range").alias("__at")).agg(F.count("*").alias("__n")), "counts")
    whole = Window.partitionBy("__of")
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("__of", "__at", before.alias("__before"), F.sum("__n").over(whole).alias(TOTAL))
    along = Window.partitionBy(group, "__range").orderBy(*order, "__tie")
    own = ranged.withColumn("__own", F.row_number().over(along) - 1)
    met = own.join(starts, (own[group] == starts["__of"]) & (own["__range"] == starts["__at"]))
    return met.withColumn(INDEX, F.col("__own") + F.col("__before")).drop("__own", "__before", "__of", "__at", "__range", "__tie")
