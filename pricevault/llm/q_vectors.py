"""Query of nearest-neighbour search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.llm.kmeans_tree import nearest_neighbours
from pricevault.llm.registry import query, table


@query("op8_kmeans_tree")
def op8_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
