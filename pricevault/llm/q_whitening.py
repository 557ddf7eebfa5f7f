"""Query of embedding whitening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.llm.registry import query, table
from pricevault.llm.whitening import whiten


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact deviation as a long; one that doesn't fit (about 3 million rows of spread vectors) stops the query."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
