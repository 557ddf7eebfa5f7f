"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.llm.quality_model import score, train
from pricevault.llm.registry import query, table

#: A document counts as good from this score on.
GOOD = 0.7


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


@query("op9_subword_quality")
def op9_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
