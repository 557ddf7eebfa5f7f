"""Query of near-duplicate detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricevault.llm.minhash_dedup import near_duplicates
from pricevault.llm.registry import query, table


@query("op6_dart_minhash")
def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
