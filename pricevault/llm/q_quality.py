"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricevault.llm.quality_rules import quality_rules
from pricevault.llm.registry import query, table


@query("op3_compression_bands")
def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")
