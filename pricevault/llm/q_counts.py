"""Query of token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricevault.llm.registry import query, table
from pricevault.llm.token_counts import count_tokens


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
