"""Query of packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.llm.packing import pack_documents
from pricevault.llm.registry import query, table


@query("op1_bm25_packing")
def op1_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
