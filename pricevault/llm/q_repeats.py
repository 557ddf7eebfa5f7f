"""Queries of line dedup and substring dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.llm.line_dedup import line_dedup
from pricevault.llm.registry import query, table
from pricevault.llm.substring_dedup import substring_dedup

LINES_SQL = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
win AS (SELECT doc_id, w[i:i + 2] AS s, i FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM l)),
late AS (SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM late, (SELECT unnest([0, 1, 2]) AS k)),
unit AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM l),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, chr(10) ORDER BY p) AS t
         FROM unit u WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = u.doc_id AND g.p = u.p) GROUP BY doc_id)
SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_lines, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""

WORDS_SQL = r"""
WITH l AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, array_to_string(w[i:i + 12], ' ') AS s, i
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM l)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM late, (SELECT unnest(range(0, 13)) AS k)),
unit AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM l),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
         FROM unit u WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = u.doc_id AND g.p = u.p) GROUP BY doc_id)
SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""


def _digest(cut: DataFrame, count: str, text: Column) -> DataFrame:
    return cut.select("doc_id", F.col("n_units").alias(count), "n_removed", F.sha2(text, 256).alias("kept_sha256"))


@query("op7_line_windows", LINES_SQL)
def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")), "n_lines", F.col("text"))


@query("op10_substring_dedup", WORDS_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))  # kept words joined by one space
    return _digest(substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")), "n_words", words)
