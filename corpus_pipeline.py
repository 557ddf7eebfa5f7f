"""The corpus pipeline: five stages from ``documents`` to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Its result is
written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``, with ``n_chars`` following the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricevault.llm.line_dedup import line_dedup
from pricevault.llm.minhash_dedup import near_duplicates
from pricevault.llm.packing import pack_documents
from pricevault.llm.quality_rules import quality_rules
from pricevault.llm.stored import stored
from pricevault.llm.substring_dedup import substring_dedup


#: Names inside a stage: no column of the documents can meet one that an operator adds.
ID, TEXT = "doc_id", "text"


def _inside(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``doc_id``, ``text`` and numbered ones, whatever names the others have."""
    return docs.select([F.col(f"`{c}`").alias(c if c in (ID, TEXT) else f"column_{i}") for i, c in enumerate(docs.columns)])


def _documents(inside: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of a frame of ``_inside``, with ``n_chars`` counted anew."""
    columns = []
    for i, c in enumerate(like.columns):
        column = F.col(c if c in (ID, TEXT) else f"column_{i}")
        if c == "n_chars":
            column = F.char_length(TEXT).cast(like.schema[c].dataType)
        columns.append(column.alias(c))
    return inside.select(columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged but for ``n_chars``, which is counted.

    Null and empty texts are rejected. Rows are judged one by one: null and repeated ids and repeated rows are no matter.
    Other columns, whatever their names, stay as they are.
    """
    return _documents(quality_rules(_inside(docs)).where("kept"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of three-line windows that occurred before; none is dropped.

    Null texts become empty. Rows with a null id lose only own repeats; rows with equal ids are one document in the
    comparison and are cut each by itself. Other columns, whatever their names, stay as they are.
    """
    return _documents(line_dedup(_inside(docs)), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least id, null ids last, then the first as stored.

    Rows are compared by their texts, whatever their ids: rows of equal ids with unlike texts all stay,
    and of fully equal rows one. Texts without words (null ones count as empty) are alike only if they are equal.
    """
    rows = stored(_inside(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    classes = stored(near_duplicates(rows, id_col="row").select(F.col("doc_id").alias("member"), "class_id"), "classes")
    several = classes.where("member <> class_id")  # a class's id is one of its members
    several = several.union(several.select("class_id", "class_id").distinct())
    place = F.struct(F.col(ID).isNull().alias("none"), F.col(ID), F.col("row"))
    placed = several.join(rows.select(ID, "row"), F.col("member") == F.col("row")).select("member", "class_id", place.alias("place"))
    first = placed.groupBy(F.col("class_id").alias("of")).agg(F.min("place")["row"].alias("first"))
    late = placed.join(first, (F.col("class_id") == F.col("of")) & (F.col("member") != F.col("first"))).select("member")
    return _documents(rows.join(late, F.col("row") == F.col("member"), "left_anti"), docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a document of smaller id holds.

    All other bytes stay: a text in which nothing repeats keeps its lines and indentation. Null texts become
    empty; rows with a null id lose nothing, and rows with equal ids nothing to each other. Other columns stay as they are.
    """
    return _documents(substring_dedup(_inside(docs)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, neighbours by BM25 together.

    A null or empty text is the end token alone; null and repeated ids are packed like all others.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicate removal", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack),
]

#: SQL has no zstandard ratios, no tokenizer and no greedy packing; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
