"""Substring dedup: Rabin-Karp hashes of 13-word windows, merged into removal intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricevault.llm.repeats import cut_repeats

#: Words of a window.
WINDOW_WORDS = 13


def substring_dedup(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word in a window whose words also start in a document with a smaller id.

    Every window of ``window`` consecutive words gets a rolling hash; Spark groups the hashes,
    and the windows of a document that a smaller one holds too merge into maximal intervals,
    which go. See ``repeats.cut_repeats`` for columns and for nulls, empty texts, ties and repeated
    rows: a null or empty text has 0 words; rows with a null id keep all words; rows with equal
    ids never take words from each other; an empty table gives an empty result.
    """
    return cut_repeats(docs, kind="word", size=window, own=False, id_col=id_col, text_col=text_col)
