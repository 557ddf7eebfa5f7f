"""Line dedup: windows of three consecutive lines; later occurrences go."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricevault.llm.repeats import cut_repeats

#: Lines of a window.
WINDOW_LINES = 3


def line_dedup(docs: DataFrame, window: int = WINDOW_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove the lines of every overlapping three-line window that occurred before.

    Lines are what lies between ``\\n``, compared byte by byte. Occurrences are ordered by
    (document id, line number); the first stays, the lines that later ones cover are merged and
    go. A repeat further down in the same document is a later occurrence as well. Texts of less
    than three lines are left alone. See ``repeats.cut_repeats`` for columns and for nulls, ties
    and repeated rows: a null text becomes empty; rows with a null id lose only own repeats.
    """
    return cut_repeats(docs, kind="line", size=window, own=True, id_col=id_col, text_col=text_col)
