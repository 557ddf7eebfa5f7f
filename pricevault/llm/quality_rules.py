"""Quality rules: word, line and symbol counts, then zstandard compression bands."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.llm.units import mix, split_units, text_slices, without

REPEAT_WORDS = 8
SYMBOLS = b"#*$%&|<>"

COLUMNS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "ratio": pa.float64(),
    "chunks": pa.int64(),
    "odd_chunks": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
}


@dataclass(frozen=True)
class Bands:
    """Limits of bytes / compressed bytes (a whole zstandard frame).

    ``whole`` has (texts of less than so many bytes, least ratio, greatest ratio): short texts
    pay for the frame, long ones profit from what they saw before. A text is cut into chunks of
    ``chunk_bytes`` (a last one of less than a quarter joins the one before it); a text of two or
    more chunks is also rejected if at least ``odd_share`` of them leave the ``chunk`` limits.
    """

    whole: tuple[tuple[float, float, float], ...] = (
        (128, 0.0, 3.0),
        (512, 1.0, 2.8),
        (2048, 1.15, 3.0),
        (8192, 1.3, 3.4),
        (float("inf"), 1.4, 4.2),
    )
    chunk: tuple[float, float] = (1.3, 3.4)
    chunk_bytes: int = 4096
    odd_share: float = 0.5
    level: int = 3

    def limits(self, size: int) -> tuple[float, float]:
        return next((low, high) for most, low, high in self.whole if size < most)


def _sums(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _counts(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    words = split_units(texts, "word")
    raw = np.frombuffer(words.data, np.uint8)
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    chars = _sums(((raw & 0xC0) != 0x80) & ~space, bounds)
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    symbols = _sums(table[raw], bounds)
    dup_lines = []
    for text in texts:
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        dup_lines.append(len(lines) - len(set(lines)))
    hashes, at = words.windows(REPEAT_WORDS)
    keys = mix(hashes + mix(words.owner[at].astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys) + 1, bool)
    found[:-1][order[1:]] |= same
    found[:-1][order[:-1]] |= same
    first = at[found[:-1]]
    edge = np.zeros(len(words.hashes) + 1, np.int32)
    edge[first] += 1
    edge[first + REPEAT_WORDS] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    repeats = np.bincount(words.owner[covered], minlength=len(texts))
    return words.count, chars, symbols, np.array(dup_lines, np.int64), repeats


def _packed(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, bool]:
    """Ratio of the whole text, chunks, chunks out of their band, and whether all limits hold."""
    if not text:
        return None, 0, 0, True
    ratio = len(text) / len(packer.compress(text))
    low, high = bands.limits(len(text))
    cuts = list(range(0, len(text), bands.chunk_bytes))
    if len(cuts) > 1 and len(text) - cuts[-1] < bands.chunk_bytes // 4:
        cuts.pop()
    odd = 0
    if len(cuts) > 1:
        for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True):
            share = (b - a) / len(packer.compress(text[a:b]))
            odd += not bands.chunk[0] <= share <= bands.chunk[1]
    fine = low <= ratio <= high and (len(cuts) < 2 or odd < bands.odd_share * len(cuts))
    return ratio, len(cuts), odd, fine


def _judge(names: list[str], text: str, bands: Bands, prefix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(batch.schema.names.index(text))):
                n_words, chars, symbols, lines, repeats = _counts(texts)
                ratios, chunks, odd, fine = zip(*(_packed(x, bands, packer) for x in texts), strict=True)
                failed = (n_words < 20) | (100 * repeats > 30 * n_words)
                found = (n_words, chars, symbols, lines, repeats, ratios, chunks, odd, failed, np.array(fine) & ~failed)
                part = batch.slice(a, b - a)
                columns = [part.column(i) for i in range(len(names))]
                columns += [pa.array(x, t) for x, t in zip(found, COLUMNS.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [*names, *(prefix + k for k in COLUMNS)])

    return run


def quality_rules(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text", prefix: str = "") -> DataFrame:
    """Each document with its counts and ``kept``: false if it fails the base rules or a band.

    The base rules fail texts of less than 20 words and texts of which over 30 percent of the
    words lie in 8-word windows that the text holds twice or more (windows are compared by a
    64-bit hash). The bands then reject repetitive (ratio too great) and incompressible (too
    small) texts, see ``Bands``. Rows are independent: no shuffle, repeated rows get equal results.
    Null and empty texts have zero counts, a null ratio, and are not kept. Input columns named
    like a result column (``prefix`` and the name) are replaced; an empty table gives an empty result.
    """
    docs = docs.select([F.col(f"`{x}`") for x in without(docs.columns, (prefix + k for k in COLUMNS))])
    kinds = {pa.int64(): T.LongType(), pa.float64(): T.DoubleType(), pa.bool_(): T.BooleanType()}
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + k, kinds[v]) for k, v in COLUMNS.items())])
    return docs.mapInArrow(_judge(docs.columns, text_col, bands, prefix), schema)
