"""Token counts: batch encoding inside Arrow functions, which hand back lengths only.

Texts are gathered into batches of about the same number of bytes; a long text is first split into parts.
Both parts and the words within them are cut where a cut can't change any token, so a batch encodes
each distinct word that it doesn't know yet once, and a text's count is the sum over its words.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.llm.pretokens import BELOW_250
from pricevault.llm.units import unused, without

#: Bytes of text that one call of the tokenizer gets.
BATCH_BYTES = 1 << 20
#: Characters from which on a text is split at the next safe boundary.
PART_CHARS = 1 << 16
#: Tokens of a training window.
TOKEN_LIMIT = 2048

#: Words whose lengths a task remembers; longer ones than that many characters are encoded anew each time.
KNOWN_WORDS, WORD_CHARS = 300_000, 64

#: Visible characters that no normal form joins to a space before them: those below U+0250, all.
LATIN = r"[!-~\xa1-\xac\xae-\u024f]"
VISIBLE = r"[^\s\p{M}\p{C}▁]"


@dataclass
class Counter:
    """A tokenizer file: its batch counting function, and where a text can be cut.

    Cuts lie at a lone space or line break between two visible characters. Tokenizers of .json files
    here either drop white space or begin a piece with it, so it stays with what follows. In .model
    files only the space separates, and each text gets one in front by itself, so it goes.
    """

    count: Callable[[list[str]], list[int]]
    breaks: str
    taken: int

    def pattern(self, visible: str) -> str:
        gap = f"(?={self.breaks}{visible})" if not self.taken else f"{self.breaks}(?={visible})"
        return f"(?<={visible}){gap}"

    @cached_property
    def full(self) -> regex.Pattern:
        return regex.compile(self.pattern(VISIBLE), regex.V1)

    @cached_property
    def latin(self) -> re.Pattern:
        return re.compile(self.pattern(LATIN))

    def parts(self, text: str, size: int) -> Iterator[str]:
        """Parts of about ``size`` characters; a text without a safe cut stays whole."""
        at = 0
        while len(text) - at > size:
            found = self.full.search(text, at + size)
            if not found:
                break
            yield text[at : found.start()]
            at = found.end()
        yield text[at:]

    def words(self, part: str) -> list[str]:
        return (self.latin if BELOW_250.fullmatch(part) else self.full).split(part)


ADDED = ("n_bytes", "n_tokens", "over_limit")


@lru_cache
def counter(path: str) -> Counter:
    """The counter of a tokenizer file, loaded once a worker."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return Counter(lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], " ", 1)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    import tokenizers

    file = tokenizers.Tokenizer.from_file(path)
    file.no_truncation()
    file.no_padding()
    return Counter(lambda texts: [len(x) for x in file.encode_batch_fast(texts, add_special_tokens=False)], "[ \n]", 0)


def _counter(path: str, limit: int, batch_bytes: int, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = counter(path), {}

        def counts(parts: list[str]) -> list[int]:
            words = [tokenizer.words(part) for part in parts]
            missing = list(set().union(*words) - known.keys())
            if len(known) + len(missing) > KNOWN_WORDS:
                known.clear()
                missing = list(set().union(*words))
            known.update(zip(missing, tokenizer.count(missing), strict=True))
            found = [sum(map(known.__getitem__, part)) for part in words]
            for word in missing:
                if len(word) > WORD_CHARS:
                    del known[word]
            return found

        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = pa.compute.binary_length(column).fill_null(0).cast(pa.int64())
            tokens = np.zeros(batch.num_rows, np.int64)
            rows, parts, held = [], [], 0
            for row in np.flatnonzero(sizes.to_numpy()):
                for part in tokenizer.parts(column[row].as_py(), part_chars):
                    rows.append(row)
                    parts.append(part)
                    held += len(part.encode())
                    if held >= batch_bytes:
                        np.add.at(tokens, rows, counts(parts))
                        rows, parts, held = [], [], 0
            if rows:
                np.add.at(tokens, rows, counts(parts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], sizes, pa.array(tokens), pa.array(tokens > limit)], [*batch.schema.names[:-1], *ADDED]
            )

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = TOKEN_LIMIT,
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is the path of a tokenizers (.json) or sentencepiece (.model) file that every
    executor has. Tokens are those of the library's encoding of the whole text without begin, end
    or added special tokens; special strings inside a text are handled as the library's default.
    ``over_limit`` marks more than ``limit`` tokens.

    Null and empty texts have 0 bytes and 0 tokens. Every row is counted by itself: null ids and
    repeated rows stay as they are, and an empty table gives an empty result. Input columns named
    like the added ones are replaced. A text of any length is counted whole; what is in
    memory at once is one part beyond ``batch_bytes``, or one text where it has no safe boundary.
    """
    names = [x for x in without(docs.columns, ADDED) if x.lower() != text_col.lower()]
    slim = docs.select(*[F.col(f"`{x}`") for x in names], F.col(f"`{text_col}`").cast("string").alias(unused(names, "text")))
    schema = T.StructType(
        [docs.schema[x] for x in names]
        + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    )
    return slim.mapInArrow(_counter(tokenizer, limit, batch_bytes, part_chars), schema)
