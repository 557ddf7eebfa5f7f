"""Byte-level BPE against the tiktoken library, and the exact round trip."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import tiktoken
from pricevault.llm.byte_bpe import bpe_decode, bpe_encode, byte_pairs
from pricevault.llm.pretokens import PieceCache, splitter

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RAW = open(PATH, "rb").read()
TRUTH = tiktoken.Encoding(
    "truth",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())},
    special_tokens={},
)


def texts() -> list[str]:
    rng = random.Random(1)
    bits = ["a", "th", "ing", " ", "\n", "'s", "é", "1", "²", "ß", "中", "\x1c", "\xa0", "​", "🙂", "!", "$$", " \t", "ͅ", "٣", "\0"]
    found = ["", " ", "a" * 3000, "ab" * 700, " " * 999, "<|endoftext|> hi", "don't we'll I'd 's'", " x　y\x85"]
    return found + ["".join(rng.choices(bits, k=rng.randrange(1, 90))) for _ in range(400)]


def test_equals_tiktoken_and_round_trip(spark, sf_dir):
    rows = texts() + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    frame = spark.createDataFrame([*enumerate(rows), (-1, None)], "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded")
    found = bpe_decode(bpe_encode(frame, PATH, public_tokenizers.PATTERN), PATH).collect()
    by_id = {r.doc_id: r for r in found}
    assert by_id[-1].ids == [] and bytes(by_id[-1].decoded) == b""
    for i, text in enumerate(rows):
        assert by_id[i].ids == TRUTH.encode_ordinary(text)
        assert bytes(by_id[i].decoded) == text.encode()


def test_empty_table(spark):
    assert bpe_encode(spark.createDataFrame([], "text string"), PATH, public_tokenizers.PATTERN).collect() == []


def test_long_pieces_use_the_same_merges():
    rng = random.Random(4)
    pairs = byte_pairs(RAW)
    for size in (60, 64, 65, 100, 1000):
        piece = "".join(rng.choices("abcdefgh", k=size))
        ids = np.frombuffer(pairs.encode([piece])[0], "<u4").tolist()
        assert ids == TRUTH.encode_ordinary(piece) == pairs.long_piece(piece.encode())


def test_cache_is_emptied_when_full():
    cache = PieceCache(lambda pieces: [x.encode() for x in pieces], most=3, longest=5)
    assert cache([["a", "b"], ["c", "a"]]) == [b"ab", b"ca"]
    assert cache([["d", "too long"], ["a"]]) == [b"dtoo long", b"a"] and "too long" not in cache.known and len(cache.known) <= 3


def test_split_is_the_pattern():
    split = splitter(public_tokenizers.PATTERN)
    assert split("It's  2 high_α !") == ["It", "'s", " ", " 2", " high", "_", "α", " ", "!"]
