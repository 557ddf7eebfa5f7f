"""Token counts against the libraries' encoding of whole texts."""

from __future__ import annotations

import random
from functools import lru_cache

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pricevault.llm.token_counts import count_tokens, counter

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
PARTS = ["a", "B", "é", "é", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "<|endoftext|>", "<|start", "of", "text|>", "1", "中文", "▁", "́"]
PARTS += ["‍", "😀", "İ", "Σ", " ", "\xa0", ".", ",", "ﬁ", "\x00", "\x85", "﻿", "ـ"]


@lru_cache
def loaded(name: str):
    path = public_tokenizers.path(name)
    return sentencepiece.SentencePieceProcessor(model_file=path) if name.endswith(".model") else tokenizers.Tokenizer.from_file(path)


def whole(name: str, text: str) -> int:
    if name.endswith(".model"):
        return len(loaded(name).encode(text))
    return len(loaded(name).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", FILES)
def test_splits_change_no_token(name):
    rng = random.Random(11)
    tokenizer = counter(public_tokenizers.path(name))
    latin = [p for p in PARTS if max(p) < "\u0250"] + ["\xad", "ß", "\x1c", "\r"]
    texts = ["".join(rng.choices(kind, k=300)) for kind in (PARTS + [" ", "\n", "x"] * 4, latin) for _ in range(200)]
    for text, expected in zip(texts, tokenizer.count(texts), strict=True):
        parts = list(tokenizer.parts(text, 12))
        words = [w for part in parts for w in tokenizer.words(part)]
        assert len(words) >= len(parts)
        assert sum(tokenizer.count(parts)) == sum(tokenizer.count(words)) == expected


@pytest.mark.parametrize("name", FILES)
def test_given_documents_equal_the_library(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = public_tokenizers.path(name)
    found = {r.doc_id: r for r in count_tokens(docs, path, batch_bytes=20_000, part_chars=500).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        got = found[r.doc_id]
        n = whole(name, r.text or "")
        assert (got.n_bytes, got.n_tokens, got.over_limit) == (len((r.text or "").encode()), n, n > 2048)


def test_null_empty_long_repeated_and_clashing(spark):
    long = "Lorem ipsum, dolor sit amet 123. " * 20_000
    solid = "中" * 150_000  # no safe boundary
    rows = [(1, None), (2, ""), (None, "a b"), (3, long), (3, long), (4, "<|endoftext|> x"), (5, solid), (6, "word " * 2048), (7, "word " * 2049)]
    frame = spark.createDataFrame([(i, t, 9, 9, "k") for i, t in rows], "doc_id long, text string, n_tokens int, TEXT_ int, other string")
    name = FILES[0]
    found = count_tokens(frame, public_tokenizers.path(name))
    assert found.columns == ["doc_id", "TEXT_", "other", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit, r["TEXT_"]) for r in found.collect())
    want = []
    for i, t in rows:
        n = whole(name, t) if t else 0
        want.append((i or 0, len((t or "").encode()), n, n > 2048, 9))
    assert got == sorted(want)
    assert [x[3] for x in got if x[0] in (6, 7)] == [False, True]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(frame, public_tokenizers.path(FILES[0])).collect() == []
