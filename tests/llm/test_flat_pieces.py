"""Flat pieces of many texts against the tokenizer, and packing's index as documents are used."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pricevault.llm import packing
from pricevault.llm.flat_pieces import PATTERN, PieceTable
from pricevault.llm.packing import Ids, Index
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRUTH = Tokenizer.from_file(PATH)
IDS = Ids(Path(PATH).read_text(), public_tokenizers.PATTERN)


def texts() -> list[str]:
    rng = random.Random(3)
    bits = [*"ablmstv'''    \n\t1²ßé!$\"\x85\xa0\x1c\x7fȀɏ", "'s", "'re", "'ll", "'ve", " '", "th", "ing", "'l", "  \n", "Donaudampfschifffahrt"]
    odd = ["", " ", "\n", "'", "'s", "''s", " 's", "\n's", "a's's", "a'", "'llx", "1'd!", "x  ", "é" * 60, "a" * 700, " " * 300, "\xa0\xa0x"]
    return odd + ["".join(rng.choices(bits, k=rng.randrange(1, 60))) for _ in range(3000)]


def truth(text: str) -> list[int]:
    return TRUTH.encode(text, add_special_tokens=False).ids


def found(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def test_flat_pieces_have_the_tokenizers_ids():
    assert public_tokenizers.PATTERN == PATTERN and IDS.table
    for few in (1, 40, 1000):
        rows = texts()
        for i in range(0, len(rows), few):
            assert [found(x) for x in IDS.table(rows[i : i + few])] == [truth(x) for x in rows[i : i + few]]


def test_texts_of_all_kinds_keep_their_order():
    rows = ["one two", "你好 one", "nul \0 here", "a <|endoftext|> b", "", "three", "ɐ four"]
    assert [found(x) for x in IDS(rows)] == [truth(x) for x in rows]


@pytest.mark.parametrize("most", [1, 50])
def test_a_full_table_is_filled_anew(most):
    table, rows = PieceTable(IDS.flat, most=most, room=200), texts()[:400]
    for i in range(0, len(rows), 30):
        assert [found(x) for x in table(rows[i : i + 30])] == [truth(x) for x in rows[i : i + 30]]


def test_new_words_are_merged_in_one_call_and_known_ones_in_none():
    ids, calls = Ids(Path(PATH).read_text(), PATTERN), []

    class Counted:
        encode_single_token = ids.ranked.encode_single_token

        def encode_ordinary(self, text):
            calls.append(text)
            return TRUTH.encode(text, add_special_tokens=False).ids

    ids.ranked = Counted()
    rows = ["alpha beta gamma", "beta delta epsilon"]
    for _ in range(2):
        assert [found(x) for x in ids(rows)] == [truth(x) for x in rows]
    assert len(calls) == 1


@pytest.mark.parametrize("share", [0, 3, 10**6])
def test_scores_stay_as_used_documents_leave_the_index(monkeypatch, share):
    monkeypatch.setattr(packing, "DENSE_SHARE", share)
    rng = random.Random(1)
    rows = [np.array([min(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randrange(0, 30))], "<u2") for _ in range(60)]
    weights, free = np.array([rng.random() for _ in range(40)]), np.ones(60, bool)
    index, whole = Index(rows, weights, 15.0), Index(rows, weights, 15.0)
    assert (len(index.dense) > 0) == (share > 0) and (len(index.dense) < 40 or share != 3)
    for gone in rng.sample(range(60), 55):
        free[gone] = False
        index.narrow(free)
        assert np.allclose(index.score(gone), whole.score(gone)[index.live])
        assert index.neighbours(gone, free).tolist() == whole.neighbours(gone, free).tolist()
    assert index.size < 10 and free[index.live].sum() == 5
