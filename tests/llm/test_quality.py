"""Quality rules against plain counts."""

from __future__ import annotations

import random
from collections import Counter

import zstandard
from brute import WORD
from pricevault.llm.quality_rules import Bands, quality_rules


SIXTY_FOUR = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"


def counts(text: str | None) -> tuple:
    text = text or ""
    words, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if times[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(covered), failed


def verdict(text: str | None, bands: Bands = Bands()) -> bool:
    data = (text or "").encode()
    if not data:
        return True
    ratio = lambda x: len(x) / len(zstandard.ZstdCompressor(level=3).compress(x))
    low, high = next((a, b) for most, a, b in bands.whole if len(data) < most)
    cuts = list(range(0, len(data), 4096))
    if len(cuts) > 1 and len(data) - cuts[-1] < 1024:
        cuts.pop()
    chunks = [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]
    odd = sum(not bands.chunk[0] <= ratio(x) <= bands.chunk[1] for x in chunks)
    return low <= ratio(data) <= high and (len(chunks) < 2 or odd < len(chunks) / 2)


def test_counts_and_verdicts(spark, sf_dir):
    rng = random.Random(2)
    texts = [None, "", " ", "one", " x y z", "a b c d e f g h " * 5, "é # * " * 40, "same line here\n" * 30, "x" * 300000]
    texts += ["".join(rng.choices(SIXTY_FOUR, k=9000))]
    texts += [" ".join("".join(rng.choices(SIXTY_FOUR, k=40)) for _ in range(400)), "\n".join(" ".join(f"w{rng.randrange(99)}" for _ in range(9)) for _ in range(40))]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    found = quality_rules(frame).orderBy("doc_id").collect()
    for text, row in zip(texts, found, strict=True):
        *plain, failed = counts(text)
        assert [row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed] == [*plain, failed]
        assert row.kept == (not failed and verdict(text))
    assert {r.kept for r in found[9:11]} == {False}


def test_clean_labels_are_kept(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    assert quality_rules(docs.join(labels, "doc_id").where("quality = 1")).where("NOT kept AND NOT base_failed").count() == 0


def test_empty_table(spark):
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []
