"""DartMinHash near-dedup against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
from brute import near_classes, shingles, similarity
from pricevault.llm.minhash_dedup import dart_signatures, near_duplicates, rare_pairs, weighted_shingles


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def fixture_rows() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows: list[tuple[int | None, str | None]] = []
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((30, 120, 400)))]
        for edits in (0, 0, 1, 2, 4, 8, len(base) // 40, len(base) // 25, len(base) // 3):
            rows.append((len(rows), " ".join(edited(rng, base, edits))))
        if group == 0:  # a chain: each only close to the next
            for _ in range(12):
                base = edited(rng, base, max(1, len(base) // 60))
                rows.append((len(rows), " ".join(base)))
    rows += [(1000, None), (1001, ""), (1002, "one"), (1003, "one"), (1004, "one two"), (1005, " \n"), (1006, "x " * 4000), (1007, "x " * 3990)]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = fixture_rows()
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, class_id int")
    assert {r.doc_id: r.class_id for r in near_duplicates(frame).collect()} == near_classes(rows)


def test_given_documents_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: r.class_id for r in near_duplicates(docs).collect()} == near_classes(rows)


def test_empty_table_null_and_repeated_ids(spark):
    kind = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], kind)).collect() == []
    rows = [(None, "a b c"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (9, None), (8, None)]
    found = sorted(near_duplicates(spark.createDataFrame(rows, kind)).collect(), key=str)
    assert sorted(map(tuple, found), key=str) == sorted([(None, None), (7, 3), (7, 3), (3, 3), (9, 8), (8, 8)], key=str)


def test_signatures_estimate_weighted_similarity():
    a, b = "p q r s t " * 30 + "u v w x y z " * 20, "p q r s t " * 20 + "u v w x y z " * 30
    owner, elements, weights = weighted_shingles([a.encode(), b.encode()])
    signs = dart_signatures(owner, elements, weights.astype(float), 2, 2000)
    truth = similarity(shingles(a), shingles(b))
    assert abs(np.mean(signs[0] == signs[1]) - truth) < 0.05


def test_half_alike_texts_are_not_compared_all_with_all(spark, monkeypatch):
    """Texts with 8 of 200 words changed resemble each other by half: hardly any pair is compared."""
    from pricevault.llm import minhash_dedup

    counts = {}
    kept = minhash_dedup.stored

    def counting(frame, label):
        out = kept(frame, label)
        if label == "across":
            counts[size] = out.count()
        return out

    monkeypatch.setattr(minhash_dedup, "stored", counting)
    rng = random.Random(21)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    for size in (100, 400):
        rows = [(i, " ".join(edited(rng, base, 8))) for i in range(size)]
        found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r.doc_id: r.class_id for r in found.collect()} == near_classes(rows)
    assert counts[400] < 400, counts


def test_rare_pairs_lose_no_alike_pair(spark):
    rng = random.Random(31)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = [(i, " ".join(edited(rng, base[: rng.choice((120, 135, 150))], rng.randrange(9)) + ["x y"] * rng.randrange(8))) for i in range(150)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.a, r.b) for r in rare_pairs(texts, texts.select("doc_id", "doc_id"), 0.8).collect()}
    sets = {i: shingles(t) for i, t in rows}
    alike = {(a, b) for a in sets for b in sets if a < b and similarity(sets[a], sets[b]) >= 0.8}
    assert alike and alike <= found and len(found) < 150 * 149 / 2
    facts = [(i, j, similarity(sets[i], sets[j])) for j in (0, 1, 2) for i in sets if sets[i] != sets[j]] + [(j, j, 1.0) for j in (0, 1, 2)]
    leaders = spark.createDataFrame(facts, "doc_id long, leader long, similarity double")
    fewer = {(r.a, r.b) for r in rare_pairs(texts, texts.select("doc_id", "doc_id"), 0.8, leaders).collect()}
    assert alike <= fewer and len(fewer) < len(found)
