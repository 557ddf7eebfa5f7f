"""Quality classifier: held-out accuracy and odd inputs."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pricevault.llm import q_model
from pricevault.llm.quality_model import _BYTE, _MIX, GRAMS, Settings, _counted, features, fit, score, train
from pricevault.llm.units import split_units


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = q_model.op9_subword_quality(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 50 and np.mean([r.predicted == r.quality for r in found]) > 0.95


def plain_buckets(text: bytes, bits: int) -> list[int]:
    """The buckets of a text's features, gram by gram."""
    words = [int(h) >> 32 >> (32 - bits) for h in split_units([text], "word").hashes]
    found = words + [0 for a, b in zip(text.split(), text.split()[1:], strict=False) if a == b]
    spaced = bytes(32 if x == 32 or 9 <= x <= 13 else x for x in b"\n" + text + b"\n")
    for n in GRAMS:
        for k in range(len(spaced) - n + 1):
            gram = spaced[k : k + n]
            if 32 in gram[1:-1]:
                continue
            total = sum(int(_BYTE[x]) * 0x01000193**i for i, x in enumerate(gram)) % 2**32
            found.append((total ^ total >> 15) * int(_MIX) % 2**32 >> (32 - bits))
    return found


def test_score_is_the_softmax_of_averaged_vectors(spark):
    """Vectors, weights and biases kept apart and applied text by text give the folded model's scores."""
    settings = Settings(bits=10, size=4, epochs=2)
    texts = [("good fine fine text\n" if i % 2 else "bad\t** ** junk é ") * (1 + i % 5) + str(i) for i in range(30)]
    given = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(30)], pa.int32())], ["text", "label"])
    counted = [r for b in _counted(iter([given]), settings.bits) for r in b.to_pylist()]
    for text, row in zip(texts, counted, strict=True):
        assert dict(zip(row["buckets"], row["counts"], strict=True)) == Counter(plain_buckets(text.encode(), settings.bits))
    vectors, weights, bias = fit([(r["label"], np.array(r["buckets"]), np.array(r["counts"])) for r in counted], settings)
    model = vectors @ (weights[1] - weights[0]), float(bias[1] - bias[0])
    asked = [*texts, "unseen words words here", "x", "", " \n "]
    frame = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    for r in score(frame, model, settings.bits).collect():
        buckets = plain_buckets(r.text.encode(), settings.bits)
        mean = np.mean([vectors[b].astype(float) for b in buckets], axis=0) if buckets else np.zeros(settings.size)
        odds = np.exp(weights.astype(float) @ mean + bias)
        assert abs(r.score - odds[1] / odds.sum()) < 1e-5, r


def test_odd_texts_and_labels(spark):
    docs = spark.createDataFrame([(i, ("good fine text " if i % 2 else "bad ** junk ** ") * 8) for i in range(40)], "id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(99, 1), (1, None), (None, 1)], "id long, label int")
    model = train(docs, labels)
    rows = [(1, "good text", 5), (2, "junk **", 5), (3, "", 5), (4, None, 5), (None, "x" * 50000, 5), (1, "good text", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = [(r.doc_id, r.score) for r in score(frame, model).collect()]
    scores = [s for _, s in found]
    assert all(0 <= s <= 1 for s in scores) and scores[0] > 0.9 > 0.1 > scores[1] and scores[2] == scores[3] and scores[0] == scores[5]
    assert score(frame.limit(0), model).collect() == []


def test_no_labels_score_one_half(spark):
    docs = spark.createDataFrame([(1, "some text")], "id long, text string")
    model = train(docs, spark.createDataFrame([], "id long, label int"))
    assert [r.score for r in score(docs, model).collect()] == [0.5]


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"", b"a", b"ab cd", b" \n x  ", "é ü x x x".encode(), b"word " * 9]
    for i, text in enumerate(texts):
        for (owner, together), (_, alone) in zip(features(texts, 17), features([text], 17), strict=False):
            assert together[owner == i].tolist() == alone.tolist()
