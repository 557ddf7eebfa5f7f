"""Quality classifier: supervised subword embeddings, averaged per document.

A document's features are its words, pairs of equal neighbour words, and the byte 3- to 5-grams
of its words with their borders, each hashed to a bucket with a learned vector. The vectors are
averaged and a softmax layer gives the label's probability. Training is plain stochastic
gradient descent in numpy on a bounded sample; scoring folds vectors and softmax
weights into one number for each bucket, which gives the same logits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.llm.units import split_units, text_slices, without

#: Labelled documents that training uses at most (the first by hash of the id).
SAMPLE_DOCS = 6000

GRAMS = (3, 4, 5)
_MIX = np.uint32(0x9E3779B1)
_BYTE = (np.arange(256, dtype=np.uint64) * 0x85EBCA6B % (1 << 32) ^ 0x27D4EB2F).astype(np.uint32) * _MIX


@dataclass(frozen=True)
class Settings:
    """Buckets are 2**bits; the rates (of vectors, softmax weights, biases) fall to 0 over all epochs."""

    bits: int = 17
    size: int = 8
    epochs: int = 5
    rate: float = 30.0
    layer_rate: float = 0.5
    bias_rate: float = 0.02
    seed: int = 1


def features(texts: list[bytes], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and buckets, one pair of arrays for each kind of feature."""
    shift = np.uint32(32 - bits)
    units = split_units(texts, "word")
    words = (units.hashes >> np.uint64(32)).astype(np.uint32)
    yield units.owner, words >> shift
    same = np.flatnonzero((units.hashes[1:] == units.hashes[:-1]) & (units.owner[1:] == units.owner[:-1]))
    yield units.owner[same], np.zeros(len(same), np.uint32)  # bucket 0 is shared by all such pairs
    raw = np.frombuffer(b"\n" + units.data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    codes = _BYTE[np.where(space, np.uint8(32), raw)]
    spaces = np.concatenate(([0], np.cumsum(space, dtype=np.int32)))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), sizes)  # of each byte after the first border
    power, total = np.uint32(1), np.zeros(len(raw), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(raw) < n:
            return
        total = total[: len(raw) - n + 1] + codes[n - 1 :] * power
        power = np.uint32(int(power) * 0x01000193 & 0xFFFFFFFF)
        if n in GRAMS:
            count = len(raw) - n + 1
            at = np.flatnonzero(spaces[n - 1 : n - 1 + count] == spaces[1 : 1 + count])
            mixed = (total[at] ^ (total[at] >> np.uint32(15))) * _MIX
            yield owner[at], mixed >> shift


def _counted(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Label, buckets and counts of each labelled document."""
    for batch in batches:
        for a, b, texts in text_slices(batch.column(0)):
            parts = list(features(texts, bits))
            owner = np.concatenate([x[0] for x in parts]).astype(np.int64)
            keys, counts = np.unique(owner << bits | np.concatenate([x[1] for x in parts]), return_counts=True)
            ends = np.searchsorted(keys >> bits, np.arange(len(texts) + 1)).astype(np.int32)
            buckets = pa.ListArray.from_arrays(ends, pa.array((keys & (1 << bits) - 1).astype(np.int32)))
            amounts = pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), buckets, amounts], ["label", "buckets", "counts"])


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket vectors, softmax weights (two rows) and biases from (label, buckets, counts)."""
    rng = np.random.default_rng(settings.seed)
    vectors = ((rng.random((1 << settings.bits, settings.size)) - 0.5) / settings.size).astype(np.float32)
    weights, bias = np.zeros((2, settings.size), np.float32), np.zeros(2, np.float32)
    shares = [(label, buckets, (counts / counts.sum()).astype(np.float32)) for label, buckets, counts in rows if len(buckets)]
    steps, step = settings.epochs * len(shares), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(shares)):
            label, buckets, share = shares[i]
            slower = 1 - step / steps
            step += 1
            mean = share @ vectors[buckets]
            logits = weights @ mean + bias
            odds = np.exp(logits - logits.max())
            error = -odds / odds.sum()
            error[label] += 1
            back = error @ weights
            weights += settings.layer_rate * slower * np.outer(error, mean)
            bias += settings.bias_rate * slower * error
            vectors[buckets] += settings.rate * slower * share[:, None] * back
    return vectors, weights, bias


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), most: int = SAMPLE_DOCS) -> tuple[np.ndarray, float]:
    """One number for each bucket and a bias: the difference of the two logits.

    ``docs`` has id and text, ``labels`` id and label; labels other than 0 and 1 are left out. At
    most ``most`` labels are used. Their ids are picked first, and that bounded list is broadcast;
    the features of their whole texts are counted in Spark and brought to the driver, so its
    share does not grow with the tables. Without labelled rows the score is 0.5.
    """
    bits = settings.bits
    picked = labels.toDF("id", "label").where("id IS NOT NULL AND label IN (0, 1)").orderBy(F.xxhash64("id"), "id").limit(most)
    sample = docs.toDF("id", "text").join(F.broadcast(picked), "id").select("text", F.col("label").cast("int").alias("label"))
    counted = sample.mapInArrow(lambda x: _counted(x, bits), "label int, buckets array<int>, counts array<int>").toArrow()
    rows = [
        (label.as_py(), buckets.values.to_numpy(), counts.values.to_numpy())
        for label, buckets, counts in zip(*(counted.column(i) for i in range(3)), strict=True)
    ]
    if not rows:
        return np.zeros(1 << bits, np.float32), 0.0
    vectors, weights, bias = fit(rows, settings)
    return vectors @ (weights[1] - weights[0]), float(bias[1] - bias[0])


def score(docs: DataFrame, model: tuple[np.ndarray, float], bits: int = Settings.bits, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Each document with the probability of label 1. The model is broadcast (2**bits numbers).

    Whole texts are read and rows are independent. Null and empty texts have no features, so
    they get what the bias alone says. An input column named like ``score_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select([F.col(f"`{x}`") for x in without(docs.columns, [score_col])])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in batches:
            for a, b, texts in text_slices(batch.column(names.index(text_col))):
                total, count = np.zeros(len(texts)), np.zeros(len(texts))
                for owner, buckets in features(texts, bits):
                    total += np.bincount(owner, table[buckets], len(texts))
                    count += np.bincount(owner, minlength=len(texts))
                found = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), pa.array(found)], [*names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
