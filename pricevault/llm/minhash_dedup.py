"""Near duplicates by DartMinHash signatures, banded joins and an exact check.

Every occurrence of a five-word shingle is an element region of weight one (the count of a
shingle in the text is its weight). Darts fall on a region as a Poisson process along a rank
axis, drawn from the element's own hash, so equal regions of different texts get equal darts. A text keeps
the darts below a rank that yields about k ln k + 2k of them; each dart has one of k
coordinates, and the earliest dart of each coordinate is the signature. A text with an empty
coordinate doubles its rank. Two texts agree in a coordinate with a probability that is
their weighted Jaccard similarity.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricevault.llm.components import components
from pricevault.llm.stored import stored
from pricevault.llm.units import MASK, mix, split_units, text_slices

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 30 bands of 5 coordinates: a pair at similarity 0.8 shares no band with probability 7e-6.
BANDS, ROWS = 30, 5

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(texts: list[bytes], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash and count, ordered by text and hash.

    A text of fewer words has one shingle, all its words; a text of no words has none.
    """
    units = split_units(texts, "word")
    hashes, at = units.windows(words)
    parts = [(units.owner[at], hashes)]
    for n in range(1, words):
        if (units.count == n).any():
            hashes, at = units.windows(n)
            mine = units.count[units.owner[at]] == n
            parts.append((units.owner[at][mine], mix(hashes[mine] + np.uint64(n))))
    owner, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def _throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, rank and hash of all darts up to each owner's greatest rank."""
    regions = np.ceil(weights).astype(np.int64)
    level = np.arange(regions.sum()) - np.repeat(np.cumsum(regions) - regions, regions)
    owner, room = np.repeat(owner, regions), np.repeat(weights, regions) - level
    seed = mix(np.repeat(elements, regions) + level.astype(np.uint64) * GOLDEN)
    rank, found, step = np.zeros(len(seed)), [], 0
    while len(seed):
        step += 1
        draw = mix(seed + np.uint64(step * int(GOLDEN) & MASK))
        rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)
        low = rank <= most[owner]
        seed, rank, owner, room, draw = seed[low], rank[low], owner[low], room[low], draw[low]
        dart = mix(draw ^ GOLDEN)
        inside = (dart >> np.uint64(40)) / 2.0**24 <= room  # where in its region, for weights that end inside
        found.append((owner[inside], rank[inside], dart[inside]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (owner, rank, seed)


def dart_signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int, k: int) -> np.ndarray:
    """A row of k dart hashes for each text; rows of texts without elements are zero."""
    signs = np.zeros((texts, k), np.uint64)
    total = np.bincount(owner, weights, texts)
    most = (k * math.log(k) + 2 * k) / np.maximum(total, 1e-12)
    todo = total > 0
    while todo.any():
        mine = todo[owner]
        who, rank, dart = _throw(elements[mine], weights[mine], owner[mine], most)
        cell = who * k + (mix(dart) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((rank, cell))
        cell = cell[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        filled = np.bincount(cell[first] // k, minlength=texts)
        signs.reshape(-1)[cell[first]] = dart[order[first]]
        todo &= filled < k
        most = most * 2
    return signs


def _signer(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                owner, elements, weights = weighted_shingles(texts)
                signs = dart_signatures(owner, elements, weights.astype(np.float64), len(texts), bands * rows)
                keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(texts), 1))
                for j in range(rows):
                    keys = mix(keys * GOLDEN + signs[:, j::rows])
                some = np.bincount(owner, minlength=len(texts)) > 0
                ends = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(keys[some].reshape(-1).view(np.int64)))
                copies = pa.array([hashlib.md5(x).digest() for x in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), copies, lists], ["doc_id", "copy_key", "bands"])

    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each text, with its weight and that of the whole text."""
    for batch in batches:
        for a, b, texts in text_slices(batch.column(1)):
            owner, elements, weights = weighted_shingles(texts)
            total = np.bincount(owner, weights, len(texts)).astype(np.int64)
            ids = batch.column(0).slice(a, b - a).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(total[owner]), pa.array(elements.view(np.int64)), pa.array(weights.astype(np.int64))],
                ["doc_id", "size", "element", "weight"],
            )


def rare_pairs(texts: DataFrame, labels: DataFrame, similarity: float, leaders: DataFrame | None = None) -> DataFrame:
    """Pairs ``a``, ``b`` of texts with unlike labels that can be alike: they share a rare shingle.

    Shingles are ordered by the number of texts that hold them, rarest first. Texts of sizes s <= S at
    similarity t or more have at least t / (1 + t) * (s + S) of their weight in common, which is
    2t / (1 + t) * s or more, and t * S or more. So they share a shingle among the first of
    the smaller one, up to the rest of its weight beyond 2t / (1 + t), and the first of the
    larger one, up to the rest beyond t: if they shared none there, what is left would be too little. Texts that
    differ by more than a ninth in rare shingles, as variants with edits of their own do, do not meet.

    ``leaders`` (``doc_id``, ``leader``, ``similarity``) tells how texts differ from others. Of two texts with a common
    leader, one lacks at least the difference of what they lack of it, and has what no other text has, besides
    the difference of the rest of what they add to it. Pairs whose sum of that is too large for t do not meet either.
    """
    elements = stored(texts.mapInArrow(_elements, "doc_id long, size long, element long, weight long"), "elements")
    counts = elements.groupBy(F.col("element").alias("of")).agg(F.count("*").alias("n"))
    ranked = elements.join(counts, elements["element"] == counts["of"])
    before = Window.partitionBy("doc_id").orderBy("n", "element").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    long, short = 1 - similarity, 1 - 2 * similarity / (1 + similarity)
    ranked = ranked.withColumn("alone", F.sum(F.when(F.col("n") == 1, F.col("weight")).otherwise(0)).over(Window.partitionBy("doc_id")))
    first = ranked.where((F.col("before") <= F.col("size") * long + 1e-9) & (F.col("n") > 1))
    first = first.join(labels.toDF("member", "label"), F.col("doc_id") == F.col("member"))
    if leaders is None:
        first = first.withColumn("facts", F.array().cast("array<struct<leader:long,lacks:double,adds:double>>"))
    else:
        sizes = elements.groupBy(F.col("doc_id").alias("of")).agg(F.first("size").alias("own"))
        of_leader = sizes.select(F.col("of").alias("at"), F.col("own").alias("whole"))
        known = leaders.join(sizes, F.col("doc_id") == F.col("of")).join(of_leader, F.col("leader") == F.col("at"))
        common = F.col("similarity") / (1 + F.col("similarity")) * (F.col("own") + F.col("whole"))
        fact = F.struct("leader", (F.col("whole") - common).alias("lacks"), (F.col("own") - common).alias("adds"))
        known = known.groupBy(F.col("of").alias("whose")).agg(F.collect_set(fact).alias("facts"))  # one for each band at most
        first = first.join(known, F.col("doc_id") == F.col("whose"), "left")
    first = stored(first.select("doc_id", "size", "element", "label", "alone", "facts", (F.col("before") <= F.col("size") * short + 1e-9).alias("short")), "rare")
    small = first.where("short").drop("short")
    large = first.drop("short")
    large = large.toDF(*(f"{c}_2" for c in large.columns))
    most = (F.col("size") + F.col("size_2")) * (1 - similarity) / (1 + similarity) + 1e-6  # of what only one of them has

    def too_far(x: Column, y: Column) -> Column:
        shared = F.least(x["adds"] - F.col("alone"), y["adds"] - F.col("alone_2"))  # of what they add, at most
        apart = x["adds"] + y["adds"] - 2 * F.greatest(shared, F.lit(0.0)) + F.abs(x["lacks"] - y["lacks"])
        return (x["leader"] == y["leader"]) & (apart > most)

    apart = F.coalesce(F.exists("facts", lambda x: F.exists("facts_2", lambda y: too_far(x, y))), F.lit(False))
    ordered = (F.col("size") < F.col("size_2")) | ((F.col("size") == F.col("size_2")) & (F.col("doc_id") < F.col("doc_id_2")))
    near = F.col("size") >= F.col("size_2") * similarity - 1e-9
    met = small.join(large, (small["element"] == large["element_2"]) & (F.col("label") != F.col("label_2")) & ordered & near & ~apart)
    return met.select(F.least("doc_id", "doc_id_2").alias("a"), F.greatest("doc_id", "doc_id_2").alias("b")).distinct()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted Jaccard similarity of the two texts of each pair."""
    for batch in batches:
        start = 0
        sizes = [a + b for a, b in zip(*(pa.compute.binary_length(batch.column(i)).to_pylist() for i in (2, 3)), strict=True)]
        size = 0
        for i, more in enumerate([*sizes, 1 << 40]):
            if i > start and size + more > 1 << 20:
                part = batch.slice(start, i - start)
                texts = [x for pair in zip(*(part.column(j).cast(pa.binary()).to_pylist() for j in (2, 3)), strict=True) for x in pair]
                owner, elements, weights = weighted_shingles(texts)
                total = np.bincount(owner, weights, len(texts)).reshape(-1, 2).sum(axis=1)
                order = np.lexsort((elements, owner >> 1))
                pair, elements, weights = (owner >> 1)[order], elements[order], weights[order]
                same = (pair[1:] == pair[:-1]) & (elements[1:] == elements[:-1])
                both = np.bincount(pair[1:][same], np.minimum(weights[1:], weights[:-1])[same], part.num_rows)
                alike = both / np.maximum(total - both, 1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(alike)], ["a", "b", "similarity"])
                start, size = i, 0
            size += more


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` with their exact similarity."""
    left = texts.toDF("__b", "__text_b")
    right = texts.toDF("__a", "__text_a")
    found = pairs.join(left, pairs["b"] == left["__b"]).select("a", "b", "__text_b")
    found = found.join(right, found["a"] == right["__a"]).select("a", "b", "__text_a", "__text_b")
    return stored(found.mapInArrow(_compare, "a long, b long, similarity double"), "similarity")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: ``doc_id`` and ``class_id``, the least id of its class.

    Classes are the connected components of pairs whose five-word shingles (with counts) have a
    weighted Jaccard similarity of at least ``similarity``. Exact copies are one node.

    Texts that share a band form a bucket. Each is compared with the bucket's leader, exactly, on
    the texts. The leader is the document that shares its bands with the most others, so variants
    of one text meet that text rather than each other. Documents of buckets that still hold several components
    meet once more by their rare shingles (``rare_pairs``), and those in different components that do are compared
    pair by pair. Nothing alike is left out by it, and a large group of texts that resemble each
    other from afar isn't compared all against all.

    Null texts count as empty; texts without words belong together only if they are equal bytes.
    Rows with a null id get a null class; rows with equal ids get each the class of their text,
    and their texts that are nobody's later copy are one node. Extra columns are not read. An empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    signs = stored(slim.where("doc_id IS NOT NULL").mapInArrow(_signer(bands, rows), "doc_id long, copy_key binary, bands array<long>"), "signs")
    copies = signs.groupBy("copy_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = stored(copies.where("n > 1").select("copy_key", "first"), "copies")
    signs = signs.join(copies, "copy_key", "left").withColumn("first", F.coalesce("first", "doc_id"))
    nodes = stored(signs.select("doc_id", "first", F.when(F.col("doc_id") == F.col("first"), F.col("bands")).alias("bands")), "nodes")
    member = nodes.select("doc_id", F.explode("bands").alias("bucket")).distinct()
    sizes = stored(member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = stored(member.join(sizes, "bucket"), "shared")
    weight = shared.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    shared = stored(shared.join(weight, "doc_id").select("bucket", "doc_id", "weight"), "weighed")
    best = F.max(F.struct("weight", (-F.col("doc_id")).alias("id")))["id"]
    leaders = stored(shared.groupBy("bucket").agg((-best).alias("leader")), "leaders")
    starred = stored(shared.join(leaders, "bucket").select("bucket", "doc_id", "leader"), "buckets")
    texts = slim.select("doc_id", "text")
    pairs = starred.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct()
    near = _verified(pairs, texts).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    linked = near.where(F.col("similarity") >= similarity)
    edges = linked.select("a", "b")
    labels = components(edges)

    placed = starred.join(labels, starred["doc_id"] == labels["node"], "left")
    placed = stored(placed.select("bucket", "doc_id", F.coalesce("label", "doc_id").alias("label")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
    rest = stored(placed.join(mixed, "bucket").select("doc_id", "label").distinct(), "rest")
    again = texts.join(rest.select(F.col("doc_id").alias("__id")), F.col("doc_id") == F.col("__id"), "left_semi")
    known = near.select(F.col("b").alias("doc_id"), F.col("a").alias("leader"), "similarity")
    known = known.union(near.select("a", "a", F.lit(1.0)).distinct())
    across = stored(rare_pairs(again, rest, similarity, known), "across")
    if not across.isEmpty():
        more = _verified(across, texts).where(F.col("similarity") >= similarity)
        labels = components(edges.union(more.select("a", "b")))
    found = nodes.select("doc_id", "first").join(labels, nodes["first"] == labels["node"], "left")
    found = found.select("doc_id", F.coalesce("label", "first").alias("class_id"))
    nameless = slim.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return found.union(nameless)
