"""Approximate nearest neighbours by a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample, every row is put into a leaf, and a query takes leaves
from a priority queue of centroid distances. How many leaves all queries visit is calibrated:
a bounded set of queries is answered by brute force over all rows, and visits are widened until
their true neighbours' leaves reach the wanted recall. Largest inner products become smallest
distances by one more coordinate that lifts every row to the length of the longest.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricevault.llm.stored import stored


@dataclass(frozen=True)
class Settings:
    """Tree and search parameters; ``sample`` and ``probes`` bound what comes to the driver."""

    sample: int = 20_000
    probes: int = 150
    branching: int = 16
    recall: float = 0.98
    block: int = 2000  # rows, and queries, of one unit of work
    seed: int = 1


@dataclass
class Tree:
    """Centroids of all nodes, children of each (empty: a leaf), and leaf numbers."""

    centroids: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    longest: float
    leaves: int = field(default=0)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
        return np.hstack([scaled, rest[:, None]])

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each row, going down to the nearest child."""
        points = self.lifted(vectors)
        found, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                found[rows] = self.leaf[node]
            elif len(rows):
                near = _nearest(points[rows], self.centroids[self.children[node]])
                todo += [(child, rows[near == i]) for i, child in enumerate(self.children[node])]
        return found

    def visits(self, queries: np.ndarray, most: int) -> list[list[int]]:
        """The first ``most`` leaves of each query, best bin first."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        far = -(unit @ self.centroids[:, :-1].T) * 2 + np.einsum("ij,ij->i", self.centroids, self.centroids)
        found = []
        for row in far:
            queue, leaves = [(0.0, 0)], []
            while queue and len(leaves) < most:
                _, node = heapq.heappop(queue)
                if self.children[node]:
                    for child in self.children[node]:
                        heapq.heappush(queue, (row[child], child))
                else:
                    leaves.append(self.leaf[node])
            found.append(leaves)
        return found


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin(np.einsum("ij,ij->i", centroids, centroids) - 2 * points @ centroids.T, axis=1)


def fit_tree(sample: np.ndarray, longest: float, leaves: int, settings: Settings) -> Tree:
    """Split the largest leaf by k-means until there are about ``leaves``."""
    rng = np.random.default_rng(settings.seed)
    tree = Tree(np.zeros((0, sample.shape[1] + 1)), [[]], [0], longest)
    points = tree.lifted(sample)
    centroids, members = [points.mean(axis=0)], {0: np.arange(len(points))}
    heap, count = [(-len(points), 0)], 1
    while heap and count < leaves:
        size, node = heapq.heappop(heap)
        mine = points[members[node]]
        k = min(settings.branching, leaves - count + 1)
        distinct = np.unique(mine, axis=0) if -size < 50 * settings.branching else mine
        if len(distinct) < 2 * k:
            continue
        centers = distinct[rng.choice(len(distinct), k, replace=False)]
        for _ in range(8):
            near = _nearest(mine, centers)
            counts = np.bincount(near, minlength=k)
            sums = np.zeros_like(centers)
            np.add.at(sums, near, mine)
            centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        near = _nearest(mine, centers)
        filled = np.flatnonzero(np.bincount(near, minlength=k))
        if len(filled) < 2:
            continue
        for i in filled:
            child = len(centroids)
            centroids.append(centers[i])
            tree.children.append([])
            tree.children[node].append(child)
            members[child] = members[node][near == i]
            heapq.heappush(heap, (-len(members[child]), child))
        del members[node]
        count += len(filled) - 1
    tree.centroids, tree.leaf = np.array(centroids), [0] * len(centroids)
    for node, below in enumerate(tree.children):
        if not below:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
    return tree


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, each summed in the order of coordinates, so equal rows get equal sums."""
    total = np.zeros((len(queries), len(rows)))
    for j in range(rows.shape[1]):
        total += np.multiply.outer(queries[:, j], rows[:, j])
    return total


def _top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each query's k best, ties to the smaller id, itself left out."""
    scores[ids[None, :] == own[:, None]] = -np.inf
    if scores.shape[1] > 4 * k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        row, column = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
    else:
        row, column = np.nonzero(scores > -np.inf)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _scored(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query position, row position and score of each query's k best, in bounded blocks."""
    found = []
    step = max(1, 4_000_000 // max(1, len(rows)))
    for a in range(0, len(queries), step):
        scores = inner_products(queries[a : a + step], rows)
        row, column = _top(scores, ids, own[a : a + step], k)
        found.append((row + a, column, scores[row, column]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def usable(vector: Column) -> Column:
    """Not null, not zero, and free of null and non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _best(found: DataFrame, k: int) -> DataFrame:
    return (
        found.selectExpr("query_id", "vec_id", "score", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank")
        .where(F.col("rank") <= k)
    )


def nearest_neighbours(
    table: DataFrame, queries: Column, k: int = 20, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest rows of each query: query_id, rank, vec_id, score (inner product in double).

    ``queries`` is a condition on ``vec_id`` that picks the queries among the rows; a row is not
    its own neighbour. Every usable row is indexed; the tree alone is fitted on about
    ``settings.sample`` rows. Leaves and query lists of any size are cut into blocks, so no
    leaf, however hot, is one task. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do those whose length is not the most frequent one, nor rows
    with a null id; ids are taken to be distinct. No usable rows give an empty result.
    """
    spark = table.sparkSession
    vectors = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    lengths = vectors.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max(norm).alias("norm"))
    first = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not first:
        return spark.createDataFrame([], schema)
    size, total, longest = first["size"], first["n"], math.sqrt(first["norm"])
    vectors = vectors.where(F.size("vector") == size)

    share = min(1.0, settings.sample / total)
    sampled = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("vector")
    sample = _matrix(sampled.toArrow().column(0).combine_chunks(), size)
    leaves = max(1, min(total // 20, max(256, math.isqrt(total) // 4), len(sample) // 5))
    tree = fit_tree(sample, longest, leaves, settings) if len(sample) else Tree(np.zeros((1, size + 1)), [[]], [0], longest, 1)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(_matrix(batch.column(1), size)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], ["vec_id", "vector", "leaf"])

    index = stored(vectors.mapInArrow(place, "vec_id long, vector array<double>, leaf long"), "vectors")
    asked = index.where(queries)

    visits = tree.leaves
    probes = asked.orderBy(F.xxhash64("vec_id")).limit(settings.probes).select("vec_id", "vector").toArrow()
    if probes.num_rows and tree.leaves > 1:
        probe_ids, probe_vectors = probes.column(0).to_numpy(), _matrix(probes.column(1).combine_chunks(), size)

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    ids, leaf = (batch.column(i).to_numpy() for i in (0, 2))
                    row, column, score = _scored(probe_vectors, probe_ids, _matrix(batch.column(1), size), ids, k)
                    arrays = [pa.array(x) for x in (probe_ids[row], ids[column], score, leaf[column])]
                    yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score", "leaf"])

        near = index.mapInArrow(exact, "query_id long, vec_id long, score double, leaf long")
        near = near.selectExpr("*", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank").where(F.col("rank") <= k)
        truth: dict[int, list[int]] = {}
        for row in near.select("query_id", "leaf").collect():  # k rows for each probe
            truth.setdefault(row["query_id"], []).append(row["leaf"])
        orders = tree.visits(probe_vectors, tree.leaves)
        waits = [order.index(leaf) for i, order in zip(probe_ids, orders, strict=True) for leaf in truth.get(int(i), [])]
        while_widening = np.sort(waits) if waits else np.zeros(1, int)
        visits = int(while_widening[min(len(while_widening) - 1, math.ceil(settings.recall * len(while_widening)) - 1)]) + 1

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = shared.value.visits(_matrix(batch.column(1), size), visits)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], ["query_id", "query", "leaf"])

    tours = asked.select("vec_id", "vector").mapInArrow(choose, "query_id long, query array<double>, leaf array<long>")
    tours = stored(tours.withColumn("leaf", F.explode("leaf")), "tours")
    cells = index.groupBy("leaf").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"))
    calls = tours.groupBy("leaf").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("turns"))
    cells = F.broadcast(cells.join(calls, "leaf"))  # a row for each leaf, and leaves are bounded by the sample
    rows = index.join(cells, "leaf").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    rows = rows.select("leaf", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"), "turn", "vec_id", "vector")
    calls = tours.join(cells, "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    calls = calls.select("leaf", "part", F.pmod(F.xxhash64("query_id"), "turns").cast("int").alias("turn"), "query_id", "query")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, ids = (x.column(name).to_numpy() for x, name in ((left, "query_id"), (right, "vec_id")))
        row, column, score = _scored(
            _matrix(left.column("query").combine_chunks(), size), own, _matrix(right.column("vector").combine_chunks(), size), ids, k
        )
        return pa.table({"query_id": own[row], "vec_id": ids[column], "score": score})

    keys = ("leaf", "part", "turn")
    found = calls.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
