"""Byte-level BPE by a segment tree over byte positions, and its inverse.

A leaf holds the rank of the pair that starts at its byte, an inner node the least
(rank, position) below it, so the root names the leftmost pair of minimum rank. A merge changes
three leaves (the merged pair, its left and right live neighbours), each a logarithmic update.
Short pieces run side by side as one forest in numpy; longer ones use the same tree in a list.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.llm.pretokens import PieceCache, splitter
from pricevault.llm.units import text_slices, without

#: Pieces of up to so many bytes run in the numpy forest.
FOREST_BYTES = 64
#: Pieces of one forest.
FOREST_PIECES = 20_000

NONE = np.int64(1) << 60


class BytePairs:
    """Ranks of a vocabulary file, with encoding of single pieces and decoding of ids."""

    def __init__(self, ranks: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NONE)
        self.values = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], NONE)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, which is the id of the merged token; NONE if there is none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian uint32."""
        found: list[bytes | None] = [None] * len(pieces)
        classes: dict[int, list[tuple[int, bytes]]] = {}
        for i, text in enumerate(pieces):
            piece = text.encode()
            known = self.ranks.get(piece)
            if known is not None:
                found[i] = known.to_bytes(4, "little")
            elif len(piece) > FOREST_BYTES:
                found[i] = np.array(self.long_piece(piece), "<u4").tobytes()
            else:
                classes.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append((i, piece))
        for leaves, members in classes.items():
            for a in range(0, len(members), FOREST_PIECES):
                part = members[a : a + FOREST_PIECES]
                for (i, _), ids in zip(part, self.forest([p for _, p in part], leaves), strict=True):
                    found[i] = ids
        return found

    def forest(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Pieces of at most ``leaves`` bytes (a power of two), all merged in step."""
        count, stride = len(pieces), leaves + 1
        sizes = np.fromiter(map(len, pieces), np.int64, count)
        text = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(count, leaves)
        column = np.arange(leaves)
        inside = column < sizes[:, None]
        ids = np.zeros((count, stride), np.int64)
        ids[:, :leaves] = self.of_byte[text]
        after = np.tile(np.arange(1, stride + 1), (count, 1))  # next live position, ``size`` at the end
        before = np.tile(np.arange(-1, leaves), (count, 1))
        tree = np.full((count, 2 * leaves), NONE)
        rank = self.rank(ids[:, : leaves - 1], ids[:, 1:leaves])
        valid = inside[:, 1:] & (rank < NONE)
        tree[:, leaves : 2 * leaves - 1][valid] = (rank << 8 | column[:-1])[valid]
        level = leaves
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        alive = inside.copy()
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = tree[rows, 1]
            at = best & 255
            gone = after[rows, at]
            right = after[rows, gone]
            ids[rows, at] = best >> 8
            alive[rows, gone] = False
            after[rows, at] = right
            has_right = right < sizes[rows]
            before[rows[has_right], right[has_right]] = at[has_right]
            tree[rows, leaves + gone] = NONE
            rank = self.rank(ids[rows, at], ids[rows, np.minimum(right, leaves)])
            tree[rows, leaves + at] = np.where(has_right & (rank < NONE), rank << 8 | at, NONE)
            left = before[rows, at]
            has_left = left >= 0
            some = rows[has_left]
            rank = self.rank(ids[some, left[has_left]], ids[some, at[has_left]])
            tree[some, leaves + left[has_left]] = np.where(rank < NONE, rank << 8 | left[has_left], NONE)
            row = np.concatenate((rows, rows, some))
            node = np.concatenate((gone, at, left[has_left])) + leaves
            while node[0] > 1:
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            rows = rows[tree[rows, 1] < NONE]
        kept = ids[:, :leaves][alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        return [kept[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)]

    def long_piece(self, piece: bytes) -> list[int]:
        """One piece of any length."""
        size = len(piece)
        leaves = 1 << (size - 1).bit_length()
        ids, pairs = self.of_byte[list(piece)].tolist(), self.pairs
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        none = (1 << 60, 0)
        tree = [none] * (2 * leaves)
        for i in range(size - 1):
            rank = pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[leaves + i] = (rank, i)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = leaves + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        def pair(i: int) -> tuple[int, int]:
            j = after[i]
            rank = pairs.get(ids[i] << 32 | ids[j]) if j < size else None
            return none if rank is None else (rank, i)

        while tree[1] is not none and tree[1][0] < none[0]:
            rank, i = tree[1]
            gone = after[i]
            ids[i], ids[gone], after[i] = rank, None, after[gone]
            if after[i] < size:
                before[after[i]] = i
            put(gone, none)
            put(i, pair(i))
            if before[i] >= 0:
                put(before[i], pair(before[i]))
        return [x for x in ids if x is not None]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def byte_pairs(ranks: bytes) -> BytePairs:
    return BytePairs(ranks)


@lru_cache(maxsize=2)
def piece_cache(ranks: bytes) -> PieceCache:
    return PieceCache(byte_pairs(ranks).encode)


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Each document with ``ids`` (array of int): its whole text in byte-level BPE.

    Each match of the pattern is merged by itself in rank order, without special tokens. The
    rank file is read on the driver and broadcast (fixed size, about 1 MB). Null and empty texts
    have no ids. Rows are independent (no shuffle); repeated rows get equal ids. An input column
    named like ``ids_col`` is replaced.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())
    docs = docs.select([F.col(f"`{x}`") for x in without(docs.columns, [ids_col])])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, split = piece_cache(ranks.value), splitter(pattern)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(names.index(text_col))):
                found = cache([split(x.decode()) for x in texts])
                ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), "<i4")))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), ids], [*names, ids_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def bpe_decode(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Each row with ``decoded`` (binary): the bytes of its ids; empty for null or no ids."""
    ranks = tokens.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())
    tokens = tokens.select([F.col(f"`{x}`") for x in without(tokens.columns, [bytes_col])])
    names = tokens.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks.value)
        for batch in batches:
            lists = batch.column(names.index(ids_col))
            sizes = np.array([x.as_py() or 0 for x in pa.compute.list_value_length(lists)], np.int64)
            ids, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            data = [pairs.decode(ids[e - n : e]) for n, e in zip(sizes, ends, strict=True)]
            columns = [*(batch.column(i) for i in range(len(names))), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, bytes_col])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(bytes_col, T.BinaryType())]))
