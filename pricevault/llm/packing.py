"""Lexical retrieval packing: documents that a BM25 index finds alike share a sequence.

Documents become token ids once, in a stored table. Document frequencies of all ids over the
whole table give the BM25 weights; there are no more of them than the vocabulary has ids. Documents are dealt to
shards of bounded size by likeness: random projections of their BM25 vectors go down a tree of
two-means cuts, fitted on a sample that grows with the number of shards, so documents of like
terms meet however large the input is. A shard builds an inverted index of its documents, takes seed
after seed, and fills the seed's window with the unused documents that score best for all its
terms, as long as any scores. Whole windows of a long document stand alone, and the rest of it is
placed by the likeness of the whole text. A document that does not fit is cut only to fill what is left; its rest is
the next seed, so windows are full. The rest of a shard's last window is cut into powers of two and
needs no padding.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricevault.llm.flat_pieces import BLANKS, PATTERN, PieceTable
from pricevault.llm.pretokens import BELOW_250, PieceCache, splitter
from pricevault.llm.stored import stored
from pricevault.llm.units import text_slices

#: Tokens of a shard, on average; what a task holds at once.
SHARD_TOKENS = 3_000_000
#: Neighbours that are ranked at a time.
NEIGHBOURS = 64
#: Numbers of a document's projection, and sampled documents of a shard (all shards: at least LEAST_SAMPLE).
DIMENSIONS, SHARD_SAMPLE, LEAST_SAMPLE = 64, 64, 4000
#: A term has a dense row if more than one in so many documents of a shard hold it; numbers of all such rows (64 MB).
DENSE_SHARE, DENSE_NUMBERS = 8, 1 << 23
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def merge_ranks(definition: dict) -> dict[bytes, int] | None:
    """Bytes and ids of a plain byte-level BPE vocabulary whose merges come in the order of their ids."""
    model, before = definition["model"], definition.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    if model["type"] != "BPE" or not plain or definition.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    merged = [model["vocab"]["".join(x if isinstance(x, list) else x.split(" "))] for x in model["merges"]]
    if merged != sorted(set(merged)):
        return None
    # Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on.
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spelled = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - printable))}
    added = {token["content"] for token in definition.get("added_tokens", ())}
    return {bytes(spelled[c] for c in token): i for token, i in model["vocab"].items() if token not in added}


class Ids:
    """Token ids of texts as little-endian uint32, with the pieces' ids kept in memory.

    The tokenizer splits texts by ``pattern`` before it merges, so equal pieces have equal ids; a
    text that holds one of the tokenizer's added tokens is given to it whole. Where the ids of a
    byte-level vocabulary follow the order of its merges, they are ranks, and the pieces are
    merged by tiktoken, which then finds the same ids several times faster.
    """

    def __init__(self, definition: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(definition)
        self.split = splitter(pattern)
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        ranks = merge_ranks(json.loads(definition))
        self.ranked = ranks and tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache = PieceCache(self.pieces)
        self.table = PieceTable(self.flat) if pattern == PATTERN else None

    def pieces(self, texts: list[str]) -> list[bytes]:
        if not self.ranked:
            return self.encode(texts)
        return [array("I", self.ranked.encode_ordinary(x)).tobytes() for x in texts]

    def flat(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has.

        A line break parts words and is a piece by itself, so words are merged in one call.
        """
        if not self.ranked or any(x.endswith(BLANKS) for x in pieces):
            found = self.pieces([x.decode() for x in pieces])
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found])
        found = np.array(self.ranked.encode_ordinary(b"\n".join(pieces).decode()), np.uint32)
        between = found == self.ranked.encode_single_token("\n")
        return found[~between], np.diff(np.flatnonzero(between), prepend=-1, append=len(found)) - 1

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain = [not any(token in text for token in self.added) for text in texts]
        latin = [self.table is not None and simple and "\0" not in x and bool(BELOW_250.fullmatch(x)) for x, simple in zip(texts, plain, strict=True)]
        flat = iter(self.table([x for x, low in zip(texts, latin, strict=True) if low]) if any(latin) else ())
        known = iter(self.cache([self.split(x) for x, simple, low in zip(texts, plain, latin, strict=True) if simple and not low]))
        kinds = zip(texts, plain, latin, strict=True)
        return [next(flat) if low else next(known) if simple else self.encode([x])[0] for x, simple, low in kinds]


@lru_cache(maxsize=2)
def ids_of(definition: str, pattern: str) -> Ids:
    return Ids(definition, pattern)


def tokens(docs: DataFrame, definition: str, pattern: str, end_id: int, width: str) -> DataFrame:
    """``doc_id``, ``n`` and ``ids`` (numbers of ``width``) of each document, ``end_id`` last."""
    shared = docs.sparkSession.sparkContext.broadcast((definition, pattern))
    end = np.array([end_id], width).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(*shared.value)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                found = [np.frombuffer(x, "<u4").astype(width).tobytes() + end for x in ids([x.decode() for x in texts])]
                sizes = pa.array([len(x) // len(end) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), sizes, pa.array(found, pa.binary())], ["doc_id", "n", "ids"]
                )

    return docs.mapInArrow(run, "doc_id long, n long, ids binary")


def document_frequencies(table: DataFrame, vocabulary: int, width: str) -> np.ndarray:
    """How many documents hold each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                total[_terms(np.frombuffer(ids, width))[0]] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "df"])

    counts = table.select("ids").mapInArrow(run, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    found = np.zeros(vocabulary, np.int64)
    found[counts.column("id").to_numpy()] = counts.column("df").to_numpy()
    return found


def _terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a text, ascending, and how often each occurs."""
    ordered = np.sort(ids, kind="stable")
    if not len(ordered):
        return ordered, np.empty(0, np.int64)
    first = np.flatnonzero(ordered[1:] != ordered[:-1])
    first += 1
    often = np.empty(len(first) + 1, np.int64)
    often[0], often[1:-1], often[-1] = (first[0], first[1:] - first[:-1], len(ordered) - first[-1]) if len(first) else (len(ordered), 0, len(ordered))
    return np.append(ordered[:1], ordered[first]), often


@lru_cache(maxsize=1)
def _axes(vocabulary: int) -> np.ndarray:
    return np.random.default_rng(1).standard_normal((vocabulary, DIMENSIONS), np.float32)


def projections(texts: list[np.ndarray], weights: np.ndarray, average: float) -> np.ndarray:
    """Random projections of the texts' BM25 weights, of length 1 (0 where no term has weight)."""
    axes, out = _axes(len(weights)), np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, ids in enumerate(texts):
        terms, tf = _terms(ids)
        scores = weights[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / average))
        out[i] = scores.astype(np.float32) @ axes[terms]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _cut(vectors: np.ndarray, sizes: np.ndarray, least: float) -> tuple[np.ndarray, float] | None:
    """A direction and a value on it that part the texts in two, with ``least`` tokens on each side."""
    middle = vectors.mean(axis=0)
    direction = np.linalg.eigh((vectors - middle).T @ (vectors - middle))[1][:, -1]
    value = float(direction @ middle)
    for _ in range(8):  # two means
        right = vectors @ direction > value
        if right.all() or not right.any():
            break
        a, b = vectors[~right].mean(axis=0), vectors[right].mean(axis=0)
        direction, value = b - a, float((b - a) @ (a + b)) / 2
    along = vectors @ direction
    right = sizes[along > value].sum()
    if min(right, sizes.sum() - right) >= least:
        return direction, value
    order = np.argsort(along, kind="stable")
    along, before = along[order], np.cumsum(sizes[order])[:-1]
    smaller = np.minimum(before, sizes.sum() - before) * (np.diff(along) > 1e-6)
    if not len(smaller) or smaller.max() < least:
        return None  # copies for the most part
    at = int(smaller.argmax())
    return direction, float(along[at] + along[at + 1]) / 2


def likeness_tree(vectors: np.ndarray, sizes: np.ndarray, limit: float) -> list[tuple]:
    """Nodes (direction, value, left, right), or leaves (None, first shard, shards, 0) of about ``limit`` tokens a shard.

    What no cut can part is dealt over several shards.
    """
    vectors, nodes, shards, todo = vectors.astype(np.float64), [], 0, [(np.arange(len(sizes)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        if parent is not None:
            parent[side] = len(nodes)
        total = sizes[rows].sum()
        found = _cut(vectors[rows], sizes[rows], limit / 4) if total > 1.5 * limit else None
        if found is None:
            count = max(1, round(total / limit))
            nodes.append([None, shards, count, 0])
            shards += count
            continue
        node = [*found, 0, 0]
        nodes.append(node)
        right = vectors[rows] @ found[0] > found[1]
        todo += [(rows[right], node, 3), (rows[~right], node, 2)]
    return [tuple(x) for x in nodes]


def _leaves(tree: list[tuple], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard, and number of shards, of each vector's leaf."""
    first, count = np.zeros(len(vectors), np.int64), np.ones(len(vectors), np.int64)
    vectors, todo = vectors.astype(np.float64), [(0, np.arange(len(vectors)))]
    while todo:
        at, rows = todo.pop()
        direction, value, left, right = tree[at]
        if direction is None:
            first[rows], count[rows] = value, left
        elif len(rows):
            over = vectors[rows] @ direction > value
            todo += [(left, rows[~over]), (right, rows[over])]
    return first, count


def dealt(table: DataFrame, weights: np.ndarray, average: float, tokens: int, docs: int, width: str) -> DataFrame:
    """``shard``, ``doc_id`` and ``ids`` of each document; like documents share a shard."""
    if tokens <= SHARD_TOKENS:
        return table.select(F.lit(0).cast("long").alias("shard"), "doc_id", "ids")
    mixed = F.xxhash64("doc_id", F.crc32("ids"))
    wanted = max(LEAST_SAMPLE, SHARD_SAMPLE * -(-tokens // SHARD_TOKENS))
    sample = table.where(F.pmod(F.xxhash64(mixed), F.lit(1 << 20)) < min(1 << 20, -(-(wanted << 20) // docs)))
    shared = table.sparkSession.sparkContext.broadcast((weights, average))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(x, width) for x in batch.column(0).to_pylist()]
            vectors = [x.tobytes() for x in projections(texts, *shared.value)]
            yield pa.RecordBatch.from_arrays([pa.array(vectors, pa.binary()), batch.column(1)], ["vector", "n"])

    found = sample.select("ids", "n").mapInArrow(project, "vector binary, n long").toArrow()
    vectors = np.frombuffer(b"".join(found.column("vector").to_pylist()), np.float32).reshape(-1, DIMENSIONS)
    sizes = found.column("n").to_numpy().astype(np.float64)
    tree = table.sparkSession.sparkContext.broadcast(likeness_tree(vectors, sizes, SHARD_TOKENS * sizes.sum() / tokens))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(x, width) for x in batch.column(1).to_pylist()]
            first, count = _leaves(tree.value, projections(texts, *shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first), pa.array(count)], ["doc_id", "ids", "first", "count"])

    placed = table.select("doc_id", "ids").mapInArrow(place, "doc_id long, ids binary, first long, count long")
    return placed.select((F.col("first") + F.pmod(mixed, F.col("count"))).alias("shard"), "doc_id", "ids")


class Index:
    """Inverted index of a shard: for each term, its documents and their BM25 weights.

    Terms that many documents hold have a row of a dense matrix too, which is added as a whole.
    """

    def __init__(self, texts: list[np.ndarray], weights: np.ndarray, average: float):
        lengths, vocabulary = np.array([len(x) for x in texts], np.int64), len(weights)
        held = np.repeat(np.arange(len(texts)) * vocabulary, lengths)
        held += np.concatenate(texts)
        held.sort()
        first = np.flatnonzero(np.diff(held, prepend=-1))
        tf = np.diff(first, append=len(held))
        owner, self.terms = np.divmod(held[first], vocabulary)
        del held, first
        self.first = np.searchsorted(owner, np.arange(len(texts) + 1))
        length = lengths[owner] / average
        scores = weights[self.terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))
        order = np.argsort(self.terms, kind="stable")
        self.posted, self.weight = owner[order], scores[order]
        self.bounds = np.searchsorted(self.terms[order], np.arange(vocabulary + 1))
        self.size = len(texts)
        self.live = np.arange(self.size)
        count = np.diff(self.bounds)
        frequent = np.argsort(-count, kind="stable")[: DENSE_NUMBERS // max(1, self.size)]
        frequent = frequent[count[frequent] * DENSE_SHARE > self.size]
        self.row = np.full(vocabulary, -1)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.size))
        for row, term in zip(self.dense, frequent.tolist(), strict=True):
            part = slice(self.bounds[term], self.bounds[term + 1])
            row[self.posted[part]] = self.weight[part]

    def narrow(self, free: np.ndarray) -> None:
        """Drop the documents that are not free from what is searched, once they are a third of it."""
        keep = free[self.live]
        if 3 * np.count_nonzero(keep) > 2 * self.size:
            return
        kept = keep[self.posted]
        self.bounds = np.append(0, np.cumsum(kept))[self.bounds]
        self.posted, self.weight = (np.cumsum(keep) - 1)[self.posted[kept]], self.weight[kept]
        self.dense, self.live = self.dense[:, keep], self.live[keep]
        self.size = len(self.live)

    def score(self, seed: int) -> np.ndarray:
        """BM25 of each searched document for all terms of the seed, which need not be searched itself."""
        terms = self.terms[self.first[seed] : self.first[seed + 1]]
        row = self.row[terms]
        rare = terms[row < 0]
        parts = [slice(a, b) for a, b in zip(self.bounds[rare].tolist(), self.bounds[rare + 1].tolist(), strict=True)]
        total = np.zeros(self.size)
        if parts:
            total += np.bincount(np.concatenate([self.posted[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]), self.size)
        for i in row[row >= 0].tolist():
            np.add(total, self.dense[i], total)
        return total

    def best(self, score: np.ndarray, free: np.ndarray) -> np.ndarray:
        """The free documents of highest score, best first."""
        found = np.flatnonzero((score > 0) & free[self.live])
        if len(found) > NEIGHBOURS:
            found = found[np.argpartition(-score[found], NEIGHBOURS)[:NEIGHBOURS]]
        return self.live[found[np.lexsort((found, -score[found]))]]

    def neighbours(self, seed: int, free: np.ndarray) -> np.ndarray:
        """Free documents that score best for the seed, best first."""
        return self.best(self.score(seed), free)


def fill(texts: list[np.ndarray], index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, end); only the last may not be full.

    ``texts`` are what is to be placed; ``index`` may hold more of each document.
    """
    free = np.array([len(x) > 0 for x in texts])
    sizes = [len(x) for x in texts]
    rest, cursor = None, 0  # the cut document's next piece; the first document that may be free
    while True:
        if rest is None:
            while cursor < len(free) and not free[cursor]:
                cursor += 1
            if cursor == len(free):
                return
            rest = (cursor, 0, sizes[cursor])
            free[cursor] = False
        seed, start, end = rest
        taken, room, rest = [(seed, start, min(end, start + window))], window - (end - start), None
        if room < 0:  # longer than a window
            yield taken
            rest = (seed, start + window, end)
            continue
        if room:
            index.narrow(free)
        spare, score = [], index.score(seed) if room else None
        while room and not spare:
            found = index.best(score, free).tolist()
            if not found:
                break
            for i in found:
                if sizes[i] <= room:
                    taken.append((i, 0, sizes[i]))
                    free[i] = False
                    room -= sizes[i]
                    if not room:
                        break
                else:
                    spare.append(i)
        while room and rest is None:
            if spare:
                i = spare.pop(0)
            else:
                while cursor < len(free) and not free[cursor]:
                    cursor += 1
                if cursor == len(free):
                    break
                i = cursor
            free[i] = False
            part = min(room, sizes[i])
            taken.append((i, 0, part))
            room -= part
            if part < sizes[i]:
                rest = (i, part, sizes[i])
        yield taken


def _powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A window that is not full as windows of powers of two."""
    left = sum(b - a for _, a, b in pieces)
    queue = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            i, a, b = queue.pop(0)
            cut = min(b, a + room)
            out.append((i, a, cut))
            room -= cut - a
            if cut < b:
                queue.insert(0, (i, cut, b))
        yield out


def _packer(shared, window: int, width: str):
    def pack(group: pa.Table) -> pa.Table:
        weights, average = shared.value
        ids, data = group.column("doc_id").to_pylist(), group.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, data[i]))
        texts = [np.frombuffer(data[i], width) for i in order]
        shard = group.column("shard")[0].as_py()
        heads = [len(x) // window * window for x in texts]  # whole windows of long documents stand alone
        tails = [x[h:] for x, h in zip(texts, heads, strict=True)]
        sequences = [[(i, a, a + window)] for i, h in enumerate(heads) for a in range(0, h, window)]
        for pieces in fill(tails, Index(texts, weights, average), window):  # found by the whole text
            moved = [(i, a + heads[i], b + heads[i]) for i, a, b in pieces]
            sequences += [moved] if sum(b - a for _, a, b in moved) == window else _powers(moved)
        columns: list[list] = [[] for _ in range(7)]
        for number, pieces in enumerate(sequences):
            offset = 0
            for i, a, b in pieces:
                row = (ids[order[i]], a, b - a, len(texts[i]), shard << 32 | number, offset, texts[i][a:b].astype("<u4").tobytes())
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += b - a
        names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
        return pa.table({k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in zip(names, columns, strict=True)})

    return pack


def pack_documents(
    docs: DataFrame, tokenizer_path: str, pattern: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    A row for each piece: ``doc_id``, ``start`` in the document's ids, ``length``, ``doc_tokens``
    (its ids with ``end_id``), ``sequence_id``, ``offset`` in the sequence, and ``ids``
    (little-endian uint32). Each id lies in one piece, and each sequence has ``window`` tokens or a power of
    two. The tokenizer file is read on the driver and broadcast (fixed size).

    A null or empty text is ``end_id`` alone. Rows with null or repeated ids are packed like all
    others, each by itself. Extra columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    definition = Path(tokenizer_path).read_text()
    vocabulary = max(len(ids_of(definition, pattern).whole.get_vocab()), end_id + 1)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = stored(tokens(slim, definition, pattern, end_id, width), "tokens")
    total = table.agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")).first()
    frequencies = document_frequencies(table, vocabulary, width)
    weights = np.log(1 + (total["docs"] - frequencies + 0.5) / (frequencies + 0.5))
    weights[end_id] = 0.0
    average = max(1.0, (total["tokens"] or 1) / max(1, total["docs"]))
    shared = spark.sparkContext.broadcast((weights, average))
    shards = dealt(table, weights, average, total["tokens"] or 0, total["docs"], width)
    return shards.groupBy("shard").applyInArrow(_packer(shared, window, width), PIECES)
