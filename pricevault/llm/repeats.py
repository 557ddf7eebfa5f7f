"""Find windows of units that an earlier document holds too, and cut them out.

Each task turns its documents into window hashes, keeps the smallest document of each hash, and
notes at once which of its documents only repeat that one. What remains, one entry for each hash
and task batch, is packed into one row for each hash bucket and shuffled; a bucket compares its
entries and lists the hashes of each document that a smaller document holds. The notes are stored,
then joined to the documents, which are hashed again and cut.

A hot window costs one entry for each task batch, however often it occurs, and buckets hold
about the same number of distinct hashes whatever the data. Equality is that of a 64-bit window
hash within a bucket chosen by a second, independent hash; the number of buckets grows with
the input, so the chance that any two of n different windows meet stays near
n * BUCKET_ENTRIES / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.llm.stored import stored
from pricevault.llm.units import BUCKET_BASE, split_units, text_slices, unused, without

#: Entries (distinct hashes of a task batch) that a bucket holds at about one window a unit.
BUCKET_ENTRIES = 400_000
#: Windows that a task gathers before it packs them.
BATCH_WINDOWS = 1_500_000
#: Average bytes of a unit, to size the buckets.
UNIT_BYTES = {"word": 6, "line": 120}

PACKED = "bucket int, doc_id long, hashes binary, docs binary"
NOTES = "doc_id long, hash long"


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ascending ids: the first, then steps of two bytes, or whole numbers if a step is larger."""
    steps = np.diff(ids)
    if len(steps) and (steps.max() >= 1 << 16 or steps.min() < 0):
        return b"w" + ids.astype("<i8").tobytes()
    return b"s" + ids[:1].astype("<i8").tobytes() + steps.astype("<u2").tobytes()


def _unpack_ids(data: bytes) -> np.ndarray:
    if data[:1] == b"w":
        return np.frombuffer(data, "<i8", offset=1)
    first = np.frombuffer(data, "<i8", 1, 1)
    return np.concatenate((first, first[0] + np.cumsum(np.frombuffer(data, "<u2", offset=9).astype(np.int64))))


def _by_document(ids: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(ids, kind="stable")
    ids, hashes = ids[order], hashes[order]
    cuts = np.flatnonzero(np.diff(ids)) + 1
    for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(ids)])), strict=True):
        if b > a:
            yield int(ids[a]), hashes[a:b].tobytes()


def _smallest(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, id); marks of each hash's first entry; the smallest id beside each entry."""
    order = np.lexsort((ids, hashes))
    sorted_hashes, sorted_ids = hashes[order], ids[order]
    first = np.ones(len(order), bool)
    first[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    least = sorted_ids[np.flatnonzero(first)][np.cumsum(first) - 1] if len(order) else sorted_ids
    return order, first, least


def _packer(kind: str, size: int, buckets: int):
    """Task code: documents to one row for each bucket, plus notes decided inside the batch."""

    def flush(kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, where, ids = (np.concatenate(x) for x in zip(*kept, strict=True))
        order, first, least = _smallest(hashes, ids)
        ids_sorted, hashes_sorted = ids[order], hashes[order]
        new = np.ones(len(order), bool)  # a repeat inside one document is one entry
        new[1:] = (hashes_sorted[1:] != hashes_sorted[:-1]) | (ids_sorted[1:] != ids_sorted[:-1])
        rows = [[], [], [], []]
        late = new & (ids_sorted > least)
        for doc, data in _by_document(ids_sorted[late], hashes_sorted[late]):
            for column, value in zip(rows, (doc % buckets, doc, data, None), strict=True):
                column.append(value)
        firsts = order[first]
        firsts = firsts[np.lexsort((ids[firsts], where[firsts]))]
        cuts = np.searchsorted(where[firsts], np.arange(buckets + 1))
        for bucket in np.flatnonzero(np.diff(cuts)):
            part = firsts[cuts[bucket] : cuts[bucket + 1]]
            for column, value in zip(rows, (int(bucket), None, hashes[part].tobytes(), _pack_ids(ids[part])), strict=True):
                column.append(value)
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(rows, types, strict=True)], ["bucket", "doc_id", "hashes", "docs"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, count = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, texts in text_slices(batch.column(1)):
                units = split_units(texts, kind)
                hashes, at = units.windows(size)
                other, _ = units.windows(size, BUCKET_BASE)
                kept.append((hashes, (other % np.uint64(buckets)).astype(np.int32), ids[a:b][units.owner[at]]))
                count += len(hashes)
                if count >= BATCH_WINDOWS:
                    yield flush(kept)
                    kept, count = [], 0
        if count:
            yield flush(kept)

    return run


def _judge(group: pa.Table) -> pa.Table:
    """One bucket: the hashes of each document that a smaller document holds."""
    found, hashes, ids = [], [], []
    for row in group.select(["doc_id", "hashes", "docs"]).to_pylist():
        data = np.frombuffer(row["hashes"], np.uint64)
        if row["docs"] is None:
            found.append((np.full(len(data), row["doc_id"], np.int64), data))
        else:
            hashes.append(data)
            ids.append(_unpack_ids(row["docs"]))
    if hashes:
        all_hashes, all_ids = np.concatenate(hashes), np.concatenate(ids)
        order, _, least = _smallest(all_hashes, all_ids)
        late = all_ids[order] > least
        found.append((all_ids[order][late], all_hashes[order][late]))
    docs, late = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.table({"doc_id": docs, "hash": late.view(np.int64)})


def _covered(marks: np.ndarray, size: int, count: int) -> np.ndarray:
    """Units that lie in a marked window."""
    edge = np.zeros(count + 1, np.int32)
    edge[marks] += 1
    edge[marks + size] -= 1
    return np.cumsum(edge[:-1]) > 0


def _without_words(data: bytes, begin: np.ndarray, end: np.ndarray, spans: np.ndarray) -> bytes:
    """The text without the words of the spans; all other words keep their lines and indentation.

    ``begin`` and ``end`` are the words' byte ranges. The white space after the removed words goes with
    them if it holds no line break. Where whole lines go, they go up to the next line's start; where a
    line's end goes, its break stays; where the text's end goes, the white space before it goes too.
    """
    kept, at = [], 0
    for first, last in spans:
        start, stop = begin[first], end[last - 1]
        if last == len(begin):
            start = end[first - 1] if first else start
        elif b"\n" not in data[stop : begin[last]]:
            stop = begin[last]
        else:
            line = data.rfind(b"\n", 0, start) + 1
            if not data[line:start].strip():
                start, stop = line, data.rfind(b"\n", stop, begin[last]) + 1
        kept.append(data[at:start])
        at = stop
    return b"".join([*kept, data[at:]])


def _cutter(names: list[str], text: str, kind: str, size: int, own: bool):
    """Task code: documents beside their notes to documents without the noted windows."""

    def cut(texts: list[bytes], notes: list[np.ndarray]) -> Iterator[tuple[bytes, int, int, list]]:
        units = split_units(texts, kind)
        hashes, at = units.windows(size)
        bounds = np.searchsorted(units.owner[at], np.arange(len(texts) + 1))
        begins = np.concatenate(([0], np.cumsum(units.count)))
        offsets = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts])))
        for i, (data, noted) in enumerate(zip(texts, notes, strict=True)):
            count = int(units.count[i])
            mine = hashes[bounds[i] : bounds[i + 1]]
            marked = np.zeros(len(mine), bool)
            if len(noted):
                marked |= np.isin(mine, noted)
            if own and len(mine) > 1:
                _, first = np.unique(mine, return_index=True)
                later = np.ones(len(mine), bool)
                later[first] = False
                marked |= later
            if not marked.any():
                yield data, count, 0, []
                continue
            gone = _covered(at[bounds[i] : bounds[i + 1]][marked] - begins[i], size, count)
            edge = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
            spans = np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)), axis=1)
            if kind == "word":
                own_units = slice(begins[i], begins[i + 1])
                left = _without_words(data, units.start[own_units] - offsets[i], units.end[own_units] - offsets[i], spans)
            else:
                left = b"\n".join(compress(data.split(b"\n"), ~gone))
            yield left, count, int(gone.sum()), spans.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text)
            for a, b, texts in text_slices(batch.column(at)):
                part = batch.slice(a, b - a)
                noted = part.column(part.num_columns - 1)
                ends = np.cumsum(pa.compute.list_value_length(noted).fill_null(0).to_numpy())[:-1]
                found = list(cut(texts, np.split(noted.flatten().to_numpy().view(np.uint64), ends)))
                columns = [part.column(i) for i in range(len(names))]
                columns[at] = pa.array([x[0] for x in found], pa.binary()).cast(pa.string())
                columns += [pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())]
                columns.append(pa.array([x[3] for x in found], pa.list_(pa.list_(pa.int64()))))
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_units", "n_removed", "removed_spans"])

    return run


def cut_repeats(docs: DataFrame, *, kind: str, size: int, own: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the units covered by repeated windows.

    A window of ``size`` consecutive words or lines counts as repeated in a document if a
    document with a smaller id holds it too; with ``own``, also where the same document holds
    it further up. Windows are judged on the input. The result has the input's columns with
    the text cut (kept words joined by one space, kept lines by ``\\n``), and ``n_units``,
    ``n_removed`` (long) and ``removed_spans`` ([first, end) of each removal interval); input
    columns of these names are replaced.

    Null and empty texts have no words (a line view sees one empty line) and give an empty
    text. Rows with a null id keep all, except own repeats, and no other row loses anything to
    them. Rows with equal ids are one document for the comparison; each is cut by itself.
    """
    docs = docs.select([F.col(f"`{x}`") for x in without(docs.columns, ("n_units", "n_removed", "removed_spans"))])
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(total // (UNIT_BYTES[kind] * BUCKET_ENTRIES)) + 1)
    packed = slim.mapInArrow(_packer(kind, size, buckets), PACKED)
    # Stored, so that the windows' shuffle is gone before the texts are moved.
    notes = stored(packed.groupBy("bucket").applyInArrow(_judge, NOTES), "notes")
    note_id, note_list, salt = (unused(docs.columns, x) for x in ("note_id", "notes", "salt"))
    notes = notes.groupBy(F.col("doc_id").alias(note_id)).agg(F.collect_list("hash").alias(note_list))
    notes = notes.withColumn(f"{salt}_", F.lit(0))
    own_id = F.col(f"`{id_col}`").cast("long")
    salted = docs.withColumn(salt, F.when(own_id.isNull(), F.hash(F.col(f"`{text_col}`"))).otherwise(0))  # null ids meet nothing, in no one task
    joined = salted.join(notes, (own_id == F.col(note_id)) & (F.col(salt) == F.col(f"{salt}_")), "left")
    joined = joined.select(*[F.col(f"`{x}`") for x in docs.columns], note_list)
    names = docs.columns
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_units", T.LongType()), T.StructField("n_removed", T.LongType())]
        + [T.StructField("removed_spans", T.ArrayType(T.ArrayType(T.LongType())))]
    )
    return joined.mapInArrow(_cutter(names, text_col, kind, size, own), schema)
