"""Stored histories: versions of a satellite with their ``End_DTS``, rewritten by touched period.

A version log is append-only, so the end of a version is found on read, by a window over the log. A stored
history saves that window. After a batch, the periods that it touched are written whole into a new folder,
named by a version, and a small manifest then says which version of each period is live. Until the manifest is
there, nothing of the new folder is read. The manifest names the runs that it was made from: when
one of them is run again, or a later batch comes, it no longer fits and readers go back to the log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.operators.history import intervals
from pricevault.schemas import DATE, STRING, SatSpec, struct
from pricevault.sources.buckets import read_bucketed, write_bucketed
from pricevault.sources.runs import Run, fingerprint
from pricevault.sources.tablelog import BATCH, PACKED, append_log, read_log

VERSION = "_version"
_MANIFEST = struct(("period", DATE), ("version", STRING), ("reads", STRING))

#: Live version of each period; a table without periods has one entry, for None.
Live = dict[date | None, str]


@dataclass(frozen=True)
class Place:
    """Where the stored history of a satellite lies, and how it is laid out."""

    base: str
    sat: SatSpec
    period: str | None = None
    buckets: int = 0

    @property
    def path(self) -> str:
        return f"{self.sat.table.location(self.base)}_closed"

    @property
    def manifest(self) -> str:
        return f"{self.path}_manifest"

    @property
    def parts(self) -> list[str]:
        return [self.period] if self.period else []


def live_versions(spark: SparkSession, place: Place, runs: list[Run], upto: int | None = None) -> tuple[int, Live] | None:
    """Batch and live versions of the newest manifest that fits the satellite's ``runs`` up to its batch.

    The manifests are read on the driver: one row a period and batch.
    """
    batches: dict[int, list[T.Row]] = {}
    for r in read_log(spark, place.manifest, _MANIFEST, upto, may_be_new=True).collect():
        batches.setdefault(r[BATCH], []).append(r)
    for at in sorted(batches, reverse=True):
        if all(r.reads == fingerprint(x for x in runs if x.batch_id <= at) for r in batches[at]):
            return at, {r.period: r.version for r in batches[at]}
    return None


def store_history(
    spark: SparkSession, place: Place, log: Callable[[], DataFrame], runs: list[Run], upto: int
) -> None:
    """Write the periods that batches up to ``upto`` touched since the newest manifest, then the manifest.

    ``log`` opens the satellite's version log of these batches, with its period. Other periods keep their live version, unread.
    Replaced folders stay, for readers that still use them.
    """
    runs = [r for r in runs if r.batch_id <= upto]
    at, live = live_versions(spark, place, runs, upto) or (None, {})
    if at is not None and all(r.batch_id <= at for r in runs):
        return
    rows = log()
    fresh = rows if at is None else rows.filter(F.col(BATCH) > at)
    touched: list = [None]
    if place.period:
        touched = [r[0] for r in fresh.select(place.period).distinct().collect()]
        rows = rows.filter(F.col(place.period).isin(touched))
    version = uuid.uuid4().hex
    if touched:
        closed = intervals(rows, [place.sat.parent_key]).select(*place.sat.table.columns, *place.parts)
        folder = f"{place.path}/{VERSION}={version}"
        if place.buckets:
            write_bucketed(closed, folder, place.sat.parent_key, place.buckets, place.parts, gathered=True)
        else:
            closed.write.mode("overwrite").options(**PACKED).partitionBy(*place.parts).parquet(folder)
    entries = {**live, **dict.fromkeys(touched, version)}
    reads = fingerprint(runs)
    manifest = spark.createDataFrame([(p, v, reads) for p, v in entries.items()], _MANIFEST).coalesce(1)
    append_log(manifest, place.manifest, upto)


def read_history(spark: SparkSession, place: Place, live: Live) -> DataFrame:
    """The live versions with their ``End_DTS`` (and period): other folders are pruned before any file is read."""
    parts = [VERSION, *place.parts]
    schema = T.StructType([*place.sat.table.schema.fields, T.StructField(VERSION, STRING)])
    if place.period:
        schema = schema.add(place.period, DATE)
    if place.buckets:
        stored = read_bucketed(spark, place.path, schema, place.sat.parent_key, place.buckets, parts)
    else:
        stored = spark.read.schema(schema).parquet(place.path)
    chosen = F.lit(False)
    for version in dict.fromkeys(live.values()):
        mine = F.col(VERSION) == version
        if place.period:
            mine &= F.col(place.period).isin([p for p, v in live.items() if v == version])
        chosen |= mine
    return stored.filter(chosen).select(*place.sat.table.columns, *place.parts)
