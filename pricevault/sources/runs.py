"""Run records: which run of which batch a table's contents come from.

Every job notes its run before it writes: a new run id, and a fingerprint of all runs before it
in the order of batches (and of loads within a batch), which are the ones that it reads. A run that is
repeated gets a new id, so the fingerprints of all later runs no longer fit: they are *stale* until they
are run again. Records are one row for each batch and load, and are read on the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from pricevault.sources.tablelog import BATCH, LOAD, append_log, read_log

_FIELDS = T.StructType([T.StructField("seq", T.IntegerType()), T.StructField("run", T.StringType()), T.StructField("reads", T.StringType())])


@dataclass(frozen=True)
class Run:
    """One run of a load; ``seq`` is the load's place within its batch."""

    batch_id: int
    load: str
    seq: int
    run: str
    reads: str

    @property
    def place(self) -> tuple[int, int]:
        return self.batch_id, self.seq


def fingerprint(runs: Iterable[Run]) -> str:
    return hashlib.sha256("\n".join(r.run for r in runs).encode()).hexdigest()


def all_runs(spark: SparkSession, path: str) -> list[Run]:
    """The newest run of each batch and load, in their order."""
    schema = T.StructType([*_FIELDS.fields, T.StructField(LOAD, T.StringType())])
    rows = read_log(spark, path, schema, may_be_new=True).collect()
    return sorted((Run(r[BATCH], r[LOAD], r.seq, r.run, r.reads) for r in rows), key=lambda r: r.place)


def start_run(spark: SparkSession, path: str, batch_id: int, load: str, over_later: bool = False) -> tuple[Run, list[Run]]:
    """Record a run that is about to write; returns it and the runs that it reads.

    A run of a batch that later batches were merged on is refused unless ``over_later``.
    """
    known = all_runs(spark, path)
    mine = [r for r in known if r.batch_id == batch_id]
    seq = next((r.seq for r in mine if r.load == load), max((r.seq for r in mine), default=0) + 1)
    before = [r for r in known if r.place < (batch_id, seq)]
    later = sorted({r.batch_id for r in known if r.batch_id > batch_id})
    if later and not over_later:
        raise ValueError(f"batches {later} were merged on batch {batch_id} or after it: replay from batch {batch_id}")
    run = Run(batch_id, load, seq, uuid.uuid4().hex, fingerprint(before))
    append_log(spark.createDataFrame([(run.seq, run.run, run.reads)], _FIELDS).coalesce(1), path, batch_id, load=load)
    return run, before


def stale_runs(runs: list[Run]) -> list[Run]:
    """Runs that read another run of a batch than the one that counts now."""
    return [r for i, r in enumerate(runs) if r.reads != fingerprint(runs[:i])]
