"""Session settings and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every job of this package is planned for. The cluster's own settings
#: (executors, memory, object-store credentials) come from spark-defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_spark(app: str = "pricevault", master: str | None = None, **conf: str) -> SparkSession:
    """Return the active session or build one with this package's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Shuffle files go when the query that wrote them has ended, not when Spark's driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = {"writers": 0, "before": None}
_guard = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside keep no shuffle files when they have ended; the session's own setting holds again after the last of them."""
    with _guard:
        if not _freeing["writers"]:
            _freeing["before"] = spark.conf.get(FREE_SHUFFLES, None)
            spark.conf.set(FREE_SHUFFLES, "true")
        _freeing["writers"] += 1
    try:
        yield
    finally:
        with _guard:
            _freeing["writers"] -= 1
            if not _freeing["writers"]:
                if _freeing["before"] is None:
                    spark.conf.unset(FREE_SHUFFLES)
                else:
                    spark.conf.set(FREE_SHUFFLES, _freeing["before"])


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder URI that every executor can reach.

    It lies below ``spark.checkpoint.dir``, or below the warehouse folder when no checkpoint folder is
    set. A warehouse on the machine's own disk is refused where executors run on other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and base.startswith(("file:", "/")):
            raise ValueError(f"set spark.checkpoint.dir: {base} is a folder of this machine alone")
    return f"{base.rstrip('/')}/pricevault/{label}-{uuid.uuid4().hex}"
