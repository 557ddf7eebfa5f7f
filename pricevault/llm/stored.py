"""Cut lineage with a table in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricevault.session import shared_dir, shuffles_freed
from pricevault.sources.tablelog import PACKED


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame below ``spark.checkpoint.dir`` and read it back; a lost executor loses nothing.

    What was shuffled for it is gone once it is written.
    """
    path = shared_dir(frame.sparkSession, label)
    with shuffles_freed(frame.sparkSession):
        frame.write.options(**PACKED).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
