"""Shuffle files go with the write that made them, and the session's own setting stays."""

from __future__ import annotations

import datetime
import os
import time

import pytest

from pricevault import shared_dir
from pricevault.plans.jobs import Batch, run_vault_daily
from pricevault.schemas import HISTORICALS
from pricevault.session import FREE_SHUFFLES, shuffles_freed


def shuffle_files(spark) -> set[str]:
    places = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for place in places for _, _, names in os.walk(place) for f in names if f.startswith("shuffle_")}


def left_by(spark, write) -> set[str]:
    before = shuffle_files(spark)
    write()
    for _ in range(50):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_a_load_leaves_no_shuffle_files(spark):
    bars = spark.createDataFrame([(datetime.date(2024, 1, 2), s, 1.0, 1.0, 1.0, 1.0, 5, 0.0, 0.0) for s in "ABC"], HISTORICALS.schema)
    base = shared_dir(spark, "freed")
    for k in (1, 2):
        assert not left_by(spark, lambda: run_vault_daily(bars, Batch(base, k, f"2024-0{k}-01 00:00:00")))


def test_a_session_keeps_its_setting(spark):
    default = spark.conf.get(FREE_SHUFFLES)
    for own in (None, "true", "false"):
        if own:
            spark.conf.set(FREE_SHUFFLES, own)
        with pytest.raises(KeyError), shuffles_freed(spark):
            with shuffles_freed(spark):
                assert spark.conf.get(FREE_SHUFFLES) == "true"
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            raise KeyError
        assert spark.conf.get(FREE_SHUFFLES) == (own or default)
    spark.conf.unset(FREE_SHUFFLES)
