"""Rules every loaded vault keeps."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import frames as fr
from pricevault.operators.history import as_of, current, scd2_apply
from pricevault.operators.quality import split_by_rules
from pricevault.schemas import BAR_CHECKS, HUBS, LINKS, SAT_COMPANY_INFO, SATELLITES, VAULT_TABLES


@pytest.fixture(scope="module")
def vault(spark, sf_dir):
    return {n: t.cache() for n, t in fr.stored_vault(spark, sf_dir).items()}


def test_keys_are_unique(vault):
    for spec in VAULT_TABLES:
        counted = vault[spec.name].groupBy(*spec.keys).count()
        assert counted.filter("count > 1").count() == 0, spec.name


def test_required_columns_are_filled(vault):
    for spec in VAULT_TABLES:
        missing = [F.count_if(F.col(c).isNull()) for c in spec.not_null]
        assert not any(vault[spec.name].agg(*missing).first()), spec.name


def test_links_and_satellites_resolve(vault):
    for link in LINKS:
        for hub in link.hubs:
            lost = vault[link.table.name].join(vault[hub.table.name], hub.hash_key, "left_anti")
            assert lost.count() == 0
    parents = {x.link_key: vault[x.table.name] for x in LINKS}
    parents["Instrument_HK"] = vault[HUBS[0].table.name]
    for sat in SATELLITES:
        lost = vault[sat.table.name].join(parents[sat.parent_key], sat.parent_key, "left_anti")
        assert lost.count() == 0


@pytest.mark.parametrize("sat", [s for s in SATELLITES if s.versioned], ids=lambda s: s.table.name)
def test_versions_follow_each_other(vault, sat):
    rows = vault[sat.table.name]
    assert current(rows).groupBy(sat.parent_key).count().filter("count > 1").count() == 0
    along = Window.partitionBy(sat.parent_key).orderBy("Effective_DTS")
    steps = rows.withColumn("next", F.lead("Effective_DTS").over(along))
    assert steps.filter(~F.col("next").eqNullSafe(F.col("End_DTS"))).count() == 0
    for at in ("2023-12-31 00:00:00", *fr.LOADS.values(), "2024-02-15 12:00:00"):
        seen = as_of(rows, at).groupBy(sat.parent_key).count()
        assert seen.filter("count > 1").count() == 0


def test_no_version_repeats_the_one_before(vault):
    rows = vault["sat_company_info"]
    along = Window.partitionBy("Instrument_HK").orderBy("Effective_DTS")
    same = rows.withColumn("before", F.lag("Hash_Diff").over(along)).filter("before = Hash_Diff")
    assert same.count() == 0


def test_materialised_history_equals_the_log(spark, sf_dir, vault):
    history = fr.empty(spark, SAT_COMPANY_INFO.table)
    for k, at in fr.LOADS.items():
        staged = fr.staged_company(spark, sf_dir, k)
        history = scd2_apply(history, staged, ["Instrument_HK"], at)
    log = vault["sat_company_info"]
    assert history.exceptAll(log).count() == 0
    assert log.exceptAll(history).count() == 0


def test_split_keeps_every_row(spark, sf_dir):
    bars = fr.flawed(fr.hist(spark, sf_dir))
    ok, bad = split_by_rules(bars, BAR_CHECKS)
    assert ok.count() + bad.count() == bars.count()
    assert bad.count() > 0
