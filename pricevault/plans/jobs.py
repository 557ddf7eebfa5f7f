"""Whole loads, bronze and vault: read, stage, merge, write one batch.

Every job takes the batch's number and load time as parameters and reads only earlier
batches, so running it again, after a failure or by mistake, gives the same tables. Vault loads of an earlier
batch are refused once later ones were merged on it; ``replay_vault`` corrects it and runs those again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.catalog import create_schema, create_view, register_bucketed, register_external
from pricevault.operators.history import intervals
from pricevault.operators.keyed import unique_keys
from pricevault.operators.quality import BROKEN, assert_not_null, broken_rules
from pricevault.operators.wrangle import ensure_symbol, to_bronze, to_bronze_company
from pricevault.plans.histories import Place, live_versions, read_history, store_history
from pricevault.plans.staging import stage_bars, stage_company
from pricevault.plans.vault import (
    load_hub,
    load_link,
    load_sat_insert_only,
    load_sat_versions,
    version_columns,
)
from pricevault.schemas import (
    COMPANY,
    DAY,
    HISTORICALS,
    HUB_INSTRUMENT,
    HUBS,
    MINUTE,
    MINUTE_HISTORICALS,
    SAT_COMPANY_INFO,
    SATELLITES,
    VAULT_TABLES,
    Grain,
    HubSpec,
    SatSpec,
    TableSpec,
)
from pricevault.session import shuffles_freed
from pricevault.sources.buckets import read_bucketed, write_bucketed
from pricevault.sources.readers import RAW_FILE, RAW_LINE, read_or_empty
from pricevault.sources.runs import Run, all_runs, fingerprint, stale_runs, start_run
from pricevault.sources.tablelog import BATCH, LOAD, append_log, by_partition, read_as_of, read_log

#: Partition column of the bar-sized vault tables: the calendar period of the bar. A batch
#: is merged against the periods it touches, not against the whole table.
PERIOD = "_period"
PERIOD_FIELD = T.StructField(PERIOD, T.DateType())
#: Partition column of bronze logs: accepted rows and those that a rule turned away.
REJECTED = "_rejected"
REJECTED_FIELD = T.StructField(REJECTED, T.BooleanType())
#: Layout of a vault, one row, written by its first load.
LAYOUT = T.StructType([T.StructField("buckets", T.IntegerType())])
COMPACTED = T.StructType([T.StructField("folder", T.StringType()), T.StructField("reads", T.StringType())])


@dataclass(frozen=True)
class Batch:
    """One run of a job."""

    base: str
    batch_id: int
    load_dts: datetime | str
    record_source: str = "historicals"
    symbol: str | None = None
    register_in: str | None = None
    #: Run although later batches were merged on this one; they are stale until they are run again.
    over_later: bool = False
    #: Buckets, by merge key, of each period of a *new* vault's links and price satellites; later batches follow the vault.
    #: Take no fewer than ``spark.sql.shuffle.partitions``, or Spark may prefer to move the stored side.
    buckets: int | None = None
    #: Store the versions that the batch touched with their ``End_DTS`` as well (:mod:`pricevault.plans.histories`).
    store_ends: bool = False


# Bronze


def run_bronze_company(facts: DataFrame, batch: Batch) -> None:
    """Raw company facts -> bronze company, upserted by symbol; unreadable records go to rejects."""
    return _run_bronze(to_bronze_company(facts, _raw(facts)), COMPANY, F.col("longName"), batch)


def run_bronze_daily(bars: DataFrame, batch: Batch) -> None:
    """Raw daily bars -> bronze bars, upserted by symbol and date; rows that break a rule go to rejects."""
    return _run_bronze(to_bronze(bars, DAY, batch.symbol, _raw(bars)), HISTORICALS, F.col("Close"), batch, period(DAY))


def run_bronze_minute(bars: DataFrame, batch: Batch) -> None:
    """Raw minute bars -> bronze bars, upserted by symbol and minute; bars without either go to rejects."""
    return _run_bronze(to_bronze(bars, MINUTE, batch.symbol, _raw(bars)), MINUTE_HISTORICALS, F.col("Close"), batch, period(MINUTE))


def _raw(df: DataFrame) -> list[str]:
    return [c for c in (RAW_LINE, RAW_FILE) if c in df.columns]


def _run_bronze(rows: DataFrame, table: TableSpec, order: Column, batch: Batch, when: Column | None = None) -> None:
    """Write one batch, accepted and rejected rows side by side, from one scan of the source.

    The verdict is a partition column, so a read of either opens its files only. Accepted rows must be
    unique by key; a rejected row is a key of its own. ``reject_counts`` reads the verdicts back.
    """
    spark, path = rows.sparkSession, table.location(batch.base)
    rules = {**({"readable": f"{RAW_LINE} IS NULL"} if RAW_LINE in rows.columns else {}), **table.checks}
    for name in (RAW_LINE, RAW_FILE):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    start_run(spark, _bronze_runs(batch.base, table), batch.batch_id, table.name, over_later=True)
    judged = rows.withColumn(BROKEN, broken_rules(rules)).withColumn(REJECTED, F.col(BROKEN) != "")
    judged = judged.withColumn("_only", F.when(F.col(REJECTED), F.monotonically_increasing_id()))
    kept = unique_keys(judged, [*table.keys, "_only"], [order]).drop("_only")
    layout = [REJECTED]
    if when is not None:
        kept, layout = kept.withColumn(PERIOD, when), [REJECTED, PERIOD]
    with shuffles_freed(spark):
        append_log(kept, path, batch.batch_id, layout, gathered=True)


def _bronze_runs(base: str, table: TableSpec) -> str:
    return f"{table.location(base)}_runs"


def bronze_runs(spark: SparkSession, base: str, table: TableSpec, upto: int | None = None) -> list[Run]:
    """The runs that a bronze table's batches up to ``upto`` come from."""
    return [r for r in all_runs(spark, _bronze_runs(base, table)) if upto is None or r.batch_id <= upto]


def _bronze_log(spark: SparkSession, base: str, spec: TableSpec, upto: int | None = None) -> DataFrame:
    grain = _bronze_grain(spec)
    extra = [T.StructField(x, T.StringType()) for x in (RAW_LINE, RAW_FILE, BROKEN)]
    schema = T.StructType([*spec.schema.fields, *extra, REJECTED_FIELD, *([PERIOD_FIELD] if grain else [])])
    return read_log(spark, spec.location(base), schema, upto)


def read_rejects(spark: SparkSession, base: str, spec: TableSpec, batch_id: int, raw: bool = False) -> DataFrame:
    """The rows that a bronze load turned away, with the names of the rules they break.

    ``raw`` adds the unreadable record's text and the file that it stands in, for scans that keep them.
    """
    log = _bronze_log(spark, base, spec).filter(F.col(REJECTED) & (F.col(BATCH) == batch_id))
    return log.select(*spec.columns, BROKEN, *((RAW_LINE, RAW_FILE) if raw else ()))


def reject_counts(spark: SparkSession, base: str, spec: TableSpec, batch_id: int) -> DataFrame:
    """Rows of a batch that break each rule, from the rejected rows alone: ``rule``, ``n_broken``."""
    broken = read_rejects(spark, base, spec, batch_id).select(F.explode(F.split(BROKEN, ",")).alias("rule"))
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("n_broken"))


def read_bronze(
    spark: SparkSession,
    base: str,
    spec: TableSpec,
    upto: int | None = None,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """A bronze table after batch ``upto`` (all batches by default): newest row per key.

    ``days`` (first and last, both included) opens only the calendar periods of bars that hold
    them; a bar's rows all lie in its own period. Batches up to the newest compacted one are
    read from that.
    """
    return _newest_rows(spark, base, spec, upto, days).select(*spec.columns)


def compact_bronze(spark: SparkSession, base: str, spec: TableSpec, upto: int) -> None:
    """Store the newest row of each key after batch ``upto``, so that reads rank later batches only.

    The log stays, and a read of an earlier batch still uses it. Each compaction has a folder of its own, and
    counts once its record is there. The record names the runs of the batches that went into it: when one of them
    is run again, the compaction no longer fits and is not read, nor built upon; compact again then.
    """
    sources = bronze_runs(spark, base, spec, upto)
    rows = _newest_rows(spark, base, spec, upto, None).withColumn(BATCH, F.lit(upto).cast("long"))
    folder = uuid.uuid4().hex
    packed = by_partition(rows, [PERIOD] if PERIOD in rows.columns else []).write
    with shuffles_freed(spark):
        packed.partitionBy(*[c for c in (BATCH, PERIOD) if c in rows.columns]).parquet(f"{spec.location(base)}_compacted/{folder}")
    record = spark.createDataFrame([(folder, fingerprint(sources))], COMPACTED).coalesce(1)
    append_log(record, f"{spec.location(base)}_compactions", upto)


def _bronze_grain(spec: TableSpec) -> Grain | None:
    return next((g for g in (DAY, MINUTE) if g.bronze == spec), None)


def compacted_folder(spark: SparkSession, base: str, spec: TableSpec, upto: int | None) -> tuple[int, str] | None:
    """Batch and folder of the newest compaction that fits the runs of its batches."""
    records = read_log(spark, f"{spec.location(base)}_compactions", COMPACTED, upto, may_be_new=True).collect()
    if not records:
        return None
    runs = all_runs(spark, _bronze_runs(base, spec))
    for r in sorted(records, key=lambda r: r[BATCH], reverse=True):
        if r.reads == fingerprint(x for x in runs if x.batch_id <= r[BATCH]):
            return r[BATCH], f"{spec.location(base)}_compacted/{r.folder}"
    return None


def _newest_rows(
    spark: SparkSession, base: str, spec: TableSpec, upto: int | None, days: tuple[str, str] | None
) -> DataFrame:
    grain = _bronze_grain(spec)
    columns = [*spec.columns, *([PERIOD] if grain else []), BATCH]
    log = _bronze_log(spark, base, spec, upto).filter(~F.col(REJECTED)).select(*columns)
    packed = compacted_folder(spark, base, spec, upto)
    if packed:
        at, folder = packed
        schema = T.StructType([*spec.schema.fields, *([PERIOD_FIELD] if grain else [])])
        log = read_log(spark, folder, schema).select(*columns).unionByName(log.filter(F.col(BATCH) > at))
    if days and grain:
        log = log.filter(F.col(PERIOD).between(*(F.trunc(F.lit(d).cast("date"), grain.period) for d in days)))
    return read_as_of(log, spec.keys, F.lit(2**62) if upto is None else upto)


def read_batch(spark: SparkSession, base: str, spec: TableSpec, batch_id: int) -> DataFrame:
    """The rows one batch brought to a bronze table: the input of that batch's vault load."""
    log = _bronze_log(spark, base, spec)
    return log.filter(~F.col(REJECTED) & (F.col(BATCH) == batch_id)).select(*spec.columns)


# Vault


def run_vault_daily(source: DataFrame, batch: Batch) -> None:
    """Daily bars -> instrument and calendar hubs, link, insert-only price satellite."""
    _run_vault_bars(source, DAY, batch)


def run_vault_minute(source: DataFrame, batch: Batch) -> None:
    """Minute bars -> instrument and time hubs, link, versioned price satellite."""
    _run_vault_bars(source, MINUTE, batch)


def run_vault_company(source: DataFrame, batch: Batch, spec: SatSpec = SAT_COMPANY_INFO) -> None:
    """Company facts -> instrument hub, versioned company satellite."""
    spark = source.sparkSession
    _settle_layout(spark, batch)
    _, before = start_run(spark, _vault_runs(batch.base), batch.batch_id, spec.table.name, batch.over_later)
    staged = stage_company(source, batch.load_dts, batch.record_source, spec)
    log = _earlier(spark, spec.table, batch, version_columns(spec))
    _write_all(
        spark,
        lambda: _write_hub(spark, batch, staged, HUB_INSTRUMENT, spec.table.name, before),
        lambda: _write(batch, spec.table, load_sat_versions(log, staged, spec)),
    )
    if batch.store_ends and spec == SAT_COMPANY_INFO:
        store_ends(spark, batch.base, batch.batch_id, spec)
    _register(spark, batch, [HUB_INSTRUMENT.table, spec.table])


def _run_vault_bars(source: DataFrame, grain: Grain, batch: Batch) -> None:
    spark = source.sparkSession
    buckets = _settle_layout(spark, batch)
    _, before = start_run(spark, _vault_runs(batch.base), batch.batch_id, grain.bronze.name, batch.over_later)
    bars = ensure_symbol(source, batch.symbol)
    staged = stage_bars(bars, grain, batch.load_dts, batch.record_source)
    with shuffles_freed(spark):
        span = staged.agg(F.min(period(grain)), F.max(period(grain))).first()
    link, sat, at, extra = grain.link, grain.sat, (grain.time,), (PERIOD,)
    # Hashes and the period are made from business keys and prices once these are where they are merged.
    unhashed, made_of = staged.drop("Hash_Diff", link.link_key), link.business_keys

    def write(spec: TableSpec, rows: DataFrame) -> None:
        _write(batch, spec, rows.withColumn(PERIOD, period(grain)).drop(grain.time), extra, buckets)

    def write_link() -> None:
        target = _touched(spark, link.table, batch, span, buckets=buckets)
        write(link.table, load_link(target, unhashed, link, at, buckets))

    def write_sat() -> None:
        if sat.versioned:
            target = _touched(spark, sat.table, batch, span, version_columns(sat), buckets)
            rows = load_sat_versions(target, unhashed, sat, at, buckets, made_of)
        else:
            target = _touched(spark, sat.table, batch, span, buckets=buckets)
            rows = load_sat_insert_only(target, unhashed, sat, at, by_parent=buckets > 0, buckets=buckets, made_of=made_of)
        write(sat.table, rows)

    _write_all(
        spark,
        lambda: _write_hub(spark, batch, staged, HUB_INSTRUMENT, grain.bronze.name, before),
        lambda: _write_hub(spark, batch, staged, grain.hub, grain.bronze.name, before),
        write_link,
        write_sat,
    )
    if batch.store_ends and sat.versioned:
        store_ends(spark, batch.base, batch.batch_id, sat)
    _register(spark, batch, [HUB_INSTRUMENT.table, grain.hub.table, link.table, sat.table])


def _write_all(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes side by side, so that small hub loads fill idle executors.

    All are waited for; the first failure is raised. Each write replaces its own batch, so
    the run can simply be repeated.
    """
    with shuffles_freed(spark), ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in started:
        write.result()


def _write(batch: Batch, spec: TableSpec, rows: DataFrame, partition_by=(), buckets: int = 0) -> None:
    rows, path = _required(rows, spec), spec.location(batch.base)
    # The merge has moved the rows by key: they are written from there, not moved again.
    if buckets:
        write_bucketed(rows, f"{path}/{BATCH}={int(batch.batch_id)}", spec.bucket_by, buckets, partition_by, gathered=True)
    else:
        append_log(rows, path, batch.batch_id, partition_by, gathered=True)


def vault_buckets(spark: SparkSession, base: str) -> int | None:
    """Buckets of the vault's bar tables by merge key (0: none), or None before its first load."""
    found = read_or_empty(spark, f"{base.rstrip('/')}/vault_layout", LAYOUT).first()
    if found:
        return found.buckets
    return 0 if all_runs(spark, _vault_runs(base)) else None


def _settle_layout(spark: SparkSession, batch: Batch) -> int:
    """The vault's buckets; its first load writes them down before anything else."""
    known = vault_buckets(spark, batch.base)
    if known is None:
        known = batch.buckets or 0
        record = spark.createDataFrame([(known,)], LAYOUT).coalesce(1)
        record.write.mode("overwrite").parquet(f"{batch.base.rstrip('/')}/vault_layout")
    if batch.buckets not in (None, known):
        raise ValueError(f"the vault has {known} buckets, not {batch.buckets}")
    return known


def _write_hub(spark: SparkSession, batch: Batch, staged: DataFrame, hub: HubSpec, load: str, before: list[Run]) -> None:
    """Add a load's business keys that neither an earlier batch nor a load before it in this one has."""
    path = hub.table.location(batch.base)
    schema = T.StructType([*hub.table.schema.fields, T.StructField(LOAD, T.StringType())])
    log = read_log(spark, path, schema, batch.batch_id, may_be_new=True)
    own = [r.load for r in before if r.batch_id == batch.batch_id]
    known = log.filter((F.col(BATCH) < batch.batch_id) | F.col(LOAD).isin(own))
    append_log(_required(load_hub(known, staged, hub), hub.table), path, batch.batch_id, load=load)


def _vault_runs(base: str) -> str:
    return f"{base.rstrip('/')}/vault_runs"


def replay_vault(spark: SparkSession, base: str, first: int, source: Callable[[str, int], tuple[DataFrame, Batch]]) -> None:
    """Run all vault loads of batch ``first`` and later again, in their order.

    ``source`` gives the rows and the batch of a load by its name (the bronze bar table's, or the company
    satellite's) and batch number. Use it to correct an earlier batch. If it stops half-way, the loads that
    are still to come are stale and ``open_vault`` refuses them; call it again.
    """
    jobs = {DAY.bronze.name: run_vault_daily, MINUTE.bronze.name: run_vault_minute, SAT_COMPANY_INFO.table.name: run_vault_company}
    for run in all_runs(spark, _vault_runs(base)):
        if run.batch_id >= first:
            rows, batch = source(run.load, run.batch_id)
            jobs[run.load](rows, replace(batch, over_later=True))


def _required(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows; the load stops at a NULL in a required column that the rows carry."""
    stored = replace(spec, schema=T.StructType([f for f in spec.schema if f.name in rows.columns]))
    return assert_not_null(rows, stored)


def period(grain: Grain) -> Column:
    """The calendar period of a bar, named by its first day."""
    return F.trunc(F.col(grain.time).cast("date"), grain.period)


def _stored(spec: TableSpec, columns: list[str] | None = None) -> T.StructType:
    return T.StructType([f for f in spec.schema if columns is None or f.name in columns])


def _earlier(
    spark: SparkSession, spec: TableSpec, batch: Batch, columns: list[str] | None = None
) -> DataFrame:
    """The table's log before this batch."""
    schema = _stored(spec, columns)
    return read_log(spark, spec.location(batch.base), schema, batch.batch_id - 1, may_be_new=True)


def _bar_log(spark: SparkSession, base: str, spec: TableSpec, buckets: int, upto: int | None = None) -> DataFrame:
    """The log of a link or price satellite up to a batch, with its period; versions carry no ``End_DTS``."""
    fields = [*(f for f in spec.schema if f.name != "End_DTS"), PERIOD_FIELD]
    if not buckets:
        return read_log(spark, spec.location(base), T.StructType(fields), upto, may_be_new=True)
    schema = T.StructType([*fields, T.StructField(BATCH, T.LongType())])
    log = read_bucketed(spark, spec.location(base), schema, spec.bucket_by, buckets, [BATCH, PERIOD])
    return log if upto is None else log.filter(F.col(BATCH) <= upto)


def _touched(
    spark: SparkSession, spec: TableSpec, batch: Batch, span, columns: list[str] | None = None, buckets: int = 0
) -> DataFrame:
    """The log before this batch, in the periods the batch covers: a pruned scan."""
    log = _bar_log(spark, batch.base, spec, buckets, batch.batch_id - 1)
    names = [f.name for f in _stored(spec, columns)]
    return log.select(*names, PERIOD, BATCH).filter(F.col(PERIOD).between(F.lit(span[0]), F.lit(span[1])))


def _sat_runs(spark: SparkSession, base: str, sat: SatSpec, upto: int | None = None) -> list[Run]:
    """The runs that wrote a satellite, in order."""
    load = next((g.bronze.name for g in (DAY, MINUTE) if g.sat == sat), sat.table.name)
    return [r for r in all_runs(spark, _vault_runs(base)) if r.load == load and (upto is None or r.batch_id <= upto)]


def _sat_log(spark: SparkSession, base: str, sat: SatSpec, buckets: int, upto: int | None) -> DataFrame:
    if any(g.sat == sat for g in (DAY, MINUTE)):
        return _bar_log(spark, base, sat.table, buckets, upto)
    return read_log(spark, sat.table.location(base), _stored(sat.table, version_columns(sat)), upto, may_be_new=True)


def _history_place(base: str, sat: SatSpec, buckets: int) -> Place:
    of_bars = any(g.sat == sat for g in (DAY, MINUTE))
    return Place(base, sat, PERIOD if of_bars else None, buckets if of_bars else 0)


def store_ends(spark: SparkSession, base: str, upto: int, sat: SatSpec) -> None:
    """Store a versioned satellite's history after batch ``upto``: the periods touched since it was stored last.

    Loads do it where ``Batch.store_ends`` is set. Without it, or while it does not fit, ``End_DTS`` is found on read.
    """
    buckets = vault_buckets(spark, base) or 0
    place = _history_place(base, sat, buckets)
    with shuffles_freed(spark):
        store_history(spark, place, lambda: _sat_log(spark, base, sat, buckets, upto), _sat_runs(spark, base, sat, upto), upto)


def _history(spark: SparkSession, base: str, sat: SatSpec, buckets: int, upto: int | None) -> DataFrame:
    """A versioned satellite with ``End_DTS``: stored if that fits all its runs up to ``upto``, else from the log."""
    place, runs = _history_place(base, sat, buckets), _sat_runs(spark, base, sat, upto)
    found = live_versions(spark, place, runs, upto)
    if found and all(r.batch_id <= found[0] for r in runs):
        return read_history(spark, place, found[1])
    return intervals(_sat_log(spark, base, sat, buckets, upto), [sat.parent_key])


def _register(spark: SparkSession, batch: Batch, specs: Iterable[TableSpec]) -> None:
    if batch.register_in:
        register_vault(spark, batch.base, batch.register_in, specs)


def register_vault(spark: SparkSession, base: str, schema: str, specs: Iterable[TableSpec] = VAULT_TABLES) -> None:
    """Make tables that jobs have filled readable by name, or pick up their new batches.

    A versioned satellite is a view over its log, which is registered as ``<name>_log``: a version ends where
    the key's next one starts. Names always show all batches; ``open_vault`` reads earlier ones, and refuses
    loads that are still to be run again.
    """
    create_schema(spark, schema, base)
    versioned = {sat.table.name: sat.parent_key for sat in SATELLITES if sat.versioned}
    buckets = vault_buckets(spark, base) or 0
    of_bars = {x.table.name for g in (DAY, MINUTE) for x in (g.link, g.sat)}
    for spec in specs:
        name, key = f"{schema}.{spec.name}", versioned.get(spec.name)
        entry = name if key is None else f"{name}_log"
        if buckets and spec.name in of_bars:
            fields = [*(f for f in spec.schema if f.name != "End_DTS"), T.StructField(BATCH, T.LongType()), PERIOD_FIELD]
            register_bucketed(spark, entry, spec.location(base), T.StructType(fields), spec.bucket_by, buckets, [BATCH, PERIOD])
        else:
            register_external(spark, entry, spec.location(base))
        if key is None:
            continue
        end = f"lead(Effective_DTS) OVER (PARTITION BY {key} ORDER BY Effective_DTS) AS End_DTS"
        columns = ", ".join(end if c == "End_DTS" else c for c in spec.columns)
        create_view(spark, name, f"SELECT {columns} FROM {name}_log")


class OpenVault(dict[str, DataFrame]):
    """Vault tables by name; ``plain`` ones lie in no buckets, so that a view may move their keys in a shorter form."""

    def __init__(self, plain: bool):
        super().__init__()
        self.plain = plain


def open_vault(
    spark: SparkSession,
    base: str,
    upto: int | None = None,
    days: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Vault tables in their declared shape, after batch ``upto`` (all by default).

    Every load fills the instrument hub, so a base without it is no vault and is refused; a
    table that no job has filled yet is empty. A vault of which a later load was merged on a run that has been
    replaced since is refused as well, unless ``upto`` leaves that load out.

    ``days`` (first and last day, both included) opens only the calendar periods that hold
    bars of these days: other periods are pruned before any file is read. A bar's versions
    all lie in the bar's own period, so histories stay whole. A vault in buckets is opened through the
    session's catalog, and stored histories that fit are read instead of being derived.
    """

    def opened(rows: DataFrame, spec: TableSpec, grain: Grain) -> DataFrame:
        if days:
            first, last = (F.trunc(F.lit(d).cast("date"), grain.period) for d in days)
            rows = rows.filter(F.col(PERIOD).between(first, last))
        return rows.select(*spec.columns)

    stale = [r for r in stale_runs(all_runs(spark, _vault_runs(base))) if upto is None or r.batch_id <= upto]
    if stale:
        raise ValueError(f"to be run again: {', '.join(f'batch {r.batch_id} {r.load}' for r in stale)}")
    buckets = vault_buckets(spark, base) or 0
    vault = OpenVault(plain=not buckets)
    for hub in HUBS:
        log = read_log(spark, hub.table.location(base), hub.table.schema, upto, hub is not HUB_INSTRUMENT)
        vault[hub.table.name] = log.select(*hub.table.columns)
    for grain in (DAY, MINUTE):
        link, sat = grain.link, grain.sat
        vault[link.table.name] = opened(_bar_log(spark, base, link.table, buckets, upto), link.table, grain)
        if sat.versioned:
            rows = _history(spark, base, sat, buckets, upto)
        else:
            rows = _bar_log(spark, base, sat.table, buckets, upto)
        vault[sat.table.name] = opened(rows, sat.table, grain)
    sat = SAT_COMPANY_INFO
    vault[sat.table.name] = _history(spark, base, sat, 0, upto).select(*sat.table.columns)
    return vault


def publish(vault: dict[str, DataFrame]) -> None:
    """Make the vault's tables usable by name in SQL for this session."""
    for name, table in vault.items():
        table.createOrReplaceTempView(name)


