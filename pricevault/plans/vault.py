"""Vault loads as pure transforms: ``(target, staged, spec) -> rows to append``.

Each load starts again from the staged expressions and selects only the columns its
target needs: a hub load reads one bronze column, a link load two. That is cheaper at
size than holding the full staged frame between loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricevault.functions import hash_diff, hash_key, short_digest
from pricevault.operators.history import scd2_changes
from pricevault.operators.keyed import dedupe, insert_new, latest, unique_keys
from pricevault.schemas import HubSpec, LinkSpec, SatSpec

AUDIT = ["Load_DTS", "Record_Source"]


def _gathered(rows: DataFrame, key: str | Column, buckets: int) -> DataFrame:
    """Rows moved once, by key (to the target's buckets, if it has any), for all steps of a merge and its write."""
    return rows.repartition(buckets, key) if buckets else rows.repartition(key)


def _short(digest: str | Column, buckets: int) -> Column:
    """A digest as 16 bytes where a merge moves it; a target in buckets stays where its 32 digits belong."""
    if buckets:
        return F.col(digest) if isinstance(digest, str) else digest
    return short_digest(digest)


def _hashed(staged: DataFrame, spec: SatSpec, columns: list[str], buckets: int, made_of: Sequence[str] = ()) -> DataFrame:
    """The satellite's ``columns``, gathered by parent key; hashes that staging left out are made after the move.

    Without the parent key, its business keys ``made_of`` are moved in its place, to where its hash belongs.
    """
    present = list(dict.fromkeys([*made_of, *[c for c in columns if c in staged.columns]]))
    whole = spec.parent_key in staged.columns
    moved = _gathered(staged.select(*present), spec.parent_key if whole else hash_key(*made_of), buckets)
    if not whole:
        moved = moved.withColumn(spec.parent_key, hash_key(*made_of))
    if "Hash_Diff" not in staged.columns:
        moved = moved.withColumn("Hash_Diff", hash_diff(moved.schema, spec.attributes))
    return moved.select(*columns)


def gathered_feed(feed: DataFrame, spec: SatSpec, made_of: Sequence[str]) -> DataFrame:
    """A satellite's rows from staged batches, gathered by parent key for a history of them all.

    Only business keys ``made_of`` and attributes are moved; the parent key and the hash-diffs are made where the key's
    versions are, so that a window by the parent key moves nothing more.
    """
    columns = [c for c in spec.table.columns if c in feed.columns]
    return _hashed(feed.drop("Hash_Diff", spec.parent_key), spec, columns, 0, made_of)


def load_hub(target: DataFrame, staged: DataFrame, spec: HubSpec) -> DataFrame:
    """Business keys the hub does not hold yet.

    Keys are aggregated in the map tasks before anything is hashed or moved, so the work
    after the scan follows the number of distinct keys, not of rows.
    """
    seen = staged.groupBy(spec.business_key, "Record_Source").agg(
        F.min("Load_DTS").alias("Load_DTS")
    )
    keyed = seen.withColumn(spec.hash_key, hash_key(spec.business_key))
    new = insert_new(target, keyed, [spec.hash_key], AUDIT)
    return new.select(*spec.table.columns)


def load_link(
    target: DataFrame, staged: DataFrame, spec: LinkSpec, extra: tuple[str, ...] = (), buckets: int = 0
) -> DataFrame:
    """Combinations of business keys the link does not hold yet.

    Only the link key and the business keys are moved; hub keys are hashed afterwards,
    for new rows only. ``extra`` columns (a partition column) are carried along. ``buckets`` is the
    target's number of buckets by link key. Where staging left the link key out, the business keys alone are
    moved, to where its hash belongs, and a target without buckets sends its keys as 16 bytes each.
    """
    if spec.link_key not in staged.columns:
        made = hash_key(*spec.business_keys)
        slim = staged.select(*dict.fromkeys([*spec.business_keys, *AUDIT, *extra]))
        keyed = _gathered(slim, _short(made, buckets), buckets).withColumn("_key", _short(made, buckets))
        new = insert_new(target.select(_short(spec.link_key, buckets).alias("_key")), keyed, ["_key"], AUDIT)
        return _with_hub_keys(new.withColumn(spec.link_key, made), spec, extra)
    keyed = staged.select(spec.link_key, *spec.business_keys, *AUDIT, *extra)
    if buckets:
        keyed = _gathered(keyed, spec.link_key, buckets)
    return _with_hub_keys(insert_new(target, keyed, [spec.link_key], AUDIT), spec, extra)


def _with_hub_keys(new: DataFrame, spec: LinkSpec, extra: tuple[str, ...]) -> DataFrame:
    for hub in spec.hubs:
        new = new.withColumn(hub.hash_key, hash_key(hub.business_key))
    return new.select(*spec.table.columns, *extra)


def load_sat_insert_only(
    target: DataFrame,
    staged: DataFrame,
    spec: SatSpec,
    extra: tuple[str, ...] = (),
    by_parent: bool = False,
    buckets: int = 0,
    made_of: Sequence[str] = (),
) -> DataFrame:
    """Attribute states not held yet for their parent: unique on parent key and hash-diff.

    ``by_parent`` gathers each parent's few known hash-diffs where they are, and the batch goes there, once and without
    hash-diffs if staging left them out: a target laid out by the parent key (in ``buckets``) stays, where an anti-join
    on both keys would move it. Copies within the batch are dropped after the move. Where staging left the parent key out as
    well, its business keys ``made_of`` are moved instead, and a target without buckets sends its states as 32 bytes each, or, not
    ``by_parent``, as one 16-byte digest of parent key and hash-diff.
    """
    columns, parent = [*spec.table.columns, *extra], spec.parent_key
    keys = [parent, "Hash_Diff"]
    if not by_parent and parent not in staged.columns:
        return _new_states(target, staged, spec, columns, made_of)
    if not by_parent:
        return insert_new(target, staged.select(*columns), keys, AUDIT)
    if parent not in staged.columns:
        key = _short(hash_key(*made_of), buckets)
        slim = staged.select(*dict.fromkeys([*made_of, *[c for c in columns if c in staged.columns]]))
        moved = _gathered(slim, key, buckets).withColumn("_key", key)
        if "Hash_Diff" not in staged.columns:
            moved = moved.withColumn("Hash_Diff", hash_diff(moved.schema, spec.attributes))
        held = target.select(_short(parent, buckets).alias("_of"), _short("Hash_Diff", buckets).alias("_held"))
        # Bounds instead of an equality: an equality would be a second join key, and move both sides by both.
        state = _short("Hash_Diff", buckets).between(F.col("_held"), F.col("_held"))
        new = moved.join(held, (F.col("_key") == F.col("_of")) & state, "left_anti")
        return dedupe(new, ["_key", "Hash_Diff"], AUDIT).withColumn(parent, hash_key(*made_of)).select(*columns)
    known = target.groupBy(F.col(parent).alias("_of")).agg(F.collect_set("Hash_Diff").alias("_known"))
    found = _hashed(staged, spec, columns, buckets).join(known, F.col(parent) == F.col("_of"), "left")
    held = F.coalesce(F.array_contains("_known", F.col("Hash_Diff")), F.lit(False))
    return dedupe(found.filter(~held).select(*columns), keys, AUDIT)


def _new_states(target: DataFrame, staged: DataFrame, spec: SatSpec, columns: list[str], made_of: Sequence[str]) -> DataFrame:
    """:func:`load_sat_insert_only` for a plain target and a batch without its parent key: both go to one digest of key and hash-diff."""
    parent, key = spec.parent_key, hash_key(*made_of)
    slim = staged.select(*dict.fromkeys([*made_of, *[c for c in columns if c in staged.columns]]))
    diff = F.col("Hash_Diff") if "Hash_Diff" in staged.columns else hash_diff(slim.schema, spec.attributes)
    # Parent keys and hash-diffs are of one length, so the digest of both is that of one state.
    state = short_digest(F.md5(F.concat(key, diff)))
    moved = _gathered(slim, state, 0).withColumns({"_state": state, parent: key, "Hash_Diff": diff})
    held = target.select(short_digest(F.md5(F.concat(parent, "Hash_Diff"))).alias("_state"))
    return insert_new(held, moved, ["_state"], AUDIT).select(*columns)


def load_sat_versions(
    target_log: DataFrame,
    staged: DataFrame,
    spec: SatSpec,
    extra: tuple[str, ...] = (),
    buckets: int = 0,
    made_of: Sequence[str] = (),
) -> DataFrame:
    """Versions a batch adds to a versioned satellite's log.

    ``End_DTS`` is not stored: it is the start of the next version, derived on read. The
    newest version of each key is found with a per-task limit before the shuffle; the batch is moved once, by the
    key, and gets hashes that staging left out after that (``made_of``: the parent key's business keys). Exact copies
    in the batch count once; two different rows of one key stop the job, and so does a change
    that is not later than the key's newest version. Where staging left the parent key out, a target without
    buckets sends a key and hash-diff as 16 bytes each.
    """
    keys = [spec.parent_key]
    stored = version_columns(spec)
    started = staged.withColumn("Effective_DTS", F.col("Load_DTS"))
    if spec.parent_key not in staged.columns and not buckets:
        return _short_versions(target_log, started, spec, [*stored, *extra], made_of)
    fresh = _hashed(started, spec, [*stored, *extra], buckets, made_of)
    fresh = unique_keys(fresh.distinct(), keys, [*AUDIT, "Hash_Diff"])
    newest = latest(target_log.select(*keys, "Hash_Diff", "Effective_DTS"), keys, ["Effective_DTS", "Hash_Diff"])
    return scd2_changes(newest, fresh, keys).select(*stored, *extra)


def _short_versions(target_log: DataFrame, started: DataFrame, spec: SatSpec, columns: list[str], made_of: Sequence[str]) -> DataFrame:
    """:func:`load_sat_versions` for a target without buckets and a batch without its parent key: both meet by 16 bytes."""
    key, parent = _short(hash_key(*made_of), 0), spec.parent_key
    slim = started.select(*dict.fromkeys([*made_of, *[c for c in columns if c in started.columns]]))
    moved = _gathered(slim, key, 0).withColumns({"_key": key, parent: hash_key(*made_of)})
    if "Hash_Diff" not in started.columns:
        moved = moved.withColumn("Hash_Diff", hash_diff(moved.schema, spec.attributes))
    fresh = moved.select("_key", *columns).distinct()
    fresh = unique_keys(fresh, ["_key"], [*AUDIT, "Hash_Diff"], shown=[parent]).withColumn("_state", _short("Hash_Diff", 0))
    held = target_log.select(_short(parent, 0).alias("_key"), _short("Hash_Diff", 0).alias("_state"), "Effective_DTS")
    newest = latest(held, ["_key"], ["Effective_DTS", "_state"])
    return scd2_changes(newest, fresh, ["_key"], "_state").select(*columns)


def version_columns(spec: SatSpec) -> list[str]:
    return [c for c in spec.table.columns if c != "End_DTS"]


