"""Merkle manifest of a table: leaves, roots of sources, the root, and checked proofs.

Every level is a table of nodes (tree, index, digest). A node's siblings are the other indices of
its run of ``arity`` nodes: for two children the index with its last bit flipped (XOR), otherwise
the slot moved by 1 to arity - 1 within the run. One equijoin of the level with itself finds them: on
(tree, run), with the index among the computed ones. The rows in slot zero then hash their run into the
parent's node. A run is the unit that is dealt out, so the join and its collection share one
shuffle of the level, where equality on the index itself would send 15 rows a node over the network.

Proofs go down the tree again: a run meets its parent's path once, whatever its children, so a
path is sent to each run and not to each document.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricevault.llm.positions import INDEX, TOTAL, numbered
from pricevault.llm.stored import stored

ARITY = 16
#: Where this divides the row's checksum, the manifest tries out a changed text.
TAMPER_EVERY = 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def field_text(value: Column) -> Column:
    """``-`` for null, else the value's byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields one after the other."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (``tree``, ``idx``, ``total``, ``digest``, more) with ``run``, ``left`` and ``right``.

    ``left`` and ``right`` are the concatenated digests of the siblings before and after the node.
    """
    slot = F.col("idx") % arity
    dealt = nodes.withColumn("run", F.expr(f"idx div {arity}")).repartition("tree", "run")
    if arity == 2:
        want = F.array(F.col("idx").bitwiseXOR(F.lit(1)))
    else:
        want = F.array(*[F.col("run") * arity + (slot + step) % arity for step in range(1, arity)])
    held = dealt.select(F.col("tree").alias("tree_"), F.col("run").alias("run_"), F.col("idx").alias("idx_"), F.col("digest").alias("digest_"))
    same = (dealt["tree"] == held["tree_"]) & (dealt["run"] == held["run_"]) & F.array_contains(want, F.col("idx_"))
    siblings = F.array_sort(F.collect_list(F.when(F.col("idx_").isNotNull(), F.struct("idx_", "digest_"))))
    found = dealt.join(held, same, "left").groupBy("tree", "run", "idx")
    found = found.agg(*[F.first(x).alias(x) for x in nodes.columns if x not in ("tree", "idx")], siblings.alias("siblings"))

    def side(before: bool) -> Column:
        mine = F.filter("siblings", lambda x: (x["idx_"] < F.col("idx")) if before else (x["idx_"] > F.col("idx")))
        return F.array_join(F.transform(mine, lambda x: x["digest_"]), "")

    return found.select(*nodes.columns, "run", side(True).alias("left"), side(False).alias("right"))


def _parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The next level: every row in slot zero hashes its run."""
    first = _with_siblings(nodes.select("tree", "idx", "total", "digest"), arity).where(f"idx % {arity} = 0")
    total = F.expr(f"(total + {arity - 1}) div {arity}")
    return first.select("tree", F.col("run").alias("idx"), total.alias("total"), F.sha2(F.concat("digest", "right"), 256).alias("digest"))


def _levels(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """Leaves, then the nodes of each further level of the trees that have one."""
    levels = [leaves]
    most = leaves.agg(F.max("total")).first()[0] or 0
    while most > 1:
        levels.append(stored(_parents(levels[-1].where("total > 1"), arity), "level"))
        most = -(-most // arity)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """``tree`` and ``digest`` of the node each tree ends with."""
    ends = [level.where("total = 1").select("tree", "digest") for level in levels]
    return reduce(DataFrame.union, ends)


def _paths(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The leaves with ``path``, their siblings level by level and then the path of their tree's root.

    ``tops`` has one row for each ``tree``, with the ``path`` above its root and more columns, which the leaves get too.
    """
    more = [x for x in tops.columns if x not in ("tree", "path")]
    tops = tops.withColumnRenamed("tree", "tree_")
    above: DataFrame | None = None
    for level in reversed(levels):
        named = [*level.columns, "path", *more]
        paths = level.where("total = 1").join(tops, F.col("tree") == F.col("tree_")).select(*named)
        if above is not None:
            up = above.select(F.col("tree").alias("tree_"), F.col("idx").alias("run_"), F.col("path").alias("rest"), *more)
            inner = _with_siblings(level.where("total > 1"), arity)
            inner = inner.join(up, (inner["tree"] == up["tree_"]) & (inner["run"] == up["run_"]))
            own = F.array(F.struct("left", "right"))
            paths = paths.unionByName(inner.withColumn("path", F.concat(own, F.col("rest"))).select(*named))
        above = paths if level is levels[0] else stored(paths, "paths")
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.reduce(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    arity: int = ARITY,
    tamper_every: int = TAMPER_EVERY,
) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``path``, ``proof_sha256``, ``folded_root``, ``verified``.

    A row's leaf is the SHA-256 of ``fields``. The leaves of a group, ascending by id, are hashed
    ``arity`` at a time, level by level, to the group's subroot; the subroots, ordered by group (null first,
    bytewise), likewise to the root. ``path`` lists the digests left and right of the row's
    node at each level. ``folded_root`` folds the leaf up along it; rows whose id's checksum
    is divisible by ``tamper_every`` fold a leaf of the lower-cased text instead, so those with capitals must not verify.

    Null fields are part of the leaf; a null group is a group of its own; null ids come first in
    their group and are not tampered with; rows with equal ids lie by their leaf, and fully equal rows next to each
    other, each with its own proof. An empty table gives an empty result. Extra columns are not read.
    """
    values = [F.col(f"`{x}`") for x in fields]
    lower = F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)
    changed = [lower if x == text_col else F.col(f"`{x}`") for x in fields]
    tampered = F.crc32(F.col(f"`{id_col}`").cast("string")) % tamper_every == 0
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),  # the null group first, none of its name
        leaf_digest(values).alias("leaf"),
        F.when(tampered, leaf_digest(changed)).alias("other"),
    )
    leaves = stored(numbered(stored(leaves, "leaves"), "tree", ["doc_id", "leaf"]), "numbered")
    own = F.struct("doc_id", "other").alias("own")
    levels = _levels(leaves.select("tree", F.col(INDEX).alias("idx"), F.col(TOTAL).alias("total"), F.col("leaf").alias("digest"), own), arity)

    subroots = _roots(levels).select(F.lit("all").alias("tree"), F.col("tree").alias("of"), F.col("digest").alias("subroot"))
    top = stored(numbered(stored(subroots, "subroots"), "tree", ["of"]), "top")
    top = top.select("tree", F.col(INDEX).alias("idx"), F.col(TOTAL).alias("total"), F.col("subroot").alias("digest"), "of")
    top_levels = _levels(top, arity)
    end = _roots(top_levels).first()
    root = F.lit(end.digest if end else None).cast("string")
    nothing = docs.sparkSession.createDataFrame([("all", [])], f"tree string, path {PATH}")
    tops = _paths(top_levels, nothing, arity).select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"))

    proof = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    fold = folded(F.coalesce("own.other", "digest"), F.col("path"))
    return _paths(levels, tops, arity).select(
        F.col("own.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        F.sha2(proof, 256).alias("proof_sha256"),
        fold.alias("folded_root"),
        (fold == root).alias("verified"),
    )
