"""Joins in which one key may hold a large share of the rows.

Spark's adaptive skew join splits a large partition only when both join sides come
straight from a shuffle. Here every key is cut into pieces, whatever its size, so there is
one plan for all data: no search for heavy keys, no threshold, no cap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = "_piece"


def spread_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    piece: Column,
    how: str = "inner",
    pieces_from: DataFrame | None = None,
    pieces: Sequence[int] = (),
) -> DataFrame:
    """Join many rows to few on ``key`` (NULL equals NULL), each key's rows cut into pieces.

    ``piece`` is computed from the rows of ``facts`` and must be the same when a task is run
    again. The pieces that occur are gathered as one set for each key, from map-side sets, and these
    meet ``dim`` on the key; the rows then meet the (key, piece) pairs. A key's rows so lie in as many
    tasks as it has pieces, and a pair is moved once, where the rows of its piece go. ``how`` is ``inner`` or ``left_anti``. The pairs come from
    ``pieces_from``, a plain scan with the same keys and pieces, where ``facts`` is itself a join. Where all numbers that ``piece``
    can have are given as ``pieces``, and are few, nothing is gathered: ``dim`` goes to each of them.
    """
    if how not in ("inner", "left_anti"):
        raise ValueError("how must be 'inner' or 'left_anti'")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(PIECE).eqNullSafe(F.col("_at"))
    if pieces:
        met = dim.withColumnRenamed(key, "_key").withColumn("_at", F.explode(F.array(*[F.lit(p) for p in pieces])))
        return facts.withColumn(PIECE, piece).join(met, same, how).drop(PIECE, "_key", "_at")
    source = facts if pieces_from is None else pieces_from
    # Structs: sets leave out NULL pieces, and NULL keys in them are equal, so that the sets' shuffle is the join's.
    sets = source.groupBy(F.struct(F.col(key).alias("k")).alias("_of")).agg(F.collect_set(F.struct(piece.alias("at"))).alias("_pieces"))
    few = dim.withColumn("_dim_key", F.struct(F.col(key).alias("k"))).drop(key)
    known = sets.join(few, F.col("_of") == F.col("_dim_key"), "left_semi" if how == "left_anti" else how).drop("_dim_key")
    met = known.withColumn("_pieces", F.explode("_pieces")).withColumns({"_key": F.col("_of.k"), "_at": F.col("_pieces.at")})
    met = met.drop("_of", "_pieces")
    return facts.withColumn(PIECE, piece).join(met, same, how).drop(PIECE, "_key", "_at")


def hash_piece(*names: str, pieces: int = 256) -> Column:
    """One of ``pieces`` numbers by the hash of the columns."""
    return F.pmod(F.xxhash64(*names), F.lit(pieces))
