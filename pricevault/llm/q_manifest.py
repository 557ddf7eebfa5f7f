"""Query of the Merkle manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricevault.llm.merkle import merkle_manifest
from pricevault.llm.registry import query, table

#: Fields, then the checksum of a decimal id bit by bit, then the tree of each source and that of the sources.
FIELD = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')"
CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _leaf(text: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return f"sha256({' || '.join(FIELD.format(x) for x in fields)})"


def _tree(name: str, start: str, levels: int) -> str:
    """Tables name_0 .. of (tree, idx, total, digest); a level repeats nothing of finished trees."""
    parts = [f"{name}_0 AS ({start})"]
    for k in range(1, levels + 1):
        parts.append(
            f"{name}_{k} AS (SELECT tree, idx // 16 AS idx, (any_value(total) + 15) // 16 AS total, sha256(string_agg(digest, '' ORDER BY idx)) AS digest "
            f"FROM {name}_{k - 1} WHERE total > 1 GROUP BY tree, idx // 16)"
        )
    return ",\n".join(parts)


def _ends(name: str, levels: int) -> str:
    return " UNION ALL ".join(f"SELECT tree, digest FROM {name}_{k} WHERE total = 1" for k in range(levels + 1))


def _climb(name: str, levels: int, start: str) -> str:
    """Tables up_name_0 .. that fold (id, tree, idx, proof, node) one level each, siblings in order."""
    parts = [f"up_{name}_0 AS ({start})"]
    for k in range(levels):
        parts.append(
            f"""up_{name}_{k + 1} AS (SELECT u.id, u.tree, u.idx // 16 AS idx,
  any_value(u.proof) || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx <> u.idx), '') AS proof,
  sha256(string_agg(CASE WHEN s.idx = u.idx THEN u.node ELSE s.digest END, '' ORDER BY s.idx)) AS node
  FROM up_{name}_{k} u JOIN {name}_{k} s ON s.tree = u.tree AND s.idx // 16 = u.idx // 16 AND s.total > 1
  GROUP BY u.id, u.tree, u.idx
  UNION ALL SELECT u.id, u.tree, u.idx, u.proof, u.node FROM up_{name}_{k} u
  WHERE NOT EXISTS (SELECT 1 FROM {name}_{k} s WHERE s.tree = u.tree AND s.total > 1))"""
        )
    return ",\n".join(parts)


#: Six levels hold 16 million documents a source, two hold 256 sources.
LEVELS, TOP = 6, 2
MANIFEST_SQL = f"""
WITH leaf AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS digest,
         CASE WHEN {CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_leaf("text")} END AS other FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS total FROM leaf),
{_tree("t", "SELECT tree, idx, total, digest FROM placed", LEVELS)},
sub AS ({_ends("t", LEVELS)}),
{_tree("r", "SELECT 'all' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS total, digest, tree AS source FROM sub", 0)},
{_tree("r", "SELECT 'all' AS tree, idx, total, digest FROM r_0", TOP).split("," + chr(10), 1)[1]},
root AS ({_ends("r", TOP)}),
{_climb("t", LEVELS, "SELECT doc_id AS id, tree, idx, '' AS proof, other AS node FROM placed")},
{_climb("r", TOP, f"SELECT u.id, 'all' AS tree, r.idx, u.proof, u.node FROM up_t_{LEVELS} u JOIN r_0 r ON r.source = u.tree")}
SELECT p.doc_id, p.digest AS leaf, sub.digest AS subroot, root.digest AS root, sha256(u.proof) AS proof_sha256,
       u.node AS folded_root, u.node = root.digest AS verified
FROM placed p JOIN up_r_{TOP} u ON u.id = p.doc_id JOIN sub ON sub.tree = p.tree CROSS JOIN root
"""


@query("op12_merkle_manifest", MANIFEST_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents")).drop("path")
