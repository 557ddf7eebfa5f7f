"""The Merkle manifest against a plain tree; the SQL comparison is in test_text_oracles."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pricevault.llm.merkle import merkle_manifest
from pricevault.llm.positions import numbered

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x) -> str:
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(r, text) -> str:
    return H(*map(field, (r[0], r[3], r[2], r[4], text)))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(digests: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and the digests left and right of each leaf's node at each level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(a, min(a + arity, len(digests))) for a in range(0, len(digests), arity)]
        for run in runs:
            for at in run:
                sides = ("".join(digests[i] for i in run if i < at), "".join(digests[i] for i in run if i > at))
                for m in members[at]:
                    paths[m].append(sides)
        members = [[m for i in run for m in members[i]] for run in runs]
        digests = [H(*(digests[i] for i in run)) for run in runs]
    return digests[0], paths


def expected(rows, arity=16):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        mine = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        subs[s] = (mine, *tree([leaf(r, r[1]) for r in mine], arity))
    root, tops = tree([subs[s][1] for s in order], arity)
    out = []
    for s, top in zip(order, tops, strict=True):
        mine, subroot, paths = subs[s]
        for r, path in zip(mine, paths, strict=True):
            steps = path + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r, lower(r[1]) if bad else r[1])
            for a, b in steps:
                node = H(a, node, b)
            out.append((r[0], leaf(r, r[1]), subroot, root, H(*(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def found(frame, **options):
    rows = merkle_manifest(frame, **options).collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows), key=str)


def fixture_rows():
    rng = random.Random(12)
    rows = []
    for source, n in (("hot", 290), ("b", 17), ("c", 16), ("one", 1), (None, 33), ("", 2), ("é", 5), ("Z", 3), *((f"s{i}", 2) for i in range(20))):
        rows += [(None, rng.choice([None, "", "Abc Ä", "xyz"]), rng.choice([None, "en"]), source, rng.choice([None, 3])) for _ in range(n)]
    ids = rng.sample(range(10**6), len(rows))
    return [(i, *r[1:]) for i, r in zip(ids, rows, strict=True)]


@pytest.mark.parametrize("arity", [16, 2])
def test_equals_a_plain_tree(spark, arity):
    rows = fixture_rows()
    got = found(spark.createDataFrame(rows, KIND).repartition(7), arity=arity)
    assert got == expected(rows, arity)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_null_ids_repeated_rows_and_a_very_long_text(spark):
    rows = [(None, "a", "en", "s", 1), (None, "B", "en", "s", 1), (7, "Same", "en", "s", 4), (7, "Same", "en", "s", 4), (7, "other", None, "s", 5)]
    rows += [(8, "Long " * 400_000, "en", "s", None), (9, None, None, None, None)]
    assert found(spark.createDataFrame(rows, KIND)) == expected(rows)


def test_extra_columns_and_clashing_names(spark):
    rows = fixture_rows()[:60]
    names = "tree, idx, total, digest, path, run, leaf, __index, __total, __tie, __range".split(", ")
    wide = spark.createDataFrame([(*r, *names) for r in rows], KIND + "".join(f", {x} string" for x in names))
    assert found(wide) == expected(rows)


def test_one_row_and_no_row(spark):
    rows = [(5, "Alone", "en", "s", 5)]
    assert found(spark.createDataFrame(rows, KIND)) == expected(rows)
    assert found(spark.createDataFrame([], KIND)) == []


def test_numbers_of_a_group_over_many_ranges(spark):
    frame = spark.range(0, 5000, numPartitions=9).selectExpr("if(id % 3 = 0, 'hot', cast(id % 11 as string)) AS g", "cast(id div 4 as int) AS k")
    rows = numbered(frame.repartition(5), "g", ["k"]).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.g].append((r["__index"], r.k, r["__total"]))
    assert sum(map(len, groups.values())) == 5000
    for mine in groups.values():
        mine.sort()
        assert [i for i, _, _ in mine] == list(range(len(mine))) and {t for *_, t in mine} == {len(mine)}
        assert [k for _, k, _ in mine] == sorted(k for _, k, _ in mine)
