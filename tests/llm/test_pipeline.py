"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

import random

import corpus_pipeline
from brute import near_classes
from pricevault.llm.stored import stored
from test_packing import checked
from test_quality import counts, verdict
from test_repeats import cut_lines, cut_words

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def expected(rows):
    """Rows (doc_id, text) after each stage but the last."""
    rows = [(i, t) for i, t in rows if not counts(t)[-1] and verdict(t)]
    yield rows
    rows = [(i, t) for i, _, _, t in cut_lines(rows)]
    yield rows
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    classes = near_classes([(n, rows[k][1]) for n, k in enumerate(order)])
    rows = [rows[k] for n, k in enumerate(order) if classes[n] == n]
    yield rows
    yield [(i, t) for i, _, _, t in cut_words(rows)]


def compare(spark, docs, sf_dir):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], expected(rows), strict=True):
        docs = stored(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns, name
        found = docs.collect()
        assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(want, key=str), name
        assert all(r.n_chars == len(r.text) for r in found), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    if len({i for i, _ in want}) == len(want):
        checked(want, pieces, 2048)
    else:  # repeated and null ids: every document starts once
        assert sorted((p.doc_id for p in pieces if p.start == 0), key=str) == sorted((i for i, _ in want), key=str)
    return want


def test_given_documents(spark, sf_dir):
    compare(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)


def test_small_fixture(spark, sf_dir):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    footer = "\n".join(" ".join(rng.choices(vocabulary, k=9)) for _ in range(4))
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts: list = [None, "", "too short", "again and again " * 60]
    for i in range(40):
        lines = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(rng.randrange(3, 30))]
        text = "\n".join(lines) + (f"\n{footer}" if i % 3 == 0 else "") + (f" {passage}" if i % 4 == 0 else "")
        texts += [text, text.replace("w1", "v1", 1)] if i % 5 == 0 else [text]
    rows = [(i, t, "en", None, len(t or "")) for i, t in enumerate(texts)]
    kept = compare(spark, spark.createDataFrame(rows, KIND), sf_dir)
    assert len(kept) >= 40 and sum(passage in t for _, t in kept) == 1


def test_unlike_rows_keep_their_form_names_and_ids(spark, sf_dir):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]

    def prose(k=40, sep=" "):
        return sep.join(rng.choices(vocabulary, k=k))

    code = "def f(x):\n    return x\n\n# " + prose() + "\n\n  - " + prose(20, "\n  - ") + "\n"
    passage = prose(60)
    rows = [(7, prose()), (7, prose()), (7, code), (None, prose()), (None, prose()), (3, prose(5000, "\n") + " Long " * 3)]
    rows += [(11, prose(80)), (12, f"{prose()}\n\n{passage}\n\n{prose()}"), (13, f"{prose()}\n\n{passage}\n\n{prose()}")]
    rows += [(14, rows[6][1]), (14, rows[6][1]), (None, rows[6][1])]  # copies of 11
    names = ["n_removed", "n_units", "removed_spans", "kept", "row", "member", "column_0", "__copy", "__kept", "class_id", "notes"]
    kind = "doc_id long, text string, n_chars int" + "".join(f", {x} int" for x in names)
    docs = spark.createDataFrame([(i, t, len(t), *range(777, 777 + len(names))) for i, t in rows], kind)
    kept = compare(spark, docs, sf_dir)
    assert [t for i, t in kept if i == 7 and "def" in t] == [code] and len(kept) == 9
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "test")
    assert {tuple(r[x] for x in names) for r in docs.collect()} == {tuple(range(777, 777 + len(names)))}


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], KIND)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.collect() == []
        docs = spark.createDataFrame([], KIND)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect() == []


def test_run_is_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *_, last = expected([(r.doc_id, r.text) for r in docs.collect()])
    checked(last, corpus_pipeline.run(spark, sf_dir).collect(), 2048)
