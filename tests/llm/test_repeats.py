"""Line and substring dedup against plain loops."""

from __future__ import annotations

import random
import re

import pytest
from brute import WORD
from pricevault.llm import repeats
from pricevault.llm.line_dedup import line_dedup
from pricevault.llm.substring_dedup import substring_dedup

KIND = "doc_id long, text string, n_removed string"


def without_words(text, gone):
    """The text without the numbered words, run by run from the last to the first."""
    spans = [m.span() for m in WORD.finditer(text)]
    k = len(spans) - 1
    while k >= 0:
        if k not in gone:
            k -= 1
            continue
        last = k
        while k - 1 in gone:
            k -= 1
        before, after = text[: spans[k][0]], text[spans[last][1] :]
        if last == len(spans) - 1:
            before = before[: spans[k - 1][1]] if k else before
        else:
            gap = re.match(r"[\x20\x09-\x0D]*", after)[0]
            if "\n" not in gap:
                after = after[len(gap) :]
            elif re.search(r"(^|\n)[\x20\x09-\x0D]*$", before):
                before, after = before[: before.rfind("\n") + 1], after[gap.rfind("\n") + 1 :]
        text = before + after
        k -= 1
    return text


def cut_words(rows, n=13):
    first: dict = {}
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - n + 1):
            if i is not None:
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (_, t) in zip(texts, rows, strict=True):
        gone = set()
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), without_words(t, gone) if t else ""))
    return out


def cut_lines(rows, n=3):
    first: dict = {}
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - n + 1):
            if i is not None:
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in texts:
        gone, seen = set(), set()
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            if key in seen or (i is not None and first[key] < i):
                gone |= set(range(k, k + n))
            seen.add(key)
        out.append((i, len(w), len(gone), "\n".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def fixture_rows():
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows: list = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(200))]
        if i % 3 == 0:
            words.insert(rng.randrange(len(words) + 1), passage)
        text = "".join(w + rng.choice((" ", "\n", "\n\n", "\t ", "   ")) for w in words)
        rows.append((rng.randrange(10**12), text))
    rows += [(i + 1, t) for i, t in rows[:10]]  # copies with larger ids
    rows += [rows[0], (rows[1][0], "other text of an id that came before " + passage)]
    rows += [(None, rows[2][1]), (None, None), (5, None), (6, ""), (7, "\n\n\n\n\n"), (8, "a b " * 50), (9, "x\ny\nz\nx\ny\nz\ny\nz")]
    rows += [(2 * 10**12, passage.upper() + " " + "long " * 30000)]
    return rows


@pytest.mark.parametrize("batch", (10, 10**6))
def test_words_equal_loops(spark, monkeypatch, batch):
    monkeypatch.setattr(repeats, "BATCH_WINDOWS", batch)
    rows = fixture_rows()
    frame = spark.createDataFrame([(i, t, "old") for i, t in rows], KIND).repartition(3)
    found = substring_dedup(frame).select("doc_id", "n_units", "n_removed", "text").collect()
    assert sorted(map(tuple, found), key=str) == sorted(cut_words(rows), key=str)


@pytest.mark.parametrize("batch", (10, 10**6))
def test_lines_equal_loops(spark, monkeypatch, batch):
    monkeypatch.setattr(repeats, "BATCH_WINDOWS", batch)
    rows = fixture_rows()
    frame = spark.createDataFrame([(i, t, "old") for i, t in rows], KIND).repartition(3)
    found = line_dedup(frame).select("doc_id", "n_units", "n_removed", "text").collect()
    assert sorted(map(tuple, found), key=str) == sorted(cut_lines(rows), key=str)


def test_untouched_texts_keep_their_form(spark):
    code = "def f(x):\n    return x\n\n# verse\t\n"
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, code), (2, f"{passage}\n\nend  of\tit\n"), (3, f"  - a\n\n{passage}\n\n  - b\n"), (4, f" \n{passage}\n "), (5, f"x \n{passage} ")]
    wide = [(*r, "n", "s", "l") for r in rows]
    frame = spark.createDataFrame(wide, "doc_id long, text string, notes string, salt string, Note_Id string")
    found = {r.doc_id: r for r in substring_dedup(frame).collect()}
    assert [found[i].text for i in range(1, 6)] == [code, rows[1][1], "  - a\n\n  - b\n", " \n\n ", "x "]
    assert {(r.notes, r.salt, r.Note_Id) for r in found.values()} == {("n", "s", "l")}


def test_spans_and_empty_table(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(20))), (2, "start " + " ".join(f"w{i}" for i in range(3, 18)) + " end")]
    found = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].removed_spans == [] and found[2].removed_spans == [[1, 16]] and found[2].text == "start end"
    assert substring_dedup(spark.createDataFrame([], KIND)).collect() == []
    assert line_dedup(spark.createDataFrame([], KIND)).collect() == []


def test_windows_are_no_longer_held_when_texts_are_moved(spark):
    from pricevault.llm.stored import stored

    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(5)], "doc_id long, text string")
    cut = substring_dedup(docs)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan and "FileScan" in plan  # the notes are read back
    kept = stored(docs.repartition(3, "doc_id"), "packed")
    assert all(".zstd." in name for name in kept.inputFiles()) and kept.count() == 5
