"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, n: int = 5) -> Counter:
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def near_classes(rows: list[tuple[int, str | None]], least: float = 0.8) -> dict[int, int]:
    """Least id of each document's class, all pairs compared."""
    root = {i: i for i, _ in rows}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, t or "", shingles(t)) for i, t in rows]
    for n, (i, t, s) in enumerate(sets):
        for j, u, r in sets[:n]:
            if t == u or similarity(s, r) >= least:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}
