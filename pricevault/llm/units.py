"""Words or lines of many texts as flat numpy arrays of 64-bit hashes.

A unit is a word (a run of bytes that are not ASCII white space) or a line (what lies between
``\\n``). A unit's hash is a polynomial over its bytes, read from one running sum for all texts
of a slice, so no Python code runs for each word. Windows of n units are hashed the Rabin-Karp
way, as a polynomial over the unit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Texts are hashed in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: Odd multipliers of the byte polynomial and of the two window polynomials.
BYTE_BASE, WINDOW_BASE, BUCKET_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F

MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the byte base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        kept = []
        for base in (BYTE_BASE, pow(BYTE_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            kept.append(np.multiply.accumulate(steps))
        if n > SLICE_BYTES + 4096:
            return kept[0], kept[1]
        _powers[:] = kept
    return _powers[0], _powers[1]


@dataclass
class Units:
    """Units of a slice of texts: hash, text number, first byte and end byte of each."""

    data: bytes
    hashes: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    count: np.ndarray  # units of each text

    def windows(self, n: int, base: int = WINDOW_BASE) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first unit of each window of n units of one text."""
        size = len(self.hashes) - n + 1
        if size <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        first = np.flatnonzero(self.owner[:size] == self.owner[n - 1 :])
        total = np.zeros(size, np.uint64)
        for j in range(n):
            total *= np.uint64(base)
            total += self.hashes[j : j + size]
        return mix(total[first]), first


def split_units(texts: list[bytes], kind: str) -> Units:
    """All units of the texts; ``kind`` is ``word`` or ``line``."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)  # one past each text's closing line break
    if kind == "line":
        end = np.flatnonzero(raw == 10)
        start = np.concatenate(([0], end[:-1] + 1)).astype(np.int64)
    else:
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(ends, start, side="right")
    up, down = powers(len(raw) + 1)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODES[raw] * up[: len(raw)], out=running[1:])
    hashes = (running[end] - running[start]) * down[start]
    hashes = mix(hashes + (end - start).astype(np.uint64) * np.uint64(BUCKET_BASE))
    return Units(data, hashes, owner, start, end, np.bincount(owner, minlength=len(texts)))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of a text column that hold about ``limit`` bytes each, with their UTF-8 texts.

    A null text counts as empty. Only one range's texts are copied at a time.
    """
    sizes = pa.compute.binary_length(column).fill_null(0).to_pylist()
    first = size = 0
    for i, more in enumerate([*sizes, limit + 1]):
        if i > first and (size + more > limit or i == len(sizes)):
            part = column.slice(first, i - first).cast(pa.binary()).to_pylist()
            yield first, i, [x or b"" for x in part]
            first, size = i, 0
        size += more


def without(names: Iterable[str], added: Iterable[str]) -> list[str]:
    """The names that an operator's own result columns don't replace (case is ignored)."""
    taken = {x.lower() for x in added}
    return [x for x in names if x.lower() not in taken]


def unused(names: Iterable[str], wish: str) -> str:
    """A column name that none of ``names`` equals, whatever the case."""
    taken = {x.lower() for x in names}
    while wish.lower() in taken:
        wish += "_"
    return wish
