"""Split texts by a tokenizer's pattern, and keep the ids of pieces that come again."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex

#: White space as the Unicode property has it, the meaning of ``\\s`` in the tokenizer's pattern.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same classes below U+0250, where the standard module's explicit ranges are enough.
LATIN = {"p{L}": r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "p{N}": r"0-9\xb2\xb3\xb9\xbc-\xbe", "s": r"\t-\r \x85\xa0"}
FULL = {"s": SPACE}
BELOW_250 = re.compile("[\0-\u024f]*")


def _spelled(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with its class escapes written as ranges."""
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        name = part[1:]
        if part in "[]":
            inside = part == "["
        elif part[0] == "\\" and name in classes:
            part = classes[name] if inside else f"[{classes[name]}]"
        elif part == r"\S" and not inside:
            part = f"[^{classes['s']}]"
        out.append(part)
    return "".join(out)


@lru_cache
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that lists all matches of the pattern in a text."""
    common = re.compile(spelled) if r"\p" not in (spelled := _spelled(pattern, LATIN)) else None
    full = regex.compile(_spelled(pattern, FULL))

    def split(text: str) -> list[str]:
        if common and BELOW_250.fullmatch(text):
            return common.findall(text)
        return full.findall(text)

    return split


class PieceCache:
    """Ids of pieces as little-endian uint32 bytes, computed once while they stay in memory.

    ``encode`` gets a list of distinct unknown pieces. At most ``most`` pieces of up to
    ``longest`` characters are held; a full cache is emptied and filled anew.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 300_000, longest: int = 64):
        self.encode, self.most, self.longest, self.known = encode, most, longest, {}

    def __call__(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of each text, given as its pieces."""
        pieces = set().union(*texts)
        if len(self.known) + len(pieces - self.known.keys()) > self.most:
            self.known.clear()
        missing = list(pieces - self.known.keys())
        self.known.update(zip(missing, self.encode(missing), strict=True))
        found = [b"".join(map(self.known.__getitem__, text)) for text in texts]
        for piece in missing:
            if len(piece) > self.longest:
                del self.known[piece]
        return found
