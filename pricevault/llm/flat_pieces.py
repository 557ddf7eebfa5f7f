"""Token ids of many texts at once: pieces are cut, looked up and laid out as flat numpy arrays.

For the byte-level pattern ``PATTERN`` and texts below U+0250, where a class of each character says all
that the pattern asks. A piece of up to 24 bytes is its own key, as three 64-bit words, so equal keys are equal
pieces; longer ones are kept in a dictionary.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from pricevault.llm.pretokens import LATIN

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Classes of characters: the NUL between texts, white space, letters, digits, others.
END, SPACE, LETTER, DIGIT, OTHER = range(5)
LIMIT = 0x250
KINDS = np.full(LIMIT, OTHER, np.uint8)
for _kind, _name in ((SPACE, "s"), (LETTER, "p{L}"), (DIGIT, "p{N}")):
    KINDS[[ord(x) for x in re.findall(f"[{LATIN[_name]}]", "".join(map(chr, range(LIMIT))))]] = _kind
KINDS[0] = END
#: What white space below U+0250 ends with; a piece that ends so is white space as a whole.
BLANKS = tuple(chr(i).encode() for i in np.flatnonzero(KINDS == SPACE).tolist())

WORDS = 3
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
MIXERS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def piece_starts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First characters of all matches of ``PATTERN``, and classes; NULs are pieces of their own.

    ``points`` are code points below U+0250 that begin and end with NUL.
    """
    kind = KINDS[points]
    start = np.ones(len(points), bool)
    start[1:] = kind[1:] != kind[:-1]
    start[1:] &= ~((points[:-1] == 32) & (kind[1:] > SPACE))  # a space begins the word after it
    start[1:-1] |= (kind[1:-1] == SPACE) & (kind[2:] > SPACE)  # the last of a run of white space before a word
    start |= kind == END
    quotes = np.flatnonzero(points == 39)
    quotes = quotes[(kind[quotes - 1] != OTHER) & (points[quotes - 1] != 32)]
    a, b = points[quotes + 1], points[np.minimum(quotes + 2, len(points) - 1)]
    one = np.isin(a, [ord(x) for x in "stmd"])
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    start[quotes[one | two] + 1] = False
    after = (quotes + 2 + two)[one | two]
    start[after[kind[after] == LETTER]] = True
    return np.flatnonzero(start), kind


class PieceTable:
    """Ids of pieces, found by open addressing over numpy arrays.

    ``encode`` gets distinct unknown pieces and gives all their ids, and how many each has. What is
    held is emptied and filled anew beyond ``most`` pieces or ``room`` ids.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 1 << 20, room: int = 1 << 23):
        self.encode, self.most, self.room = encode, most, room
        self.clear(most)

    def clear(self, pieces: int) -> None:
        bits = (2 * pieces - 1).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = [np.zeros(1 << bits, np.uint64) for _ in range(WORDS)]
        self.entry = np.zeros(1 << bits, np.int32)
        self.long: dict[bytes, int] = {}
        self.held, self.pool, self.bounds = pieces, np.empty(0, np.uint32), np.zeros(1, np.int64)

    def slots(self, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key, or the empty one where it would be, and whether it is held."""
        mixed = keys[0] * MIXERS[0]
        for key, by in zip(keys[1:], MIXERS[1:], strict=True):
            mixed ^= key * by
        mixed ^= mixed >> np.uint64(32)
        slot = (mixed * MIXERS[0] >> self.shift).astype(np.int64)
        held = self.same(keys, slot)
        todo = np.flatnonzero(~held)
        while len(todo := todo[self.keys[0][slot[todo]] != 0]):
            slot[todo] = slot[todo] + 1 & self.last
            held[todo] = self.same([key[todo] for key in keys], slot[todo])
            todo = todo[~held[todo]]
        return slot, held

    def same(self, keys: list[np.ndarray], slot: np.ndarray) -> np.ndarray:
        found = self.keys[0][slot] == keys[0]
        for mine, key in zip(self.keys[1:], keys[1:], strict=True):
            found &= mine[slot] == key
        return found

    def insert(self, keys: list[np.ndarray], slot: np.ndarray) -> np.ndarray:
        """Put unknown keys into slots, from the empty one of each on, each with the number of one of its rows; the slot of each row."""
        slot, todo = slot.copy(), np.arange(len(slot))
        while len(todo):
            free = todo[self.keys[0][slot[todo]] == 0]
            for mine, key in zip(self.keys, keys, strict=True):
                mine[slot[free]] = key[free]
            self.entry[slot[free]] = free  # of several, the last one has the slot
            todo = todo[~self.same([key[todo] for key in keys], slot[todo])]
            slot[todo] = slot[todo] + 1 & self.last
        return slot

    def add(self, pieces: list[bytes]) -> np.ndarray:
        """Entries of new pieces, with their ids."""
        ids, counts = self.encode(pieces)
        first = len(self.bounds) - 1
        self.pool = np.append(self.pool, ids)
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(counts, dtype=np.int64))
        return np.arange(first, first + len(pieces), dtype=np.int32)

    def entries(self, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of each piece, given by first byte and length; ``data`` ends with 8 spare bytes a word."""
        view = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        keys = [view[at] & MASKS[np.minimum(size, 8)]]
        for word in range(1, WORDS):
            key = np.zeros(len(at), np.uint64)
            more = np.flatnonzero(size > 8 * word)
            key[more] = view[at[more] + 8 * word] & MASKS[np.minimum(size[more] - 8 * word, 8)]
            keys.append(key)
        short = size <= 8 * WORDS
        long = [(i, data[a : a + n]) for i, a, n in zip(*(x[~short].tolist() for x in (np.arange(len(at)), at, size)), strict=True)]
        slot, held = self.slots(keys)
        unknown, fresh = np.flatnonzero(short & ~held), list({x for _, x in long} - self.long.keys())
        if len(self.bounds) + len(unknown) + len(fresh) > self.held or len(self.pool) > self.room:
            self.clear(max(self.most, len(at) + 1))
            slot, _ = self.slots(keys)
            unknown, fresh = np.flatnonzero(short), list({x for _, x in long})
        if len(unknown):
            slot[unknown] = self.insert([key[unknown] for key in keys], slot[unknown])
            row = self.entry[slot[unknown]]
            new = np.flatnonzero(row == np.arange(len(row)))  # one of equal pieces
            spans = zip(at[unknown[new]].tolist(), size[unknown[new]].tolist(), strict=True)
            self.entry[slot[unknown[new]]] = self.add([data[a : a + n] for a, n in spans])
        if fresh:
            self.long.update(zip(fresh, self.add(fresh).tolist(), strict=True))
        entry = self.entry[slot]
        for i, piece in long:
            entry[i] = self.long[piece]
        return entry

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian uint32; no text holds NUL or a character from U+0250 on."""
        joined = "\0" + "".join(f"{x}\0" for x in texts)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        at, kind = piece_starts(points)
        closing = kind[at] == END
        ends = np.flatnonzero(closing)[1:] - np.arange(1, len(texts) + 1)  # pieces up to the end of each text
        stop = np.append(at[1:], len(points))[~closing]
        at = at[~closing]
        data = joined.encode()
        if len(data) > len(points):  # what lies here takes one byte or two
            place = np.concatenate(([0], np.cumsum((points >= 128).view(np.int8), dtype=np.int64))) + np.arange(len(points) + 1)
            at, stop = place[at], place[stop]
        entry = self.entries(data + bytes(8 * WORDS), at, stop - at)
        first = self.bounds[entry]
        many = self.bounds[entry + 1] - first
        before = np.concatenate(([0], np.cumsum(many)))
        ids = self.pool[np.repeat(first - before[:-1], many) + np.arange(before[-1])].astype("<u4", copy=False).tobytes()
        cuts = (4 * before[ends]).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
