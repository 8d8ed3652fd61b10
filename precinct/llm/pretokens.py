"""Pre-tokens of byte-level BPE found with numpy, and ids looked up once for each distinct pre-token.

``public_tokenizers.PATTERN`` is a choice of runs: letters, numbers, other marks (each with one blank before it),
white space, and seven short endings after an apostrophe. So the matches follow from the class of each code
point, and no regular expression has to walk over the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import regex

from precinct.llm.common import BYTE_WORDS, RollingHash, ragged

OTHER, LETTER, NUMBER, SPACE = range(4)
# The endings that the pattern splits off after an apostrophe.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


@cache
def code_point_classes() -> np.ndarray:
    """The class of every code point."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for match in regex.finditer(pattern, text):
            out[points[match.start() : match.end()]] = kind
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each UTF-8 code point in ``data``, and its value."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    value = data[at].astype(np.int32)
    wide = np.flatnonzero(value >= 0x80)
    if len(wide):
        lead = value[wide]
        size = 2 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        got = lead & (0xFF >> (size + 1))
        for k in range(1, 4):
            more = size > k
            got[more] = (got[more] << 6) | (data[at[wide[more]] + k] & 0x3F)
        value[wide] = got
    return at, value


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte position where each match begins, over all rows of ``data``; no match crosses two rows."""
    at, value = code_points(data)
    n = len(at)
    if not n:
        return at
    kind = code_point_classes()[value]
    first = np.zeros(n + 1, bool)  # where a row begins, and the end
    first[np.searchsorted(at, offsets)] = True
    first[n] = True
    begin = first[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # The last white space before something else goes by itself, or with what follows if it is a blank.
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
    begin[last] = True
    begin[last[value[last] == 0x20] + 1] = False
    apostrophe = np.flatnonzero((value == 0x27) & begin)
    if len(apostrophe):
        padded = np.concatenate([value, np.zeros(4, value.dtype)])
        ends = np.concatenate([first, np.ones(4, bool)])
        done = np.zeros(len(apostrophe), bool)
        for ending in ENDINGS:
            hit = ~done
            for k, byte in enumerate(ending, 1):
                hit &= (padded[apostrophe + k] == byte) & ~ends[apostrophe + k]
            found = apostrophe[hit]
            begin[found + 1] = False
            after = found + 1 + len(ending)
            begin[after[after < n]] = True
            done |= hit
    return at[begin]


class _Generation:
    """Pieces by hash, with their ids one after the other."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return place, self.keys[place] == keys

    def add(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Merge sorted new ``keys``, whose ids stand in ``ids`` in the same order."""
        place = np.searchsorted(self.keys, keys)
        starts = np.cumsum(counts) - counts + len(self.pool)
        self.keys = np.insert(self.keys, place, keys)
        self.starts = np.insert(self.starts, place, starts)
        self.counts = np.insert(self.counts, place, counts)
        self.pool = np.concatenate([self.pool, ids])


class PieceTable:
    """Ids of the distinct pieces seen so far, by 64-bit hash, in two generations of at most ``most`` pieces.

    A full generation becomes the old one. Pieces that are met again in the old one come back to the new one, so
    frequent pieces are never encoded anew, and the old one's rest goes with it.
    """

    def __init__(self, encode_misses: Callable[[list[bytes]], list[list[int]]], most: int = 400_000):
        self.encode_misses, self.most = encode_misses, most
        self.new, self.old = _Generation(), _Generation()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows of ``data``, and the offsets of the rows in them."""
        begins = split_pieces(data, offsets)
        ends = np.append(begins[1:], len(data))
        hashes = RollingHash(data, BYTE_WORDS).of(begins, ends)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.new.keys) > self.most:
            self.new, self.old = _Generation(), self.new
        _, known = self.new.find(keys)
        rest = np.flatnonzero(~known)
        place, known = self.old.find(keys[rest])
        if known.any():
            place = place[known]
            counts = self.old.counts[place]
            self.new.add(keys[rest[known]], counts, self.old.pool[ragged(self.old.starts[place], counts)])
        rest = rest[~known]
        if len(rest):
            missing = first[rest]
            raw = memoryview(data)
            lists = self.encode_misses([bytes(raw[a:b]) for a, b in zip(begins[missing].tolist(), ends[missing].tolist())])
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter((i for ids in lists for i in ids), np.uint32, int(counts.sum()))
            self.new.add(keys[rest], counts, ids)
        place = self.new.find(keys)[0][inverse]
        counts = self.new.counts[place]
        ids = self.new.pool[ragged(self.new.starts[place], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[np.searchsorted(begins, offsets)]
