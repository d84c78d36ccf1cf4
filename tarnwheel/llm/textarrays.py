"""Whole Arrow batches of text as byte arrays: words, lines and n-gram hashes without a loop over rows.

Hashes of words and lines (`range_hashes`) are sums of bytes times a random 64-bit weight for each place, mixed
afterwards: two different strings have equal sums by chance alone, of 2**-57 at most, whatever their length. `rolling`
hashes are polynomials modulo 2**64 from one prefix sum, for grams that overlap; regular strings of a thousand bytes can
collide there by construction, so they only choose (features, anchors) and never decide that two strings are equal.
A null text is an empty one everywhere.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a longer text makes a block of its own.
BLOCK = 1 << 19
U64 = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C15)
_BACK = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_GRAM = (U64(0x9DDFEA08EB382D69), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5), U64(0x85EBCA77C2B2AE63))
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base to the powers 0 .. n, and its inverse to them."""
    if len(_powers.get("up", ())) < n + 1:
        size = max(n + 1, BLOCK + 1)
        for name, base in (("up", _STEP), ("down", _BACK)):
            row = np.full(size, base, U64)
            row[0] = 1
            _powers[name] = np.cumprod(row, dtype=U64)
    return _powers["up"], _powers["down"]


#: What a worker keeps from task to task, by name, as functions that drop it.
KEPT: dict[str, Callable[[], None]] = {}


def released(keep: str = "") -> None:
    """Drops what tasks of other operators have kept, but for `keep`, and gives freed memory back to the system, where the C library can: a worker lives on after its task."""
    for name, drop in KEPT.items():
        if name != keep:
            drop()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the entropy of each 64-bit value over all its bits."""
    h = h ^ (h >> U64(33))
    h *= _MIX[0]
    h ^= h >> U64(33)
    h *= _MIX[1]
    h ^= h >> U64(33)
    return h


#: Weights of the first places, which is all that most words and lines have.
_WEIGHTS = 1 << 16
_table: dict[str, np.ndarray] = {}


def _weights(place: np.ndarray, most: int) -> np.ndarray:
    """A random odd weight for each place, the same at every call."""
    if "weights" not in _table:
        _table["weights"] = mix(np.arange(1, _WEIGHTS + 1, dtype=U64) * _STEP) | U64(1)
    return _table["weights"][place] if most <= _WEIGHTS else mix((place.astype(U64) + U64(1)) * _STEP) | U64(1)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each range starts .. ends of an array of small numbers, by values and their places in the range."""
    size = ends - starts
    total = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(len(starts), U64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(total, total[a] + BLOCK, "right")) - 1)  # so much at once
        n, begin = size[a:b], total[a:b] - total[a]
        place = np.arange(int(total[b] - total[a])) - np.repeat(begin, n)
        term = _weights(place, int(n.max())) * (values[place + np.repeat(starts[a:b], n)].astype(U64) + U64(1))
        run = np.zeros(len(place) + 1, U64)
        np.cumsum(term, dtype=U64, out=run[1:])
        out[a:b] = run[begin + n] - run[begin] + n.astype(U64) * _MIX[1]
        a = b
    return mix(out)


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a string column into (first row, row after the last, bytes, offsets) blocks of about `limit` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, to, whole[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


class Block:
    """The texts of one block; `data` are their bytes end to end, text r lies at offsets[r] .. offsets[r + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets = (LOWER[data] if lower else data), offsets
        self._sums: np.ndarray | None = None

    @property
    def sums(self) -> np.ndarray:
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, U64)
            np.cumsum(_BYTE[self.data] * powers(len(self.data))[0][: len(self.data)], dtype=U64, out=self._sums[1:])
        return self._sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash for each of the words or lines starts .. ends."""
        return range_hashes(self.data, starts, ends)

    def rolling(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash for each of the overlapping substrings starts .. ends, for choosing only."""
        return mix((self.sums[ends] - self.sums[starts]) * powers(len(self.data))[1][starts])

    def cut(self, white: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes that aren't `white`, never over the end of a text: starts, ends, first run of each text."""
        solid = ~white[self.data]
        n = len(solid)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = solid[:-1]
        starts = np.flatnonzero(solid & (~before | edge[:n]))
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = solid[1:]
        ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words [^\\x20\\x09-\\x0D]+: starts, ends, index of the first word of each text (and the total at the end)."""
        return self.cut(WHITE)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The \\n-split lines: starts, ends, index of the first line of each text; an empty text has one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        firsts = np.searchsorted(breaks, self.offsets) + np.arange(len(self.offsets))
        starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([breaks, self.offsets[1:]]), kind="stable")
        return starts, ends, firsts


def owners(firsts: np.ndarray) -> np.ndarray:
    """For items numbered through all texts: the text of each."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def grams(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive items of one text, and the index of each window's first item."""
    if len(h) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(of[: len(of) - n + 1] == of[n - 1 :])
    g = np.zeros(len(at), U64)
    for k in range(n):
        g += h[at + k] * _GRAM[k % 5] + U64(k // 5)
        if n > 5:
            g = mix(g)
    return mix(g), at


def sums_by(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of values over the items of each text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[firsts[1:]] - total[firsts[:-1]]


def repeats(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks items whose hash is found more than once in their text: (any such, any but the first such)."""
    order = np.lexsort((h, of))
    same = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
    every, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    every[order[1:][same]] = True
    later[order[1:][same]] = True
    every[order[:-1][same]] = True
    return every, later
