"""Byte-level BPE for whole Arrow batches: each distinct pre-token goes through the tokenizers library once.

The library's own pre-tokenizer splits a text by a fixed pattern before any merge, so the ids of a text are those of
its pre-tokens end to end. For texts whose characters are all below LIMIT the split is done here on arrays of code
points; a text with any other character, or with a special token's string, goes to the library whole.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

from tarnwheel.llm.textarrays import KEPT, blocks, range_hashes

#: Code points that are split here: Basic Latin to Latin Extended-B.
LIMIT = 0x250
#: Distinct pre-tokens that a worker remembers before it forgets those found in one block only.
REMEMBERED = 500_000
#: Pre-tokens sent to the library at once; each has some kilobyte of its own there.
AT_ONCE = 1024
SPACE, LETTER, NUMBER, OTHER = range(4)
_WHITE = (*range(9, 14), 32, 0x85, 0xA0)
_CLASS = np.array([SPACE if c in _WHITE else LETTER if unicodedata.category(chr(c))[0] == "L" else NUMBER if unicodedata.category(chr(c))[0] == "N" else OTHER for c in range(LIMIT)], np.uint8)
_SHORT = np.zeros(LIMIT, bool)
_SHORT[[ord(c) for c in "stmd"]] = True


def split(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in texts of code points below LIMIT; text r lies at offsets[r] .. offsets[r + 1].

    Fixed pattern: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    n = len(points)
    kind = _CLASS[points]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    white, blank = kind == SPACE, points == 32
    begin = first[:n].copy()
    last = first[1:]
    begin[1:] |= kind[1:] != kind[:-1]
    joined = np.zeros(n, bool)  # a lone or last blank goes with what follows it
    joined[1:] = blank[:-1] & ~white[1:] & ~first[1:n]
    begin &= ~joined
    # the last white character of a run is cut off the run, unless the text ends with it
    begin[:-1] |= white[:-1] & ~white[1:] & ~last[:-1]
    quotes = np.flatnonzero((points == 39) & begin)
    if len(quotes):
        at = lambda k: np.where(quotes + k < n, points[np.minimum(quotes + k, n - 1)], 0)
        end = np.searchsorted(offsets, quotes, "right")
        room = offsets[end] - quotes
        a, b = at(1), at(2)
        two = (room > 1) & _SHORT[a]
        three = (room > 2) & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        size = np.where(two, 2, np.where(three, 3, 0))
        quotes, size, room = quotes[size > 0], size[size > 0], room[size > 0]
        begin[quotes + 1] = False
        after = (quotes + size)[room > size]
        begin[after] |= ~joined[after]
    return np.flatnonzero(begin)


class Encoder:
    """A tokenizer of the tokenizers library with a memory of distinct pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and each thread would keep memory of its own
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keys = None
        self._forget()

    def _forget(self) -> None:
        """Keeps what was found in several blocks, if that is under half of what may be remembered; else nothing."""
        kept = np.flatnonzero(self.found > 1) if self.keys is not None else []
        if not 0 < len(kept) < REMEMBERED // 2:
            self.keys, self.slots, self.found = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
            self.begins, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)
            return
        begin = self.begins[self.slots[kept]]
        size = self.begins[self.slots[kept] + 1] - begin
        total = np.concatenate([[0], np.cumsum(size)])
        self.ids = self.ids[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        self.begins, self.keys, self.slots = total, self.keys[kept], np.arange(len(kept))
        self.found = np.ones(len(kept), np.uint8)  # to be found again before the next time

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        found = [ids for a in range(0, len(texts), AT_ONCE) for ids in self._whole(texts[a : a + AT_ONCE])]
        slots = np.arange(len(self.begins) - 1, len(self.begins) - 1 + len(keys))
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum([len(x) for x in found])])
        self.ids = np.concatenate([self.ids, *found])
        where = np.searchsorted(self.keys, keys)
        self.keys, self.slots, self.found = np.insert(self.keys, where, keys), np.insert(self.slots, where, slots), np.insert(self.found, where, 0)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block's texts end to end, and where each text's ids begin."""
        text = data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le" if sys.byteorder == "little" else "utf-32-be"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        wide = np.concatenate([[0], np.cumsum(points >= LIMIT)])
        odd = wide[at[1:]] > wide[at[:-1]]
        for special in self.specials:
            spot = text.find(special)
            while spot >= 0:
                odd[min(len(odd) - 1, int(np.searchsorted(at, spot, "right")) - 1)] = True
                spot = text.find(special, spot + 1)
        if odd.any():
            out = []
            for r in range(len(odd)):
                out.append(self._whole([text[at[r] : at[r + 1]]])[0] if odd[r] else self._plain(text[at[r] : at[r + 1]], points[at[r] : at[r + 1]], np.array([0, at[r + 1] - at[r]]))[0])
            return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])
        return self._plain(text, points, at)

    def _plain(self, text: str, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = split(points, at)
        ends = np.append(starts[1:], len(points))[: len(starts)]
        keys, one, each = np.unique(range_hashes(points, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._forget()
        where = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = where < len(self.keys)
        new[inside] = self.keys[where[inside]] != keys[inside]
        if new.any():
            self._learn(keys[new], [text[a:b] for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)])
            where = np.searchsorted(self.keys, keys)
        self.found[where] += self.found[where] < 2
        slot = self.slots[where][each]
        begin, size = self.begins[slot], self.begins[slot + 1] - self.begins[slot]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, at)]

    def column(self, column: pa.Array):
        """For each block of a string column: (first row, row after the last, ids, where each text's ids begin)."""
        for a, b, data, offsets in blocks(column):
            yield (a, b, *self.block(data, offsets))


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, until another operator's task drops it."""
    return Encoder(path)


KEPT["encoder"] = encoder.cache_clear
