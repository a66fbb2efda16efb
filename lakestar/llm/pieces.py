"""Pre-tokenisation of byte-level vocabularies, and a table of distinct pieces.

``split`` finds the matches of the public split pattern for many texts at once
with array operations: a class per code point, run boundaries, the white-space
look-ahead and the seven contractions. ``PieceTable`` gives every distinct
piece a small number by an open-addressing table over its exact bytes, so that
the merges of a piece run once per worker, however often it occurs.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import tiktoken

LETTER, NUMBER, SPACE, OTHER, EDGE = range(5)


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """Class of every code point. Newly assigned letters differ between Unicode versions,
    so the classes are asked of the rank library, whose ids ours have to equal."""
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        matcher = tiktoken.Encoding(f"class{kind}", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        for at in range(0, len(points), 4096):
            for c in bytes(matcher.encode_ordinary("".join(points[at : at + 4096]))).decode("utf-8"):
                classes[ord(c)] = kind
    return classes


class Pieces(NamedTuple):
    buffer: np.ndarray  # UTF-8 of all texts, one separator byte between two, 16 zero bytes at the end
    begin: np.ndarray  # byte offsets of the pieces
    end: np.ndarray
    per_text: np.ndarray  # pieces of each text


def split(texts: list[str]) -> Pieces:
    """Pieces of all texts in order. A text's end is an end for the look-ahead too."""
    joined = "\0".join(texts)
    raw = joined.encode("utf-8")
    buffer = np.frombuffer(raw + bytes(16), dtype=np.uint8)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    n = len(points)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Pieces(buffer, none, none, np.zeros(len(texts), dtype=np.int64))
    kinds = code_point_classes()[points]
    kinds[text_begin[1:] - 1] = EDGE

    starts = np.empty(n + 1, dtype=bool)
    starts[0] = starts[n] = True
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:n])
    # the last white space before a non-space is a piece of its own, or joins the next one if it is a plain space
    blank = kinds == SPACE
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kinds[1:] != EDGE))
    starts[last] = True
    starts[last + 1] = points[last] != 32
    _contractions(points, kinds, starts, n)

    at = np.flatnonzero(starts)
    begin, end = at[:-1], at[1:]
    real = kinds[begin] != EDGE
    begin, end = begin[real], end[real]
    per_text = np.diff(np.append(np.searchsorted(begin, text_begin), len(begin)))
    if len(raw) != n:
        widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        offset = np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))
        begin, end = offset[begin], offset[end]
    return Pieces(buffer, begin, end, per_text)


def _contractions(points: np.ndarray, kinds: np.ndarray, starts: np.ndarray, n: int) -> None:
    """'s 't 'm 'd 're 've 'll where a piece starts with the apostrophe."""
    at = np.flatnonzero((points[:-1] == 39) & (kinds[:-1] == OTHER)) if n > 1 else np.zeros(0, np.int64)
    at = at[starts[at]]
    if not len(at):
        return
    first = points[at + 1]
    one = np.isin(first, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
    rest = at[~one & (at + 2 < n)]
    a, b = points[rest + 1], points[rest + 2]
    two = rest[((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))]
    one = at[one]
    # a text's edge cannot be part of a contraction
    one, two = one[kinds[one + 1] != EDGE], two[(kinds[two + 1] != EDGE) & (kinds[two + 2] != EDGE)]
    starts[one + 1] = False
    starts[one + 2] = True
    starts[two + 1] = False
    starts[two + 3] = True


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class PieceTable:
    """Numbers distinct pieces 0, 1, ... by their exact bytes.

    Pieces of up to 16 bytes live in an open-addressing table keyed by two
    words and the length; longer ones in a dict. Beyond ``limit`` pieces the
    table starts anew, which costs time and changes no result.
    """

    def __init__(self, limit: int = 400_000, bits: int = 21) -> None:
        self.limit, self.bits = limit, bits
        self.reset()

    def reset(self) -> None:
        self.size = 0
        self._slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self._low = np.zeros(1 << 12, dtype=np.uint64)
        self._high = np.zeros(1 << 12, dtype=np.uint64)
        self._length = np.zeros(1 << 12, dtype=np.int64)
        self._long: dict[bytes, int] = {}

    def full(self) -> bool:
        return self.size > self.limit

    def _grow(self, size: int) -> None:
        while size > len(self._low):
            for name in ("_low", "_high", "_length"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))

    def number(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of each piece, begin and end of the pieces numbered for the first time, in order)."""
        begin, length = pieces.begin, pieces.end - pieces.begin
        out = np.empty(len(begin), dtype=np.int32)
        short = length <= 16
        all_short = bool(short.all())
        at = slice(None) if all_short else np.flatnonzero(short)
        ids, new = self._short(pieces.buffer, begin[at], length[at])
        out[at] = ids
        new_begin, new_end = begin[at][new], (begin + length)[at][new]
        if not all_short:
            more = []
            raw = pieces.buffer
            for i in np.flatnonzero(~short).tolist():
                b, e = int(begin[i]), int(begin[i] + length[i])
                key = raw[b:e].tobytes()
                k = self._long.get(key)
                if k is None:
                    k = self._long[key] = self.size
                    self.size += 1
                    more.append((b, e))
                out[i] = k
            self._grow(self.size)
            if more:
                extra = np.array(more, dtype=np.int64)
                new_begin, new_end = np.append(new_begin, extra[:, 0]), np.append(new_end, extra[:, 1])
        return out, new_begin, new_end

    def _short(self, buffer: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer.data, strides=(1,))
        low = words[begin] & _MASKS[np.minimum(length, 8)]
        high = np.zeros(len(begin), dtype=np.uint64)
        wide = np.flatnonzero(length > 8)
        high[wide] = words[begin[wide] + 8] & _MASKS[length[wide] - 8]
        h = (low * _MIX[0]) ^ (high * _MIX[1]) ^ (length.astype(np.uint64) * _MIX[2])
        h ^= h >> np.uint64(29)
        h *= _MIX[3]
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        wrap = (1 << self.bits) - 1
        ids = np.full(len(begin), -1, dtype=np.int32)
        pending, missing = np.arange(len(begin)), []
        while len(pending):
            found = self._slots[slot[pending]]
            empty = found < 0
            missing.append(pending[empty])
            used = ~empty
            pending, found = pending[used], found[used]
            hit = (self._low[found] == low[pending]) & (self._high[found] == high[pending]) & (self._length[found] == length[pending])
            ids[pending[hit]] = found[hit]
            pending = pending[~hit]
            slot[pending] = (slot[pending] + 1) & wrap
        missed = np.concatenate(missing) if missing else np.zeros(0, np.int64)
        if not len(missed):
            return ids, missed
        missed.sort()
        low_m, high_m, length_m, slot_m = low[missed], high[missed], length[missed], slot[missed]
        owner = np.full(len(missed), -1, dtype=np.int64)
        active = np.arange(len(missed))
        while len(active):
            # occurrences that meet at an empty slot write their own mark; whoever stays owns the slot
            free = active[self._slots[slot_m[active]] == -1]
            self._slots[slot_m[free]] = -(free + 2)
            mark = self._slots[slot_m[active]]
            holder = np.where(mark <= -2, -(mark.astype(np.int64)) - 2, 0)
            same = (mark <= -2) & (low_m[holder] == low_m[active]) & (high_m[holder] == high_m[active]) & (length_m[holder] == length_m[active])
            owner[active[same]] = holder[same]
            active = active[~same]
            slot_m[active] = (slot_m[active] + 1) & wrap
        winners = np.flatnonzero(owner == np.arange(len(missed)))
        numbers = np.full(len(missed), -1, dtype=np.int32)
        numbers[winners] = self.size + np.arange(len(winners), dtype=np.int32)
        self._slots[slot_m[winners]] = numbers[winners]
        self._grow(self.size + len(winners))
        span = slice(self.size, self.size + len(winners))
        self._low[span], self._high[span], self._length[span] = low_m[winners], high_m[winners], length_m[winners]
        self.size += len(winners)
        ids[missed] = numbers[owner]
        return ids, missed[winners]
