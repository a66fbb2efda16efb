"""Re-Pair grammars over blocks of token ids (operator 11).

Frequent pairs of neighbouring symbols are replaced by new symbols, round after
round. A round counts all pairs of the block, takes those at least 1/``SHARE`` as
frequent as the most frequent one, and replaces them from the most frequent down
where they don't overlap; a pair never spans two documents. It ends when no pair
occurs ``LEAST`` times or the symbols' width has no number left. Rules of a round
are made of symbols of earlier rounds, so a grammar is as deep as its rounds, and
a slice of ids is decoded level by level, of which only the symbols that reach
into the slice are kept: their expansion lengths are stored with the rules.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: A pair that occurs less often is no rule.
LEAST = 4
#: A round takes pairs down to this part of the most frequent one.
SHARE = 32
#: Rules of a block whose ids need more than 16 bits.
RULES = 1 << 16
#: Positions looked at in one step.
STEP = 1 << 16


class Grammar(NamedTuple):
    first: int  # symbols from here on are rules
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # ids that a rule expands to

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), dtype=np.int64)
        rule = np.flatnonzero(symbols >= self.first)
        out[rule] = self.length[symbols[rule] - self.first]
        return out

    def expand(self, symbols: np.ndarray, begin: int = 0, end: int | None = None) -> np.ndarray:
        """The ids ``begin`` to ``end`` of what the symbols stand for."""
        if begin or end is not None:
            symbols, begin, end = self._reach(symbols, begin, end)
        while True:
            rule = np.flatnonzero(symbols >= self.first)
            if not len(rule):
                return symbols[begin:end]
            at = symbols[rule].astype(np.int64) - self.first
            out = np.empty(len(symbols) + len(rule), dtype=symbols.dtype)
            right = rule + np.arange(1, len(rule) + 1)
            plain = np.ones(len(out), dtype=bool)
            plain[right] = False
            out[plain] = symbols
            out[right - 1] = self.left[at]
            out[right] = self.right[at]
            symbols = out
            if begin or end is not None:
                symbols, begin, end = self._reach(symbols, begin, end)

    def _reach(self, symbols: np.ndarray, begin: int, end: int | None) -> tuple[np.ndarray, int, int]:
        after = np.cumsum(self.lengths(symbols))
        total = int(after[-1]) if len(after) else 0
        end = total if end is None else min(end, total)
        if begin >= end:
            return symbols[:0], 0, 0
        a = int(np.searchsorted(after, begin, side="right"))
        b = int(np.searchsorted(after, end, side="left")) + 1
        before = int(after[a - 1]) if a else 0
        return symbols[a:b], begin - before, end - before


def width_of(ids: np.ndarray) -> int:
    """Bytes of a symbol: two if the ids leave room for rules there."""
    return 2 if int(ids.max(initial=0)) < (1 << 16) - 1 else 4


def compress(ids: np.ndarray, starts: np.ndarray) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """(grammar, symbols, first symbol of each document) of documents that begin at ``starts``."""
    first = int(ids.max(initial=0)) + 1
    wide = width_of(ids) == 4
    symbol, key_type, shift = (np.uint32, np.uint64, 32) if wide else (np.uint16, np.uint32, 16)
    room = RULES if wide else (1 << 16) - first
    s, starts = ids.astype(symbol), starts.astype(np.int64)
    left, right, length = (np.empty(0, dtype=t) for t in (symbol, symbol, np.int64))
    none = key_type(np.iinfo(key_type).max)
    while room and len(s) > 1:
        key = s[:-1].astype(key_type) << key_type(shift) | s[1:]
        inner = starts[(starts > 0) & (starts < len(s))]
        key[inner - 1] = none
        pairs, counts = _counted(key, none)
        if not len(pairs) or int(counts.max()) < LEAST:
            break
        often = np.flatnonzero(counts >= max(LEAST, int(counts.max()) // SHARE))
        often = often[np.argsort(-counts[often], kind="stable")][:room]
        at, rank = _places(key, pairs[often])
        used = np.bincount(rank, minlength=len(often))
        rules = np.flatnonzero(used >= 2)
        if not len(rules):
            break
        number = np.full(len(often), -1, dtype=np.int64)
        number[rules] = first + len(left) + np.arange(len(rules))
        stays = number[rank] >= 0
        at, rank = at[stays], rank[stays]
        chosen = pairs[often[rules]]
        a, b = (chosen >> key_type(shift)).astype(symbol), (chosen & key_type((1 << shift) - 1)).astype(symbol)
        grammar = Grammar(first, left, right, length)
        length = np.concatenate([length, grammar.lengths(a) + grammar.lengths(b)])
        left, right = np.concatenate([left, a]), np.concatenate([right, b])
        room -= len(rules)
        s[at] = number[rank].astype(symbol)
        starts = starts - np.searchsorted(at + 1, starts)
        keep = np.ones(len(s), dtype=bool)
        keep[at + 1] = False
        s = s[keep]
    return Grammar(first, left, right, length), s, starts


def _counted(key: np.ndarray, none: np.unsignedinteger) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(key)
    ordered = ordered[: int(np.searchsorted(ordered, none))]
    if not len(ordered):
        return ordered, np.empty(0, dtype=np.int64)
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[begin], np.diff(np.append(begin, len(ordered)))


def _places(key: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending positions at which a pair is replaced, and its rank; ``pairs`` go by rank."""
    order = np.argsort(pairs).astype(np.int32)
    wanted = pairs[order]
    # positions are told apart by a table of hashes, step by step so that its work stays in the cache
    mix = (lambda x: (x * np.uint32(2654435761)) >> np.uint32(12)) if key.dtype == np.uint32 else (lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44))
    marked, held = np.zeros(1 << 20, dtype=bool), np.empty(1 << 20, dtype=np.int32)
    slot = mix(wanted)
    marked[slot] = True
    held[slot] = np.arange(len(wanted))
    parts = []
    for begin in range(0, len(key), STEP):
        part = key[begin : begin + STEP]
        slot = mix(part)
        at = np.flatnonzero(marked[slot])
        found, place = part[at], held[slot[at]]
        hit = wanted[place] == found
        # a slot holds one of the pairs that share it
        miss = np.flatnonzero(~hit)
        if len(miss):
            place[miss] = np.minimum(np.searchsorted(wanted, found[miss]), len(wanted) - 1)
            hit[miss] = wanted[place[miss]] == found[miss]
        parts.append(((at[hit] + begin).astype(np.int32), order[place[hit]]))
    at, rank = (np.concatenate(x) for x in zip(*parts))
    # of a symbol repeated, every other pair
    again = np.flatnonzero((at[1:] == at[:-1] + 1) & (rank[1:] == rank[:-1])) + 1
    if len(again):
        index = np.arange(len(again))
        begin = np.maximum.accumulate(np.where(np.diff(again, prepend=-1) == 1, 0, index))
        even = np.ones(len(at), dtype=bool)
        even[again[(index - begin) % 2 == 0]] = False
        at, rank = at[even], rank[even]
    # of overlapping pairs, those more frequent than both neighbours
    touch = at[1:] == at[:-1] + 1
    better = np.ones(len(at), dtype=bool)
    better[1:] &= ~(touch & (rank[:-1] < rank[1:]))
    better[:-1] &= ~(touch & (rank[1:] < rank[:-1]))
    return at[better], rank[better]
