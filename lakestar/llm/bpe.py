"""Byte-level BPE over padded matrices.

Pieces of similar length share a matrix of symbols, one row each. In every
round each row merges its leftmost pair of the lowest rank; rows without a pair
in the vocabulary leave the matrix (compaction), the others shrink by a column.
Pair ranks come from an open-addressing table hashed by both symbols. A row of
n symbols takes up to n rounds over n columns, so pieces beyond ``WIDE`` bytes
are no rows: each is merged by a heap of its pairs over a linked list, in the
same order, in n log n steps.
"""

from __future__ import annotations

import base64
import json
from array import array
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

from lakestar.llm.pieces import Pieces, PieceTable, split

NONE = np.int32(2**31 - 1)
WIDE = 128
BUCKETS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 64, 96, WIDE)
ROWS = 1 << 15
_PLACE = 40  # positions in a piece are below 2**40
_POSITION = (1 << _PLACE) - 1


class Merges:
    """rank and resulting symbol of every pair; the bytes of every symbol."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, result: np.ndarray, symbols: dict[int, bytes], whole: bool) -> None:
        self.byte_symbol = np.zeros(256, dtype=np.int32)
        for k, b in symbols.items():
            if len(b) == 1:
                self.byte_symbol[b[0]] = k
        self.result = np.zeros(int(rank.max()) + 1 if len(rank) else 1, dtype=np.int32)
        self.result[rank] = result
        size = max(symbols) + 1
        self.symbol_length = np.zeros(size, dtype=np.int64)
        for k, b in symbols.items():
            self.symbol_length[k] = len(b)
        self.symbol_begin = np.concatenate(([0], np.cumsum(self.symbol_length)[:-1]))
        self.symbol_bytes = np.frombuffer(b"".join(symbols.get(k, b"") for k in range(size)), dtype=np.uint8)
        self.left, self.right, self.rank = left, right, rank
        self._hash(left, right, rank)
        self.whole: dict[bytes, int] = {}
        if whole:
            self._whole_pieces(symbols)

    def _hash(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(rank)) * 4))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        key = (left.astype(np.int64) << 20) | right.astype(np.int64)
        slot, wrap = self._slot(key), (1 << self.bits) - 1
        todo = np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = key[free]
            mine = self.keys[slot[todo]] == key[todo]
            self.values[slot[todo[mine]]] = rank[todo[mine]]
            todo = todo[~mine]
            slot[todo] = (slot[todo] + 1) & wrap

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE if it has none or a side is padding (-1)."""
        shape = left.shape
        key = ((left.astype(np.int64) << 20) | right.astype(np.int64)).ravel()
        out = np.full(len(key), NONE, dtype=np.int32)
        pending = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot, wrap = self._slot(key[pending]), (1 << self.bits) - 1
        while len(pending):
            held = self.keys[slot]
            hit = held == key[pending]
            out[pending[hit]] = self.values[slot[hit]]
            on = ~hit & (held != -1)
            pending, slot = pending[on], (slot[on] + 1) & wrap
        return out.reshape(shape)

    def _whole_pieces(self, symbols: dict[int, bytes]) -> None:
        """Vocabulary entries that merging alone does not reach: the rank library looks whole pieces up first."""
        entries = [(k, b) for k, b in symbols.items() if len(b) > 1]
        raw = b"".join(b for _, b in entries)
        end = np.cumsum([len(b) for _, b in entries])
        begin = np.concatenate(([0], end[:-1]))
        flat, counts = self.encode(np.frombuffer(raw + bytes(16), np.uint8), begin, end)
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        self.whole = {b: k for (k, b), c, f in zip(entries, counts.tolist(), first.tolist()) if c != 1 or flat[f] != k}

    # -- encoding

    def encode(self, buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all pieces one after the other, symbols of each piece)."""
        length = end - begin
        counts = np.zeros(len(begin), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # piece of each symbol, symbol; in order within a piece
        lower = 0
        for width in BUCKETS:
            rows = np.flatnonzero((length > lower) & (length <= width))
            lower = width
            for at in range(0, len(rows), ROWS):
                self._bucket(buffer, begin, length, rows[at : at + ROWS], width, counts, parts)
        for row in np.flatnonzero(length > WIDE).tolist():
            symbols = self._long(self.byte_symbol[buffer[begin[row] : end[row]]])
            counts[row] = len(symbols)
            parts.append((np.full(len(symbols), row, dtype=np.int64), symbols))
        if self.whole:
            parts = self._replace_whole(buffer, begin, end, counts, parts)
        if not parts:
            return np.zeros(0, np.int32), counts
        piece = np.concatenate([p for p, _ in parts])
        symbols = np.concatenate([s for _, s in parts])
        return symbols[np.argsort(piece, kind="stable")].astype(np.int32), counts

    def _replace_whole(self, buffer, begin, end, counts, parts):
        known = {}
        longest = max(map(len, self.whole))
        for i in np.flatnonzero((end - begin <= longest) & (counts > 1)).tolist():
            k = self.whole.get(buffer[begin[i] : end[i]].tobytes())
            if k is not None:
                known[i] = k
        if not known:
            return parts
        gone = np.zeros(len(begin), dtype=bool)
        gone[list(known)] = True
        counts[list(known)] = 1
        kept = [(p[~gone[p]], s[~gone[p]]) for p, s in parts]
        return [*kept, (np.array(list(known), dtype=np.int64), np.array(list(known.values()), dtype=np.int32))]

    def _bucket(self, buffer, begin, length, rows, width, counts, parts) -> None:
        n = length[rows]
        column = np.arange(width)
        inside = column < n[:, None]
        # reads beyond a piece stay inside the buffer and are masked
        at = np.minimum(begin[rows][:, None] + column, len(buffer) - 1)
        symbols = np.where(inside, self.byte_symbol[buffer[at]], -1).astype(np.int32)
        n = n.copy()
        ranks = self.ranks_of(symbols[:, :-1], symbols[:, 1:])
        while True:
            if ranks.shape[1]:
                where = ranks.argmin(axis=1)
                lowest = ranks[np.arange(len(rows)), where]
                busy = lowest != NONE
            else:
                busy = np.zeros(len(rows), dtype=bool)
            if not busy.all():
                done = ~busy
                counts[rows[done]] = n[done]
                left = symbols[done]
                real = np.arange(left.shape[1]) < n[done][:, None]
                parts.append((np.repeat(rows[done], n[done]), left[real]))
                if not busy.any():
                    return
                rows, n, symbols, ranks, where, lowest = rows[busy], n[busy], symbols[busy], ranks[busy], where[busy], lowest[busy]
            each = np.arange(len(rows))
            merged = self.result[lowest]
            columns = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, columns + (columns > where[:, None]), axis=1)
            symbols[each, where] = merged
            n = n - 1
            columns = columns[:-1]
            if not len(columns):
                ranks = np.zeros((len(rows), 0), dtype=np.int32)
                continue
            ranks = np.take_along_axis(ranks, columns + (columns >= where[:, None]), axis=1)
            before = each[where > 0]
            ranks[before, where[before] - 1] = self.ranks_of(symbols[before, where[before] - 1], merged[before])
            after = each[where < symbols.shape[1] - 1]
            ranks[after, where[after]] = self.ranks_of(merged[after], symbols[after, where[after] + 1])

    def _long(self, symbols: np.ndarray) -> np.ndarray:
        """One long piece: a heap of its pairs by rank, then place, over a linked list of its symbols."""
        n = len(symbols)
        at = np.flatnonzero((ranks := self.ranks_of(symbols[:-1], symbols[1:])) != NONE)
        heap = ((ranks[at].astype(np.int64) << _PLACE) | at).tolist()  # numbers that order by rank, then from the left
        heapify(heap)
        held = array("q", symbols.astype(np.int64).tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        rank_of, result = self.pairs.get, self.result
        while heap:
            entry = heappop(heap)
            rank, i = entry >> _PLACE, entry & _POSITION
            j = after[i]
            if j >= n or held[i] < 0 or rank_of(held[i] << 20 | held[j]) != rank:
                continue  # one of the two has been merged since
            held[i] = merged = int(result[rank])
            held[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := rank_of(merged << 20 | held[k])) is not None:
                    heappush(heap, new << _PLACE | i)
            h = before[i]
            if h >= 0 and (new := rank_of(held[h] << 20 | merged)) is not None:
                heappush(heap, new << _PLACE | h)
        left = np.frombuffer(held, dtype=np.int64)
        return left[left >= 0].astype(np.int32)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """Rank of each pair, for the pieces that are merged one pair at a time."""
        return dict(zip(((self.left.astype(np.int64) << 20) | self.right).tolist(), self.rank.tolist()))

    # -- decoding

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after the other, bytes of each id)."""
        lengths = self.symbol_length[ids]
        return gather(self.symbol_bytes, self.symbol_begin[ids], lengths), lengths


def gather(values: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[begin : begin + length] of all ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    jump = np.cumsum(lengths) - lengths
    return values[np.repeat(begin - jump, lengths) + np.arange(total)]


@lru_cache(maxsize=4)
def rank_file(path: str) -> Merges:
    """A vocabulary of ranks: any two symbols merge whose bytes together are an entry, lowest rank first."""
    ranks: dict[bytes, int] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    found = [(a, b, k, k) for token, k in ranks.items() for i in range(1, len(token)) if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
    left, right, rank, result = (np.array(x, dtype=np.int64) for x in zip(*found))
    return Merges(left, right, rank, result, {k: b for b, k in ranks.items()}, whole=True)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabularies written as text: a
    printable Latin-1 byte is its own letter, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def merge_file(path: str) -> tuple[Merges, dict[str, int]]:
    """A vocabulary with listed merges, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
    right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
    result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    symbols = {k: bytes(letters[c] for c in t) for t, k in vocab.items() if t not in special}
    symbols |= {k: t.encode() for t, k in special.items()}
    return Merges(left, right, np.arange(len(pairs)), result, symbols, whole=False), special


class Encoder:
    """Ids of many texts, with the merges of each distinct piece done once per worker."""

    def __init__(self, merges: Merges, special: dict[str, int] | None = None) -> None:
        self.merges, self.special = merges, special or {}
        self.table = PieceTable()
        self._reset()

    def _reset(self) -> None:
        self.table.reset()
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.begin = np.zeros(1 << 12, dtype=np.int64)
        self.count = np.zeros(1 << 12, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each text)."""
        parts, owner, special = cut_special(texts, self.special)
        if self.table.full():
            self._reset()
        pieces = split(parts)
        known = self.table.size
        number, new_begin, new_end = self.table.number(pieces)
        if len(new_begin):
            self._learn(known, pieces, new_begin, new_end)
        lengths = self.count[number]
        flat = gather(self.ids, self.begin[number], lengths)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        last = np.concatenate(([0], np.cumsum(pieces.per_text)))
        per_part = ends[last[1:]] - ends[last[:-1]]
        if owner is None:
            return flat, per_part
        # special ids stand at the end of the part before them
        at = np.cumsum(per_part)
        has = np.flatnonzero(special >= 0)
        flat = np.insert(flat, at[has], special[has].astype(np.uint32))
        per_part = per_part + (special >= 0)
        return flat, np.bincount(owner, weights=per_part, minlength=len(texts)).astype(np.int64)

    def _learn(self, known: int, pieces: Pieces, begin: np.ndarray, end: np.ndarray) -> None:
        flat, counts = self.merges.encode(pieces.buffer, begin, end)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while known + len(counts) > len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
            self.count = np.concatenate((self.count, np.zeros_like(self.count)))
        self.ids[self.used : self.used + len(flat)] = flat
        self.begin[known : known + len(counts)] = self.used + np.cumsum(counts) - counts
        self.count[known : known + len(counts)] = counts
        self.used += len(flat)


def cut_special(texts: list[str], special: dict[str, int]) -> tuple[list[str], np.ndarray | None, np.ndarray | None]:
    """Texts cut at special strings: (parts, text of each part, id after each part or -1)."""
    if not any(s in t for t in texts for s in special):
        return texts, None, None
    parts, owner, ids = [], [], []
    for i, text in enumerate(texts):
        at = 0
        while True:
            found = min(((p, -len(s), s) for s in special if (p := text.find(s, at)) >= 0), default=None)
            parts.append(text[at : found[0]] if found else text[at:])
            owner.append(i)
            ids.append(special[found[2]] if found else -1)
            if not found:
                break
            at = found[0] + len(found[2])
    return parts, np.array(owner), np.array(ids)


@lru_cache(maxsize=4)
def rank_encoder(path: str) -> Encoder:
    """The worker's encoder for a rank file; kept between tasks of a worker."""
    return Encoder(rank_file(path))


@lru_cache(maxsize=4)
def merge_encoder(path: str) -> Encoder:
    return Encoder(*merge_file(path))
