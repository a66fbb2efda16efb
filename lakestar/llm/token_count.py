"""Operator 4: token counts by heap and linked list.

The symbols of a piece form a linked list; a heap holds the adjacent pairs that
the vocabulary merges. The lowest-rank, leftmost pair is popped again and again
until none is left; stale heap entries are recognised by their symbols. The
count is the initial symbols minus the merges; ids are never built. A distinct
piece is counted once per worker (``PieceTable``), and special strings inside a
text count one each.

Defined results: a null or empty text has no bytes and no tokens; a null key
stays null; repeated rows give repeated rows; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakestar.llm import bpe
from lakestar.llm.common import bounded_batches, keyed_text, steps, texts_of
from lakestar.llm.pieces import PieceTable, split

SHIFT = 20  # symbols are below 2**20
PLACE = 40  # positions in a piece are below 2**40
POSITION = (1 << PLACE) - 1


class Counter:
    """Token counts of texts under one merge file."""

    def __init__(self, path: str) -> None:
        merges, self.special = bpe.merge_file(path)
        keys = (merges.left.astype(np.int64) << SHIFT) | merges.right
        # pair -> rank, placed above a position: heap entries are plain numbers that order by rank, then from the left
        self.pairs = dict(zip(keys.tolist(), (merges.rank.astype(np.int64) << PLACE).tolist()))
        self.result = merges.result.tolist()
        self.byte_symbol = merges.byte_symbol
        self.table = PieceTable(limit=1_000_000, bits=22)
        self.counts = np.zeros(1 << 12, dtype=np.int64)

    def piece(self, symbols: list[int]) -> int:
        """Symbols left of one piece after all merges."""
        n = len(symbols)
        if n < 2:
            return n
        get, result = self.pairs.get, self.result
        heap = [found + i for i, pair in enumerate(zip(symbols, symbols[1:])) if (found := get((pair[0] << SHIFT) | pair[1])) is not None]
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        left = n
        while heap:
            entry = heappop(heap)
            i = entry & POSITION
            j = after[i]
            if j >= n or symbols[i] < 0 or get((symbols[i] << SHIFT) | symbols[j]) != entry - i:
                continue  # one of the two has been merged since
            symbols[i] = merged = result[entry >> PLACE]
            symbols[j] = -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = get((merged << SHIFT) | symbols[k])
                if new is not None:
                    heappush(heap, new + i)
            h = before[i]
            if h >= 0:
                new = get((symbols[h] << SHIFT) | merged)
                if new is not None:
                    heappush(heap, new + h)
        return left

    def count(self, texts: list[str]) -> np.ndarray:
        parts, owner, special = bpe.cut_special(texts, self.special)
        if self.table.full():
            self.table.reset()
        pieces = split(parts)
        known = self.table.size
        number, begin, end = self.table.number(pieces)
        if len(begin):
            while self.table.size > len(self.counts):
                self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
            symbols, piece = self.byte_symbol[pieces.buffer], self.piece
            self.counts[known : self.table.size] = [piece(symbols[b:e].tolist()) for b, e in zip(begin.tolist(), end.tolist())]
        total = np.concatenate(([0], np.cumsum(self.counts[number])))
        last = np.concatenate(([0], np.cumsum(pieces.per_text)))
        per_part = total[last[1:]] - total[last[:-1]]
        if owner is None:
            return per_part
        return np.bincount(owner, weights=per_part + (special >= 0), minlength=len(texts)).astype(np.int64)


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """The worker's counter for a merge file; kept between tasks of a worker."""
    return Counter(path)


def token_counts(df: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("key")
            for a, b in steps(texts):
                n = tokens.count(texts[a:b])
                sizes = [len(t.encode("utf-8")) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)], ["key", "n_bytes", "n_tokens", "over_limit"])

    bounded_batches(df.sparkSession)
    return keyed_text(df, id_col, text_col).mapInArrow(run, "key long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("key", id_col)
