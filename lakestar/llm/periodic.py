"""Operator 13: periodic runs of words, by descending-LCP Kruskal over suffix classes.

A run is a stretch of at least ``max(shortest, 2 * period)`` words that repeats
with its smallest period and that no neighbouring word extends. For each text:

1. Words get numbers, suffixes are sorted by prefix doubling (only suffixes that
   still tie are sorted again), and the longest common prefix (LCP) of suffixes
   next to each other is counted along the text.
2. These neighbours are edges of weight LCP. In descending weight the two
   classes of suffixes are united: a union-find whose classes keep their
   positions in order, the smaller going into the larger. When positions i < j
   become neighbours within a class at weight L and j - i <= L, the words
   i .. j + L repeat with period j - i: a seed.
3. A seed whose preceding words differ is a run as it stands. Of a run, the pair
   (start, start + period) is always such a seed, since a position between them
   in the class would give a smaller period; and no seed has another period than
   the smallest, since start + that period would have been in the class before.

A run's seed has LCP = length - period >= shortest / 2, so edges below that are
left out: no run has one. Texts are worked on together in steps of bounded
characters, each with its own classes; a longer text is a step of its own, at
up to some hundred bytes a word. Words are the matches of [^\\x20\\x09-\\x0D]+.

Defined results: a null, empty or blank text has no runs and an empty collapsed
text; a null key stays null; repeated rows give repeated rows; an empty table
gives an empty result; other columns are not read. Ties do not occur: a run is
known by start and period, and runs are listed in that order.
"""

from __future__ import annotations

from array import array
from bisect import bisect, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakestar.llm.common import bounded_batches, keyed_text, steps, texts_of

#: Bytes of a text split, and words joined, at once.
SLICE = 1 << 20
#: Positions in one block of an ordered class.
BLOCK = 2048

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Numbers:
    """Numbers of words in order of appearance."""

    def __init__(self) -> None:
        self._of: defaultdict[bytes, int] = defaultdict()
        self._of.default_factory = self._of.__len__

    def of(self, text: str) -> np.ndarray:
        raw, parts, at = text.encode("utf-8", "surrogatepass"), [], 0
        while at < len(raw):
            end = at + SLICE
            while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":  # a word stays whole
                end += 1
            words = raw[at:end].split()  # bytes are split at exactly the six ASCII blanks
            parts.append(np.fromiter(map(self._of.__getitem__, words), dtype=np.int32, count=len(words)))
            at = end
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)

    def words(self) -> list[bytes]:
        return list(self._of)


class Ordered:
    """Positions in ascending order, in blocks, so that an insertion moves few of them."""

    __slots__ = ("blocks", "lows", "size")

    def __init__(self, first: int, second: int) -> None:
        self.blocks = [array("q", (first, second))]
        self.lows = [first]
        self.size = 2

    def insert(self, x: int) -> tuple[int, int]:
        """Insert; the neighbours below and above, or -1."""
        k = max(bisect_right(self.lows, x) - 1, 0)
        block = self.blocks[k]
        at = bisect(block, x)
        below = block[at - 1] if at else -1
        above = block[at] if at < len(block) else self.lows[k + 1] if k + 1 < len(self.lows) else -1
        block.insert(at, x)
        self.size += 1
        if not at:
            self.lows[k] = x
        if len(block) > BLOCK:
            self.blocks[k : k + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
            self.lows.insert(k + 1, block[BLOCK // 2])
        return below, above

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def classes(ids: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, position before it in suffix order) of suffixes of one text that share at least
    the greatest power of two within ``least`` words. ``text`` is -1 at the separators between texts."""
    rank = np.full(len(ids), -1, dtype=np.int64)
    at = np.flatnonzero(text >= 0)
    key = text[at].astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids[at]
    sa = np.empty(len(at), dtype=np.int64)
    slots, width, shared = np.arange(len(at)), 1, None
    while True:
        order = np.argsort(key)
        key, at = key[order], at[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        sa[slots] = at
        rank[at] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        tied = ~new  # ties with the one before or the one after
        tied[:-1] |= ~new[1:]
        if 2 * width > least and shared is None:
            shared = slots[1:][~new[1:]]
        slots, at = slots[tied], at[tied]
        if not len(slots):
            break
        # a tied suffix reaches its text's end with the separator, whose rank is -1, at most
        key = rank[at] * (len(ids) + 1) + rank[at + width] + 1
        width *= 2
    if shared is None:
        return sa[:0], sa[:0]
    return sa[shared], sa[shared - 1]


def common_prefixes(ids: np.ndarray, at: np.ndarray, before: np.ndarray, known: int) -> np.ndarray:
    """LCP of each pair of suffixes, of which ``known`` words are shared; ``at`` is ascending."""
    out = np.empty(len(at), dtype=np.int64)
    w = memoryview(ids)
    length, last = known, 0
    for k, (i, j) in enumerate(zip(at.tolist(), before.tolist())):
        length = max(length - i + last, known)  # at a later suffix at most the words passed are lost
        last = i
        while w[i + length] == w[j + length]:  # ends at a separator, all of which differ
            length += 1
        out[k] = length
    return out


def runs_of(ids: np.ndarray, text: np.ndarray, shortest: int) -> np.ndarray:
    """Rows (start, length, period) of all texts, by position in ``ids``, ordered by start and period."""
    least = max(1, -(-shortest // 2))
    at, before = classes(ids, text, least)
    if not len(at):
        return np.empty((0, 3), dtype=np.int64)
    order = np.argsort(at)
    at, before = at[order], before[order]
    lcp = common_prefixes(ids, at, before, 1 << (least.bit_length() - 1))
    enough = lcp >= least
    at, before, lcp = at[enough], before[enough], lcp[enough]
    order = np.argsort(-lcp, kind="stable")
    w = memoryview(ids)
    label = memoryview(np.full(len(ids), -1, dtype=np.int64))
    sets: list[Ordered | None] = []
    found: list[tuple[int, int, int]] = []

    def seed(i: int, j: int, shared: int) -> None:
        period = j - i
        if period <= shared and shared + period >= shortest and w[i - 1] != w[j - 1]:
            found.append((i, shared + period, period))

    for i, j, shared in zip(at[order].tolist(), before[order].tolist(), lcp[order].tolist()):
        a, b = label[i], label[j]
        if a < 0 and b < 0:
            if i > j:
                i, j = j, i
            label[i] = label[j] = len(sets)
            sets.append(Ordered(i, j))
            seed(i, j, shared)
            continue
        if a < 0 or b >= 0 and sets[a].size < sets[b].size:
            a, b, i, j = b, a, j, i
        if a == b:
            continue
        large = sets[a]
        small = [j] if b < 0 else sets[b]
        x = above = -1
        for y in small:
            # the pair (x, above) lasts if the next of the smaller class lies beyond it
            if 0 <= above < y:
                seed(x, above, shared)
            x = y
            below, above = large.insert(x)
            if below >= 0 and label[below] == a:
                seed(below, x, shared)
        if above >= 0:
            seed(x, above, shared)
        for x in small:
            label[x] = a
        if b >= 0:
            sets[b] = None
    return np.array(sorted((i, p, n) for i, n, p in found), dtype=np.int64).reshape(-1, 3)[:, [0, 2, 1]]


def joined(words: list[bytes], ids: np.ndarray) -> str:
    parts = [b" ".join(map(words.__getitem__, ids[k : k + SLICE].tolist())) for k in range(0, len(ids), SLICE)]
    return b" ".join(parts).decode("utf-8", "surrogatepass")


def analysed(texts: list[str], shortest: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(runs, by number of word in its text; text of each run; collapsed texts)."""
    numbers = Numbers()
    each = [numbers.of(t) for t in texts]
    sizes = np.array([len(x) for x in each], dtype=np.int64)
    # a separator, all different, before each text and after the last
    begin = np.cumsum(sizes + 1) - sizes
    ids = np.empty(int(sizes.sum()) + len(each) + 1, dtype=np.int32)
    text = np.full(len(ids), -1, dtype=np.int32)
    ids[np.append(begin - 1, len(ids) - 1)] = -1 - np.arange(len(each) + 1)
    for k, x in enumerate(each):
        ids[begin[k] : begin[k] + len(x)] = x
        text[begin[k] : begin[k] + len(x)] = k
    runs = runs_of(ids, text, shortest)
    start, length, period = runs.T
    # a word goes if a run holds it after the run's first period
    change = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    stays = np.cumsum(change)[:-1] == 0
    words = numbers.words()
    collapsed = [joined(words, x[stays[b : b + len(x)]]) for b, x in zip(begin.tolist(), each)]
    of = text[start]
    return np.column_stack([start - begin[of], length, period]), of, collapsed


def detected(df: DataFrame, shortest: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) of every row: all periodic runs, and the text's words, joined by
    blanks, without those that a run holds after its first period."""
    if shortest < 2:
        raise ValueError("a run has two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("key")
            for a, b in steps(texts):
                runs, of, collapsed = analysed(texts[a:b], shortest)
                offsets = np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in runs.T], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), rows), pa.array(collapsed, pa.string())], ["key", "runs", "collapsed"])

    bounded_batches(df.sparkSession)
    return keyed_text(df, id_col, text_col).mapInArrow(run, f"key long, runs {RUNS}, collapsed string").withColumnRenamed("key", id_col)
