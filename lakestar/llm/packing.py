"""Operator 6: best-fit packing of token sequences.

1. ``pieces_of``: one pass encodes every text, appends the end id and cuts what
   is longer than the capacity (the first piece may be shorter, the others are
   full). A row keeps its task, and its number among the task's pieces of that
   length; the rows are checkpointed, so both stay what they are.
2. The histogram of lengths has at most ``capacity`` rows. On it ``plan`` solves
   the configuration linear program by multiplicative weights (``program``): a
   length's price is its share of the capacity times a weight that shrinks as it
   is covered, the best pattern under the prices comes from knapsack dynamic
   programming, and every round gives its pattern the same share of the bins,
   against the whole demand. The averaged counts are rounded down; what remains
   is packed best fit, largest length first.
3. Pieces of equal length are interchangeable: the n-th of a length takes the
   n-th place of that length in the plan. Its number is a prefix sum over the
   per-task counts plus its number in the task, so no task sees all pieces of a
   length.

The plan is bounded by ``capacity`` and ``rounds`` whatever the input. Defined
results: a null or empty text is the end id alone; a null key stays null;
repeated rows are packed each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm import bpe
from lakestar.llm.common import bounded_batches, checkpointed, keyed_text, steps, texts_of

#: Rounds of the linear program.
ROUNDS = 2000
#: How fast prices follow coverage.
RATE = 0.05

PIECES = "key long, piece int, start long, length long, ids_crc32 long, task long, nth long"


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of all pieces of documents of these lengths."""
    counts = np.maximum(1, -(-lengths // capacity))
    doc = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = (lengths - (counts - 1) * capacity)[doc]
    return doc, piece, np.where(piece == 0, 0, first + (piece - 1) * capacity), np.where(piece == 0, first, capacity)


def pieces_of(df: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all texts with their checksum, task and number within task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.merge_encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("key")
            for a, b in steps(texts):
                flat, counts = encoder.encode(texts[a:b])
                flat = np.insert(flat, np.cumsum(counts), np.uint32(end_id)).astype("<u4")
                counts = counts + 1
                doc, piece, start, length = cut(counts, capacity)
                at = (np.cumsum(counts) - counts)[doc] + start
                raw = memoryview(flat).cast("B")
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at.tolist(), (at + length).tolist())]
                # number among the pieces of equal length: place in the stable order by length, from the first of it
                order = np.argsort(length, kind="stable")
                each = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(len(length), dtype=np.int64)
                nth[order] = np.arange(len(length)) - (np.cumsum(each) - each)[length[order]]
                nth += seen[length]
                seen += each
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task, dtype=np.int64)), pa.array(nth)],
                    ["key", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    bounded_batches(df.sparkSession)
    return keyed_text(df, id_col, text_col).mapInArrow(run, PIECES)


# -- the plan


def best_pattern(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The most valuable multiset of lengths within the capacity: {index: times}."""
    priced = np.full(capacity + 1, -np.inf)
    priced[capacity - lengths] = prices  # longest first
    index = np.zeros(capacity + 1, dtype=np.int64)
    index[lengths] = np.arange(len(lengths))
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, dtype=np.int64)
    first = int(lengths[0])
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        if c >= first:
            offers = value[: c - first + 1] + priced[capacity - c : capacity - first + 1]
            best = int(offers.argmax())  # of equal offers the longest
            if offers[best] > value[c]:
                value[c], choice[c] = offers[best], index[c - best]
    times: dict[int, int] = {}
    c = capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            times[int(choice[c])] = times.get(int(choice[c]), 0) + 1
            c -= int(lengths[choice[c]])
    return times


def _fill(times: dict[int, int], lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """Limit a pattern to what is left and fill it up best fit, largest fitting length first."""
    times = {i: min(t, int(left[i])) for i, t in times.items() if left[i] > 0}
    room = capacity - sum(int(lengths[i]) * t for i, t in times.items())
    for i in range(int(np.searchsorted(lengths, room, side="right")) - 1, -1, -1):
        if lengths[i] <= room and (more := min(room // int(lengths[i]), int(left[i]) - times.get(i, 0))) > 0:
            times[i] = times.get(i, 0) + int(more)
            room -= int(lengths[i]) * int(more)
    return times


def program(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int) -> tuple[float, dict[tuple[tuple[int, int], ...], float]]:
    """(lower bound of the sequences, {((index, times), ...): fractional count}) of the configuration linear program.

    No packing needs fewer sequences than the prices of all pieces over the value of the best
    pattern; the counts add up to the best such bound."""
    bound = float((demand * lengths).sum()) / capacity
    short = np.zeros(len(lengths))  # rounds by which the coverage of a length is behind
    chosen: Counter[tuple[tuple[int, int], ...]] = Counter()
    for _ in range(rounds):
        prices = lengths / capacity * np.exp(np.clip(RATE * (short - short.max()), -30, 0))
        times = best_pattern(lengths, prices, capacity)
        i, n = (np.array(x, dtype=np.int64) for x in (list(times), list(times.values())))
        bound = max(bound, float((demand * prices).sum() / (prices[i] * n).sum()))
        chosen[tuple(sorted(times.items()))] += 1
        short += 1
        short[i] -= bound * n / demand[i]
    return bound, {pattern: bound * k / rounds for pattern, k in chosen.items()}


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """[({length: times}, sequences)] that together hold exactly the histogram. If the rounded
    program needs more sequences than best fit alone, the latter stands."""
    return min((_solve(histogram, capacity, r) for r in (rounds, 0)), key=lambda patterns: sum(n for _, n in patterns))


def _solve(histogram: dict[int, int], capacity: int, rounds: int) -> list[tuple[dict[int, int], int]]:
    out: list[tuple[dict[int, int], int]] = []
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0 and k < capacity), dtype=np.int64)
    if histogram.get(capacity):
        out.append(({capacity: 1}, histogram[capacity]))
    if not len(lengths):
        return out
    demand = np.array([histogram[int(k)] for k in lengths], dtype=np.int64)
    left = demand.copy()

    def take(times: dict[int, int], most: int) -> None:
        if n := min(most, min(int(left[i]) // t for i, t in times.items())):
            for i, t in times.items():
                left[i] -= t * n
            out.append(({int(lengths[i]): t for i, t in times.items()}, n))

    if rounds:
        _, counts = program(lengths, demand, capacity, rounds)
        for pattern, count in sorted(counts.items(), key=lambda x: -x[1]):
            take(dict(pattern), int(count))
    while (rest := np.flatnonzero(left)).size:
        take(_fill({int(rest[-1]): 1}, lengths, left, capacity), int(left[rest[-1]]))
    return out


class Places(NamedTuple):
    """The places of every length, as runs of one pattern each."""

    key: np.ndarray  # length * 2**50 + number of the run's first place
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray


def places(patterns: list[tuple[dict[int, int], int]]) -> Places:
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for times, n in patterns:
        offset = 0
        for length in sorted(times, reverse=True):
            rows.append(((length << 50) + given.get(length, 0), sequence, times[length], offset))
            given[length] = given.get(length, 0) + n * times[length]
            offset += length * times[length]
        sequence += n
    rows.sort()
    return Places(*(np.array(x, dtype=np.int64) for x in (zip(*rows) if rows else ((),) * 4)))


def packed(df: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces."""
    staged = checkpointed(pieces_of(df, path, capacity, end_id, id_col, text_col))
    counts = staged.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    at = places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = (length << 50) + batch.column("number").to_numpy()
            i = np.searchsorted(at.key, key, side="right") - 1
            within = key - at.key[i]
            columns = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at.sequence[i] + within // at.times[i]), pa.array(at.offset[i] + within % at.times[i] * length)], ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = staged.join(first, ["task", "length"]).select("key", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("number"))
    out = numbered.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("key", id_col)
