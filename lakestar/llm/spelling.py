"""Operator 12: grouping of spelling variants by a bit-sliced position index.

1. ``vocabulary`` counts the words of all texts; tasks add up their own counts
   before the shuffle.
2. Two words within one inserted, deleted or replaced letter, the shorter of m
   letters, share their first m // 2 letters or their last m - m // 2. So a word
   goes to four blocks: by either part, as the shorter and as the longer of a
   pair. Blocks are dealt to cells of bounded size; a cell beyond the bound, of a
   very common part, is cut into tiles by a hash, and every tile meets every tile
   of its cell (an equi-join of tiles, not of words).
3. A tile's words are the bits of its index, most frequent first: one bitset per
   (position, letter). The words of the other tile run over it all at once:
   bitsets of the words equal so far (zero errors) and of those with one letter
   replaced, left out or added so far (one error, positions shifted by one) are
   carried on letter by letter. The result's bit count is the number of near
   words, its lowest bit the most frequent of them; near pairs are never listed.
   A pair that shares both parts counts where it shares the first.
4. A word's form is its most frequent near word if that is ``ratio`` times as
   frequent at least; roots follow forms by pointer doubling, in rounds that grow
   with the logarithm of the longest chain (which doubles in frequency each step).

Defined results: a null text has no words; a null key gives no argument to
``rewrite``, whose word then stays as it is; repeated rows count each; an empty
table gives an empty result; other columns are not read. Ties of frequency go to
the smallest word in code-point order. Texts are read whole, in slices that cut
no word; memory follows a slice, the bounded table of counts and the tiles.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import bounded_batches, checkpointed, keyed_text

#: Words are maximal runs of these letters; A-Z are lower-cased first.
LETTERS = "a-zÀ-ÿ"
#: Characters of a text searched at once.
SLICE = 1 << 20
#: Distinct words that a task counts before it hands them on.
TABLE = 500_000
#: Words of a tile, and their letters.
TILE, TILE_LETTERS = 2048, 1 << 20
#: Words of a tile that run over the index at once.
QUERIES = 1024

_RUN = re.compile(f"[{LETTERS}]+")
_END = re.compile(f"[^{LETTERS}]")
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())

Rewrite = Callable[[int, str], str]


def words_in(text: str) -> Iterator[Counter[str]]:
    """Counts of the words of each slice of a text."""
    text = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    at = 0
    while at < len(text):
        stop = _END.search(text, min(at + SLICE, len(text)))
        end = stop.start() if stop else len(text)
        yield Counter(_RUN.findall(text, at, end))
        at = end


def vocabulary(df: DataFrame, shortest: int = 5, least: int = 3, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of ``shortest`` letters that occur ``least`` times.

    ``rewrite`` may give another spelling for a word of a row, from the row's key and the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for found in words_in(text or ""):
                    for word, n in found.items():
                        if rewrite is not None and key is not None:
                            word = rewrite(key, word)
                        if len(word) >= shortest:
                            counts[word] = counts.get(word, 0) + n
                    if len(counts) >= TABLE:
                        yield handed()
        yield handed()

    bounded_batches(df.sparkSession)
    partial = keyed_text(df, id_col, text_col).mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- one tile against another


class Index:
    """Bitsets over words, given most frequent first: one for each (position, letter)."""

    def __init__(self, words: list[str]) -> None:
        self.width = -(-len(words) // 64)
        letters, position, word = _letters(words)
        self.keys, row = np.unique(position << 21 | letters, return_inverse=True)
        self.bits = np.zeros((len(self.keys) + 1, self.width), dtype=np.uint64)  # the last row stays empty
        np.bitwise_or.at(self.bits, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))

    def rows(self, letters: np.ndarray, shift: int) -> np.ndarray:
        """Rows of the letters of words (one a line) at their own positions plus ``shift``."""
        position = np.arange(letters.shape[1], dtype=np.int64) + shift
        key = np.where(position >= 0, position << 21 | letters, -1)
        row = np.searchsorted(self.keys, key)
        found = row < len(self.keys)
        found &= self.keys[np.where(found, row, 0)] == key
        return np.where(found, row, len(self.keys))

    def members(self, chosen: np.ndarray) -> np.ndarray:
        """The bitset of the words for which ``chosen`` holds."""
        at = np.flatnonzero(chosen)
        out = np.zeros(self.width, dtype=np.uint64)
        np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        return out


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    return flat, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), word


def near_sets(index: Index, queries: list[str], short: np.ndarray, long: np.ndarray, m: int, first: bool) -> np.ndarray:
    """Bitsets of the index's words near each query; queries have the same length, m or m + 1.

    ``short`` and ``long`` are the bitsets of words of m and m + 1 letters. ``first`` tells
    whether the block is that of the first m // 2 letters."""
    flat, _, _ = _letters(queries)
    letters = flat.reshape(len(queries), -1)
    shape = (len(queries), index.width)
    equal = np.broadcast_to(short | long, shape)
    same = equal
    here = index.rows(letters, 0)
    zero = np.zeros(shape, dtype=np.uint64)
    if letters.shape[1] == m:
        beyond = index.rows(letters, 1)
        replaced, added = zero, zero
        for i in range(m):
            b = index.bits[here[:, i]]
            replaced = replaced & b | equal & ~b
            added = (added | equal) & index.bits[beyond[:, i]]
            equal = equal & b
            if i == m // 2 - 1:
                same = equal
        result = replaced & short | (added | equal) & long
    else:
        behind = index.rows(letters, -1)
        left_out = zero
        for i in range(m + 1):
            left_out = left_out & index.bits[behind[:, i]] | equal
            equal = equal & index.bits[here[:, i]]
            if i == m // 2 - 1:
                same = equal
        result = left_out & short
    return result & same if first else result & ~same


def summed(words: list[str], counts: np.ndarray, queries: list[str], m: int, first: bool) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
    """(query, number of near words, most frequent of them, its count) for the queries that have any."""
    order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
    words, counts = [words[k] for k in order], counts[order]
    index = Index(words)
    length = np.array([len(w) for w in words])
    short, long = index.members(length == m), index.members(length > m)
    who: list[str] = []
    near, best = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for size in (m, m + 1):
        of_size = [q for q in queries if len(q) == size]
        for at in range(0, len(of_size), QUERIES):
            asked = of_size[at : at + QUERIES]
            sets = near_sets(index, asked, short, long, m, first)
            n = np.bitwise_count(sets).sum(axis=1, dtype=np.int64)
            hit = np.flatnonzero(n)
            sets = sets[hit]
            word = (sets != 0).argmax(axis=1)
            lowest = sets[np.arange(len(hit)), word]
            bit = np.bitwise_count((lowest & (~lowest + np.uint64(1))) - np.uint64(1))
            who += [asked[k] for k in hit.tolist()]
            near.append(n[hit])
            best.append(word * 64 + bit)
    at = np.concatenate(best)
    return who, np.concatenate(near), [words[k] for k in at.tolist()], counts[at]


# -- blocks and tiles


def near_words(words: DataFrame, shortest: int = 5) -> DataFrame:
    """(word, n_near, near, near_n) of the words of a (word, n) table that have near words."""
    size = F.length("word").cast("long")
    # as the shorter, or an equal, of a pair and as the longer
    entries = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= shortest)
    parts = F.array(F.struct(F.lit(True).alias("first"), F.expr("substring(word, 1, int(m div 2))").alias("part")), F.struct(F.lit(False).alias("first"), F.expr("right(word, int(m - m div 2))").alias("part")))
    entries = entries.withColumn("p", F.explode(parts)).select("word", "n", "m", "p.first", "p.part")
    tile = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_LETTERS) / (F.col("m") + 1))))
    cells = entries.groupBy("first", "m").agg(F.ceil(F.count("*") / tile).alias("cells"))
    entries = entries.join(cells, ["first", "m"]).withColumn("cell", F.pmod(F.xxhash64("part"), F.col("cells"))).drop("part", "cells")
    entries = checkpointed(entries)
    cuts = entries.groupBy("first", "m", "cell").agg(F.ceil(F.count("*") / (2 * tile)).alias("cuts"))
    key = ["first", "m", "cell"]
    tiles = (
        entries.join(cuts, key)
        .withColumn("cut", F.pmod(F.xxhash64("word"), F.col("cuts")))
        .groupBy(*key, "cut")
        .agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))  # about twice ``TILE`` rows at most
    )
    tiles = checkpointed(tiles)
    pairs = tiles.join(tiles.select(*key, F.col("words").alias("queries")), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = batch.column("counts")[i].values.to_numpy()
                texts, queries = (batch.column(c)[i].as_py() for c in ("words", "queries"))
                found = summed(texts, counts, queries, batch.column("m")[i].as_py(), batch.column("first")[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1]), pa.array(found[2], pa.string()), pa.array(found[3])], ["word", "n_near", "near", "near_n"])

    bounded_batches(words.sparkSession)
    found = pairs.select("first", "m", "words", "counts", "queries").mapInArrow(run, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", "best.near", (-F.col("best.minus")).alias("near_n"))


def rooted(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links without cycles: the last form, by pointer doubling."""
    hops = checkpointed(links.select("word", F.col("form").alias("root")))
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = checkpointed(hops.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = hops.where("moved").limit(1).count()
        hops = hops.select("word", "root")
        if not moved:
            return hops


def grouped(df: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary."""
    if ratio < 2:
        raise ValueError("forms would run in circles")
    words = checkpointed(vocabulary(df, shortest, least, rewrite, id_col, text_col))
    near = near_words(words, shortest)
    is_form = F.col("near_n") >= ratio * F.col("n")
    forms = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    forms = checkpointed(forms)
    roots = rooted(forms.where("form is not null").select("word", "form"))
    return forms.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
