"""Operator 2: licence scans by winnowed fingerprints and banded alignment.

Templates and texts are sequences of words (runs of ASCII letters and digits,
lower case). Of every ``WINDOW`` consecutive ``GRAM``-word hashes the smallest
is a fingerprint, so any shared run of WINDOW + GRAM - 1 words shares one. An
inverted index leads from fingerprints to places in templates; each offset
between text and template that a hit shows is a candidate. A candidate is
aligned within ``BAND`` words around its offset (matches score 2, mismatches and
gaps cost 1, free ends), and reported if the matched words cover at least
``COVERAGE`` of the template (all of it in one run, if it is short). Where a short
template says ``...``, up to ``HOLDER`` words of the text may stand, such as years
and holders. A match inside the span of one with more matched words is dropped,
as a notice that is part of a longer text. Runs too short for WINDOW + GRAM - 1
words are found by all grams of the text, not by fingerprints. Licences that
differ by a few words are told apart by these words (``TELLING``): a match whose
stretch of the text lacks them is dropped.

Texts stream through tasks without a shuffle; the index is as large as the
templates. Defined results: a null or empty text and a text shorter than every
template has no match; a null key stays null; repeated rows give repeated
matches; an empty table gives an empty result; of equal matches of several
templates the first by name stays; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakestar.llm.common import bounded_batches, keyed_text, texts_of
from lakestar.llm.license_texts import TELLING, TEMPLATES

GRAM = 3
WINDOW = 3
BAND = 12
COVERAGE = 0.8
#: Templates below this many words have to match whole and unbroken: one other word names another licence.
SHORT = 20
#: Words of the text that may stand in a gap of a short template.
HOLDER = 12

MATCH, MISS, GAP = 2, -1, -1

_WORD = re.compile(r"[A-Za-z0-9]+")


def words_of(text: str) -> list[str]:
    return list(map(str.lower, _WORD.findall(text)))


def mixed(codes: np.ndarray) -> np.ndarray:
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(ids: np.ndarray, base: int) -> np.ndarray:
    n = len(ids) - GRAM + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        code = code * np.uint64(base) + ids[k : k + n].astype(np.uint64)
    return mixed(code)


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the smallest hash of each window, the last of equal ones; of a shorter text its smallest."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    width = min(WINDOW, len(hashes))
    windows = np.lib.stride_tricks.sliding_window_view(hashes, width)
    return np.unique(np.arange(len(windows)) + width - 1 - windows[:, ::-1].argmin(axis=1))


class Match(NamedTuple):
    license: str
    coverage: float
    matched: int
    start: int  # words until ``spans`` turns them into code points
    end: int


class Index:
    """Fingerprints of templates with their places."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = sorted(templates)
        words = {name: words_of(templates[name]) for name in self.names}
        # number 0 is any word that no template has
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for ws in words.values() for w in ws}))}
        self.base = len(self.number) + 1
        self.texts = [np.array([self.number[w] for w in words[name]], dtype=np.int64) for name in self.names]
        self.has = [np.isin(np.arange(self.base), ids) for ids in self.texts]
        # words of each template before its gaps
        self.breaks = [np.cumsum([len(words_of(part)) for part in templates[name].split("...")])[:-1].tolist() for name in self.names]
        self.telling = [[np.array([self.number[w] for w in words_of(run)]) for run in TELLING.get(name, ()) if set(words_of(run)) <= set(words[name])] for name in self.names]
        rows, unguarded = [], set()
        for t, ids in enumerate(self.texts):
            hashes = gram_hashes(ids, self.base)
            # all grams of a template: a text's own windows choose which of them it shows
            rows += [(int(h), t, p) for p, h in enumerate(hashes)]
            if max(map(len, np.split(ids, self.breaks[t]))) < WINDOW + GRAM - 1:
                unguarded.update(hashes.tolist())
        rows.sort()
        self.hashes = np.array([r[0] for r in rows], dtype=np.uint64)
        self.template = np.array([r[1] for r in rows], dtype=np.int64)
        self.place = np.array([r[2] for r in rows], dtype=np.int64)
        # grams of templates so short that a text's fingerprints may miss them
        self.unguarded = np.array(sorted(unguarded), dtype=np.uint64)

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(template, offset) of all hits, each once."""
        hashes = gram_hashes(ids, self.base)
        at = np.union1d(winnowed(hashes), np.flatnonzero(np.isin(hashes, self.unguarded)))
        first = np.searchsorted(self.hashes, hashes[at], side="left")
        count = np.searchsorted(self.hashes, hashes[at], side="right") - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        if len(at):
            entry = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            yield from sorted(set(zip(self.template[entry].tolist(), (np.repeat(at, count) - self.place[entry]).tolist())))

    def scan(self, words: list[str]) -> list[Match]:
        """Matches in word positions."""
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        found: list[Match] = []
        for t, offset in self.candidates(ids):
            pattern = self.texts[t]
            if len(pattern) < SHORT:
                if span := unbroken(pattern, self.breaks[t], ids, offset):
                    found.append(Match(self.names[t], 1.0, len(pattern), *span))
                continue
            needed = len(pattern) * COVERAGE
            # too few of the template's words in reach: no alignment can cover it
            reach = ids[max(0, offset - BAND) : offset + len(pattern) + BAND]
            if self.has[t][reach].sum() < needed:
                continue
            matched, start, end = align(pattern, ids, offset)
            if matched >= needed and all(holds(ids[start:end], run) for run in self.telling[t]):
                found.append(Match(self.names[t], matched / len(pattern), matched, start, end))
        found.sort(key=lambda m: (-m.matched, -m.coverage, m.license, m.start))
        best: list[Match] = []
        held = np.zeros(len(ids), dtype=np.int64)  # number of the match that holds a word
        for m in found:
            inside = held[m.start : m.end]
            if not (inside[0] and (inside == inside[0]).all()):
                best.append(m)
                inside[inside == 0] = len(best)
        return sorted(best, key=lambda m: (m.start, m.end, m.license))


def holds(ids: np.ndarray, run: np.ndarray) -> bool:
    """Whether the run of words stands unbroken in the text."""
    return len(ids) >= len(run) and bool((np.lib.stride_tricks.sliding_window_view(ids, len(run)) == run).all(axis=1).any())


def unbroken(template: np.ndarray, breaks: list[int], ids: np.ndarray, offset: int) -> tuple[int, int] | None:
    """(start, end) of the whole template whose longest part stands at the offset, with the nearest places of the others."""
    parts = np.split(template, breaks)
    longest = max(range(len(parts)), key=lambda k: len(parts[k]))

    def stands(part: np.ndarray, at: int) -> bool:
        return at >= 0 and np.array_equal(ids[at : at + len(part)], part)

    start = offset + sum(map(len, parts[:longest]))
    if not stands(parts[longest], start):
        return None
    end = start + len(parts[longest])
    for part in parts[longest + 1 :]:
        at = next((x for x in range(end, end + HOLDER + 1) if stands(part, x)), None)
        if at is None:
            return None
        end = at + len(part)
    for part in reversed(parts[:longest]):
        at = next((x for x in range(start - len(part), start - len(part) - HOLDER - 1, -1) if stands(part, x)), None)
        if at is None:
            return None
        start = at
    return start, end


def align(template: np.ndarray, ids: np.ndarray, offset: int) -> tuple[int, int, int]:
    """(matched words, start, end) of the best local alignment with text word - template word
    within the band around the offset; of equal ones that which ends nearest to it."""
    low, width = offset - BAND, 2 * BAND + 1
    begin = max(0, low)
    pattern, text = template.tolist(), ids[begin : offset + len(template) + BAND + 1].tolist()
    low -= begin
    n = len(text)
    # cells hold (score, matched words, start); ties keep the first of match, skipped template word, skipped text word
    nothing = (0, 0, -1)
    above = [nothing] * (width + 1)
    best, best_end, best_rank = nothing, 0, (0, 0, 0)
    for i, word in enumerate(pattern):
        row = [nothing] * (width + 1)
        left = nothing
        for d in range(width):
            j = i + low + d
            if j < 0 or j >= n:
                left = nothing
                continue
            score, matched, start = above[d]  # template word i - 1, text word j - 1
            if text[j] == word:
                cell = (score + MATCH, matched + 1, start if start >= 0 else j)
            else:
                cell = (score + MISS, matched, start)
            up = above[d + 1]  # text word j with template word i - 1
            if up[0] + GAP > cell[0]:
                cell = (up[0] + GAP, up[1], up[2])
            if left[0] + GAP > cell[0]:
                cell = (left[0] + GAP, left[1], left[2])
            if cell[0] <= 0:
                cell = nothing
            elif text[j] == word and (rank := (cell[1], cell[0], -abs(d - BAND))) > best_rank:
                best, best_end, best_rank = cell, j + 1, rank
            row[d] = left = cell
        above = row
    return best[1], best[2] + begin, best_end + begin


def spans(index: Index, text: str) -> list[Match]:
    """Matches of a text in code points."""
    words = words_of(text)
    if len(words) < GRAM:
        return []
    found = index.scan(words)
    if not found:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [m._replace(start=places[m.start][0], end=places[m.end - 1][1]) for m in found]


def scanned(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, coverage, matched_words, start, end) of every match."""
    templates = templates or TEMPLATES
    held: dict[int, Index] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.setdefault(0, Index(templates))
        for batch in batches:
            rows = [(i, *m) for i, t in enumerate(texts_of(batch)) for m in spans(index, t)]
            i, name, coverage, matched, start, end = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(i, pa.int64())), pa.array(name, pa.string()), pa.array(coverage, pa.float64()), *(pa.array(x, pa.int64()) for x in (matched, start, end))],
                ["key", "license", "coverage", "matched_words", "start", "end"],
            )

    bounded_batches(df.sparkSession)
    schema = "key long, license string, coverage double, matched_words long, start long, end long"
    return keyed_text(df, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("key", id_col)
