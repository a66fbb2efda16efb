"""Operator 9: language identification by word-first backoff.

A known word scores by its smoothed log frequency in each language. An unseen
word falls back to its character 4-grams, each unseen one of these to 3-grams,
2-grams and single characters. The language with the highest sum is the
prediction, its share of the posterior the score.

The model is fitted on at most about ``SAMPLE`` documents of each language
(all documents of smaller languages), chosen by a hash of the key; at most
``ENTRIES`` words and n-grams of each order and language are kept, fewer where
there are so many languages that the scores of an order would exceed ``CELLS``.
Every language is learned. Prediction reads whole texts and nothing
but texts.

Defined results: ``und`` with score 0 for null, for texts without a letter, and
for all texts if there is nothing to learn from; a null key is neither learned
from nor held out; repeated rows give repeated rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import bounded_batches, kept_rows, keyed_text, texts_of

UNKNOWN = "und"
#: Documents of each language to learn from.
SAMPLE = 4000
#: Words, and n-grams of each order, kept for each language.
ENTRIES = 12_000
#: Scores of an order, an entry in a language each, from which every language keeps fewer entries.
CELLS = 10_000_000
#: The longest n-grams.
ORDER = 4
#: Added to every count.
SMOOTH = 0.5

_RUNS = re.compile(r"[^\W\d_]+")


def held_out(key) -> "F.Column":
    """The fold that is never learned from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; may hold numerals that Python counts as word characters."""
    return _RUNS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between marks."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model(NamedTuple):
    languages: list[str]
    known: list[dict[str, np.ndarray]]  # by order, words at 0: log frequency in each language
    unseen: np.ndarray  # by order: log frequency of what is not known


def training_rows(df: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` documents of each language by a hash of the key; all where there are fewer."""
    rows = df.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("key").isNotNull() & ~held_out(F.col("key")))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(sample)) / F.col("size")).alias("share"))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
    return rows.join(F.broadcast(share), "lang").where(place < F.col("share")).select("lang", "text")  # a row for each language


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """The model of the documents outside the held-out fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                words.setdefault(lang, Counter()).update(w for w in words_of(text) if w.isalpha())
            for lang, seen in words.items():
                for n in range(ORDER + 1):
                    counts = seen if n == 0 else Counter()
                    if n:
                        for w, c in seen.items():
                            for g in grams(w, n):
                                counts[g] += c
                    if counts:
                        size = len(counts)
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * size), pa.array([n] * size, pa.int32()), pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["lang", "n", "gram", "c"])

    bounded_batches(df.sparkSession)
    partial = training_rows(df, id_col, text_col, lang_col, sample).mapInArrow(count, "lang string, n int, gram string, c long")
    counts = partial.groupBy("lang", "n", "gram").agg(F.sum("c").alias("c")).persist()
    try:
        # the count from which at most ``entries`` are left; none if more than these share the highest count
        falling = Window.partitionBy("lang", "n").orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)
        entries = min(entries, max(1, CELLS // max(1, counts.select("lang").distinct().count()) ** 2))
        sizes = counts.groupBy("lang", "n", "c").agg(F.count("*").alias("k")).withColumn("left", F.sum("k").over(falling))
        cuts = sizes.groupBy("lang", "n").agg(F.sum(F.col("c") * F.col("k")).alias("total"), F.min(F.when(F.col("left") <= entries, F.col("c"))).alias("cut")).collect()
        if not cuts:
            return Model([], [{} for _ in range(ORDER + 1)], np.zeros((ORDER + 1, 0)))
        totals = Counter({(r["lang"], r["n"]): r["total"] for r in cuts})
        least = df.sparkSession.createDataFrame([(r["lang"], r["n"], r["cut"]) for r in cuts], "lang string, n int, cut long")
        known = counts.join(F.broadcast(least), ["lang", "n"])  # a row for each language and order
        rows = known.where(F.col("c") >= F.col("cut")).drop("cut")
        if any(r["cut"] is None for r in cuts):
            place = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("c"), "gram"))
            rows = rows.union(known.where(F.col("cut").isNull()).drop("cut").withColumn("place", place).where(F.col("place") <= entries).drop("place"))
        kept = rows.toArrow()
    finally:
        counts.unpersist()
    languages = sorted({lang for lang, _ in totals})
    place = {lang: i for i, lang in enumerate(languages)}
    raw: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER + 1)]
    for lang, n, gram, c in zip(*(kept.column(x).to_pylist() for x in ("lang", "n", "gram", "c"))):
        raw[n].setdefault(gram, np.zeros(len(languages)))[place[lang]] = c
    total = np.array([[totals[lang, n] for lang in languages] for n in range(ORDER + 1)], dtype=float)
    norm = [np.log(total[n] + SMOOTH * (len(raw[n]) + 1)) for n in range(ORDER + 1)]
    known = [{g: np.log(c + SMOOTH) - norm[n] for g, c in raw[n].items()} for n in range(ORDER + 1)]
    return Model(languages, known, np.log(SMOOTH) - np.array(norm))


class Rows(dict):
    """Row of each key in a growing matrix of scores; row 0 is zero."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.rows = np.zeros((1 << 12, self.width))
        self.used = 1

    def add(self, score: np.ndarray) -> int:
        if self.used == len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        self.rows[self.used] = score
        self.used += 1
        return self.used - 1


class Grams(Rows):
    """Scores of n-grams: the known one, else the mean of the two next shorter ones."""

    def __init__(self, model: Model) -> None:
        self.model = model
        super().__init__(len(model.languages))

    def __missing__(self, gram: str) -> int:
        found = self.model.known[len(gram)].get(gram) if len(gram) <= ORDER else None
        if found is not None:
            row = self.add(found)
        elif len(gram) == 1:
            row = 0 if gram in "<>" else self.add(self.model.unseen[1])
        else:
            parts = [self[gram[:-1]], self[gram[1:]]]  # may grow the matrix
            row = self.add(self.rows[parts].sum(axis=0) / 2)
        self[gram] = row
        return row


class Scorer(Rows):
    """Scores of words; row 0 stands for no letters. Kept words beyond ``LIMIT`` start anew."""

    LIMIT = 300_000

    def __init__(self, model: Model) -> None:
        self.model, self.grams = model, Grams(model)
        super().__init__(len(model.languages))

    def __missing__(self, word: str) -> int:
        if not word.isalpha():
            rest = "".join(c for c in word if c.isalpha())
            row = self[rest] if rest else 0
        else:
            found = self.model.known[0].get(word)
            if found is None:
                marked = f"<{word}>"
                of = [self.grams[marked[i : i + ORDER]] for i in range(max(1, len(marked) - ORDER + 1))]
                found = self.grams.rows[of].sum(axis=0) / ORDER
            row = self.add(found)
        self[word] = row
        return row

    def predict(self, text: str) -> tuple[str, float]:
        if not self.model.languages:
            return UNKNOWN, 0.0
        if max(self.used, self.grams.used) > self.LIMIT:
            self.reset()
            self.grams.reset()
        rows = np.fromiter(map(self.__getitem__, words_of(text)), dtype=np.int64)
        rows = rows[rows > 0]
        if not len(rows):
            return UNKNOWN, 0.0
        total = self.rows[rows].sum(axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


#: The worker's scorer; words scored in one task serve the next.
_SCORERS: dict[str, Scorer] = {}


def predictor(df: DataFrame, model: Model):
    """A function text -> (language, score) for tasks; its model is broadcast (bounded by ``ENTRIES`` and ``CELLS``)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def predict(text: str) -> tuple[str, float]:
        if name not in _SCORERS:
            _SCORERS.clear()  # one model at a time
            _SCORERS[name] = Scorer(shared.value)
        return _SCORERS[name].predict(text)

    return predict


def identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every document."""
    predict = predictor(df, fit(df, id_col, text_col, lang_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["key", "lang_pred", "score"])

    bounded_batches(df.sparkSession)
    out = keyed_text(df, id_col, text_col).mapInArrow(run, "key long, lang_pred string, score double")
    return out.select(F.col("key").alias(id_col), held_out(F.col("key")).alias("held_out"), "lang_pred", "score")


def with_language(df: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows whose text has a language with a score of at least ``least``, with all their columns."""
    predict = predictor(df, fit(df, id_col, text_col, lang_col))

    def keep(texts: list[str]) -> list[bool]:
        return [lang != UNKNOWN and score >= least for lang, score in map(predict, texts)]

    return kept_rows(df, text_col, keep)
