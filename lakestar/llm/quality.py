"""Operator 8: quality rules with line labelling.

Each line with a word is content or boilerplate: a linear-chain conditional
random field over simple line features, decoded by Viterbi. A document stays if
it passes the base rules and content lines hold at least ``CONTENT_SHARE`` of
its words.

The field is trained here, by gradient ascent on the likelihood, on at most
``SAMPLE`` labelled documents with ``LINES`` lines in all (by a hash of the key);
the lines of a document
labelled good are content, those of one labelled bad are boilerplate, and lines
of both kinds that look alike get the label that most of them have.

Defined results: a null or empty text has no words and fails the base rules; a
null key stays null; repeated rows give repeated rows; an empty table gives an
empty result; without labelled documents of both kinds all lines are content;
other columns are not read. A text's lines and words are listed run by run, and
kept as numbers: some tens of bytes a line, and a line's text where it is a new one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import bounded_batches, kept_rows, keyed_text, texts_of

#: Labelled documents to train on.
SAMPLE = 2000
#: Most lines of the training sample: documents that do not fit any more are passed over.
LINES = 250_000
#: Most lines, padding included, of a group of several documents that are trained on, or decoded, together.
GROUP_LINES = 65_536
#: Characters of a text whose lines are listed at once.
RUN_CHARS = 1 << 20
#: Documents of a group below which each is decoded alone.
FEW = 24
#: Share of the words that content lines must hold.
CONTENT_SHARE = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

# fixed values
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_BYTES = BLANKS.encode()

STEPS = 80
RATE = 0.3
PENALTY = 1e-3

CONTENT, BOILERPLATE = 0, 1

# upper bounds of the bins of each measure of a line
BINS = {
    "symbols": (0.001, 0.05, 0.2, 0.5),  # per word
    "capitals": (0.1, 0.3, 0.6, 0.9),  # of the letters
    "words": (1.5, 3.5, 7.5, 15.5, 40.5),
    "word_length": (2.5, 4.5, 7.5, 12.5),
    "marks": (0.05, 0.2, 0.5, 1.0),  # other punctuation per word
    "digits": (0.001, 0.05, 0.3),  # of the characters
    "repeats": (0.05, 0.25, 0.5),  # of the words
}
_EDGES = [np.array(b) for b in BINS.values()]
_FIRST = np.concatenate(([0], np.cumsum([len(e) + 1 for e in _EDGES])))
FLAGS = ("ends_sentence", "seen_before")
SIZE = int(_FIRST[-1]) + 2 * len(FLAGS)
ACTIVE = len(_EDGES) + len(FLAGS)


def line_runs(text: str) -> Iterator[list[str]]:
    """Lines that hold a word, those of about ``RUN_CHARS`` characters at once."""
    at = 0
    while at < len(text):
        end = text.find("\n", at + RUN_CHARS)
        end = len(text) if end < 0 else end + 1
        if lines := [line for line in text[at:end].split("\n") if line.strip(BLANKS)]:
            yield lines
        at = end


def lines_of(text: str) -> list[str]:
    """Lines that hold a word."""
    return [line for lines in line_runs(text) for line in lines]


def measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(active features of each line, words of each line): bytes and longs, whatever the text's length."""
    seen: set[str] = set()
    runs = [_measured(lines, seen) for lines in line_runs(text)]
    if not runs:
        return np.empty((0, ACTIVE), dtype=np.uint8), np.empty(0, dtype=np.int64)
    return np.concatenate([a for a, _ in runs]), np.concatenate([c for _, c in runs])


def _measured(lines: list[str], seen: set[str]) -> tuple[np.ndarray, np.ndarray]:
    values = np.empty((len(lines), len(_EDGES)))
    flags = np.empty((len(lines), len(FLAGS)), dtype=np.uint8)
    counts = np.empty(len(lines), dtype=np.int64)
    for i, line in enumerate(lines):
        words = line.encode("utf-8").split()
        n, chars = len(words), len(line)
        letters = "".join(filter(str.isalpha, line)) if not line.isascii() else line
        upper = sum(map(str.isupper, letters)) if not line.isascii() else sum(map(line.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        lower = len(letters) - upper if not line.isascii() else sum(map(line.count, "abcdefghijklmnopqrstuvwxyz"))
        blanks = sum(map(line.count, BLANKS))
        symbols = sum(map(line.count, SYMBOLS))
        digits = sum(map(line.count, "0123456789"))
        marks = sum(map(line.count, "!?;:=_~^{}[]\\/\"'()-"))
        values[i] = (symbols / n, upper / max(1, upper + lower), n, (chars - blanks) / n, marks / n, digits / chars, 1 - len(set(words)) / n)
        flags[i] = (line.rstrip(BLANKS)[-1] in ".!?", line in seen)
        counts[i] = n
        seen.add(line)
    active = np.empty((len(lines), ACTIVE), dtype=np.uint8)
    for k, edges in enumerate(_EDGES):
        active[:, k] = _FIRST[k] + np.searchsorted(edges, values[:, k])
    active[:, len(_EDGES) :] = _FIRST[-1] + 2 * np.arange(len(FLAGS)) + flags
    return active, counts


class Field(NamedTuple):
    """Weights of a two-state chain."""

    emit: np.ndarray  # feature x state
    step: np.ndarray  # state before x state
    start: np.ndarray


NEUTRAL = Field(np.column_stack((np.full(SIZE, 1.0), np.zeros(SIZE))), np.zeros((2, 2)), np.zeros(2))


def _padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(d) for d in docs])
    out = np.zeros((len(docs), int(lengths.max()), ACTIVE), dtype=np.int64)
    for i, d in enumerate(docs):
        out[i, : len(d)] = d
    return out, lengths


def grouped(lengths: list[int]) -> list[list[int]]:
    """Documents that share a matrix: similar numbers of lines, at most 256 documents and ``GROUP_LINES`` padded lines."""
    groups: list[list[int]] = []
    for i in np.argsort(lengths, kind="stable").tolist():
        if not groups or len(groups[-1]) == 256 or (len(groups[-1]) + 1) * lengths[i] > GROUP_LINES:
            groups.append([])
        groups[-1].append(i)
    return groups


def train(docs: list[np.ndarray], labels: list[int], steps: int = STEPS) -> Field:
    """Weights that make the labels of all lines likely; every document has one label for all its lines."""
    if len(set(labels)) < 2:
        return NEUTRAL
    groups = []
    for chosen in grouped([len(d) for d in docs]):
        active, lengths = _padded([docs[i] for i in chosen])
        groups.append((active, lengths, np.array([labels[i] for i in chosen])))
    lines = sum(int(g[1].sum()) for g in groups)
    weights = [np.zeros((SIZE, 2)), np.zeros((2, 2)), np.zeros(2)]
    moment = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for t in range(1, steps + 1):
        slope = [-PENALTY * w for w in weights]
        for active, lengths, label in groups:
            for total, part in zip(slope, _gradient(Field(*weights), active, lengths, label)):
                total += part / lines
        for w, g, (m, v) in zip(weights, slope, moment):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Field(*weights)


def _gradient(field: Field, active: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Observed less expected counts, by the forward-backward recursions."""
    n, width = active.shape[:2]
    scores = field.emit[active].sum(axis=2)
    inside = np.arange(width) < lengths[:, None]
    forward = np.empty((n, width, 2))
    forward[:, 0] = field.start + scores[:, 0]
    for t in range(1, width):
        reached = np.logaddexp.reduce(forward[:, t - 1, :, None] + field.step, axis=1) + scores[:, t]
        forward[:, t] = np.where(inside[:, t, None], reached, forward[:, t - 1])
    whole = np.logaddexp.reduce(forward[:, -1], axis=1)
    backward = np.zeros((n, width, 2))
    step = np.zeros((2, 2))
    for t in range(width - 2, -1, -1):
        ahead = field.step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        there = inside[:, t + 1]
        backward[:, t] = np.where(there[:, None], np.logaddexp.reduce(ahead, axis=2), 0.0)
        step -= np.exp(forward[there, t, :, None] + ahead[there] - whole[there, None, None]).sum(axis=0)
    share = np.exp(forward + backward - whole[:, None, None])
    seen = np.zeros((n, width, 2))
    seen[np.arange(n), :, label] = 1.0
    off = (seen - share) * inside[:, :, None]
    emit = np.empty((SIZE, 2))
    for state in (0, 1):
        emit[:, state] = np.bincount(active.reshape(-1), weights=np.repeat(off[:, :, state].reshape(-1), ACTIVE), minlength=SIZE)
    for state in (0, 1):
        step[state, state] += (lengths[label == state] - 1).sum()
    return emit, step, off[:, 0].sum(axis=0)


def viterbi(field: Field, docs: list[np.ndarray]) -> list[np.ndarray]:
    """The most likely labels of the lines of each document; equal paths favour content.

    Documents of similar length are decoded together, within ``GROUP_LINES`` padded lines; those
    that few others are like in length, each alone."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int8)] * len(docs)
    held = [i for i in range(len(docs)) if len(docs[i])]
    for group in grouped([len(docs[i]) for i in held]):
        chosen = [held[k] for k in group]
        labels = _decoded_together(field, [docs[i] for i in chosen]) if len(chosen) >= FEW else [_decoded(field, docs[i]) for i in chosen]
        for i, lab in zip(chosen, labels):
            out[i] = lab
    return out


def _scores(field: Field, active: np.ndarray) -> np.ndarray:
    runs = [field.emit[active[k : k + GROUP_LINES]].sum(axis=1) for k in range(0, len(active), GROUP_LINES)]
    return runs[0] if len(runs) == 1 else np.concatenate(runs)


def _decoded(field: Field, active: np.ndarray) -> np.ndarray:
    """One document of any length: a byte and two doubles a line."""
    (aa, ab), (ba, bb) = field.step.tolist()
    scores = _scores(field, active)
    back = bytearray(len(scores))  # of both states, where the best path came from
    a, b = (scores[0] + field.start).tolist()
    for at in range(1, len(scores), GROUP_LINES):
        for t, (sa, sb) in enumerate(scores[at : at + GROUP_LINES].tolist(), at):
            to_a, to_b = b + ba > a + aa, b + bb > a + ab
            a, b = (b + ba if to_a else a + aa) + sa, (b + bb if to_b else a + ab) + sb
            back[t] = to_a | to_b << 1
    state = int(b > a)
    labels = np.empty(len(scores), dtype=np.int8)
    for t in range(len(scores) - 1, -1, -1):
        labels[t] = state
        state = back[t] >> state & 1
    return labels


def _decoded_together(field: Field, docs: list[np.ndarray]) -> list[np.ndarray]:
    """Documents in ascending order of length."""
    lengths = np.array([len(d) for d in docs])
    scores = [_scores(field, d) for d in docs]
    width = int(lengths[-1])
    back = np.zeros((len(docs), width, 2), dtype=np.int8)
    best = np.array([s[0] for s in scores]) + field.start
    for t in range(1, width):
        on = int(np.searchsorted(lengths, t, side="right"))  # documents from here on have a line t
        paths = best[on:, :, None] + field.step
        back[on:, t] = paths.argmax(axis=1)
        best[on:] = paths.max(axis=1) + np.array([s[t] for s in scores[on:]])
    out = []
    for k in range(len(docs)):
        labels = np.empty(lengths[k], dtype=np.int8)
        state = int(best[k].argmax())
        for t in range(int(lengths[k]) - 1, -1, -1):
            labels[t] = state
            state = int(back[k, t, state])
        out.append(labels)
    return out


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    n_lines, different = 0, set()
    for lines in line_runs(text):
        n_lines += len(lines)
        different.update(lines)
    n_lines -= len(different)
    del different
    ids = word_numbers(text)
    return len(ids), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), n_lines, repeat_words(ids)


def word_numbers(text: str) -> np.ndarray:
    """A number for each word, equal for equal words; words are listed slice by slice."""
    raw, at, parts = text.encode("utf-8"), 0, []
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    while at < len(raw):
        end = at + RUN_CHARS
        while end < len(raw) and raw[end] not in _BLANK_BYTES:  # a word stays whole
            end += 1
        words = raw[at:end].split()  # bytes are split at exactly these blanks
        parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
        at = end
    return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, dtype=np.int64), *parts])


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words, given by number, that stand in a window of words found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    many = int(ids.max()) + 1
    code = ids[:n]
    for k in range(1, window):  # numbered anew after each word, so that the product stays small
        code = np.unique(code * many + ids[k : k + n], return_inverse=True)[1]
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(window):
        covered[k : k + n] |= again
    return int(covered.sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def judge(field: Field, texts: list[str]) -> tuple[list[tuple[int, int, int, int, int]], list[bool], list[bool], list[float]]:
    """(base counts, base_failed, kept, content share) of each text."""
    measured = [measures(t) for t in texts]
    labels = viterbi(field, [m for m, _ in measured])
    share = [float(w[lab == CONTENT].sum() / w.sum()) if len(w) else 0.0 for (_, w), lab in zip(measured, labels)]
    counts = [base_counts(t) for t in texts]
    failed = [base_failed(c[0], c[4]) for c in counts]
    return counts, failed, [not f and s >= CONTENT_SHARE for f, s in zip(failed, share)], share


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", sample: int = SAMPLE, lines: int = LINES) -> Field:
    """Train on a bounded sample of the labelled documents: at most ``sample`` of them, with at most ``lines`` lines in all."""
    chosen = labels.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{quality_col}`").cast("int").alias("quality")).dropna()
    chosen = chosen.groupBy("key").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = keyed_text(df, id_col, text_col).join(F.broadcast(chosen), "key")  # at most ``sample`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [measures(t)[0].tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("quality"), pa.array(packed, pa.binary())], ["key", "quality", "active"])

    bounded_batches(df.sparkSession)
    measured = rows.mapInArrow(run, "key long, quality int, active binary")
    once = measured.groupBy("key", "quality").agg(F.min("active").alias("active")).persist()  # repeated rows train once
    try:
        sizes = once.select("key", F.xxhash64("key").alias("at"), (F.length("active") / ACTIVE).cast("long").alias("n")).collect()  # at most ``sample`` rows
        room, over = lines, []
        for r in sorted(sizes, key=lambda r: (r["at"], r["key"])):
            if r["n"] <= room:
                room -= r["n"]
            else:
                over.append(r["key"])
        found = (once.where(~F.col("key").isin(over)) if over else once).orderBy("key").toArrow()
    finally:
        once.unpersist()
    docs, kinds = [], []
    for quality, active in zip(found.column("quality").to_pylist(), found.column("active").to_pylist()):
        if active:
            docs.append(np.frombuffer(active, dtype=np.uint8).reshape(-1, ACTIVE).astype(np.int64))
            kinds.append(CONTENT if quality else BOILERPLATE)
    return train(docs, kinds)


def judged(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share)."""
    field = fit(df, labels, id_col, text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept, share = judge(field, texts_of(batch))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(share, pa.float64())], ["key", *names, "base_failed", "kept", "content_share"])

    bounded_batches(df.sparkSession)
    schema = "key long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean, content_share double"
    return keyed_text(df, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("key", id_col)


def good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that are kept, with all their columns."""
    field = fit(df, labels, id_col, text_col)
    return kept_rows(df, text_col, lambda texts: judge(field, texts)[2])
