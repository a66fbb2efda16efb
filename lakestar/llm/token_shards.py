"""Operator 11: token ids in binary shards of Re-Pair grammars, as a Python data source.

Writing (``stored``): texts become ids in one pass, and a row's range is found
from quantiles of the id column alone, so the texts are read once; ranges are
shuffled to their own partitions and sorted there. An id with more rows than a
range has several ranges, over which its rows are dealt. Each task writes one
file of blocks of about ``BLOCK_IDS`` ids; a document beyond that goes on in the
next block, so memory follows a block (and a single document's ids, as rows
hold them). The commit writes a manifest, and only its files are read, so
retried or speculative tasks leave nothing visible.

A block holds its documents' keys, id counts and symbol offsets, the rules with
their expansion lengths, and the symbols. ``repair`` describes the grammar. The
file ends with a list of its blocks; the manifest lists files in order with
their documents, ids and key range. So a reader finds any id by prefix sums:
file, block, document, symbol, and decodes only what it needs (``Shards``).

Reading (``format("token_shards")``): one row per document with the number of
ids before it. Predicates on ``key`` are pushed down: files and blocks outside
their range are skipped. Without the ``ids`` column no symbol is decoded.

Defined results: a null or empty text is the end id alone; rows without a key
come first, as the smallest key; repeated keys stand next to each other, in any
order among themselves; null ids are none; writing no rows leaves an empty
manifest, which reads as an empty table; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from lakestar.llm import bpe, repair
from lakestar.llm.common import bounded_batches, keyed_text, steps, texts_of
from lakestar.llm.pieces import Pieces, PieceTable
from lakestar.llm.warc import file_system
from lakestar.operators.numbering import target_partitions

READ_SCHEMA = "key long, start long, n_tokens long, ids binary"
#: Ids of a block.
BLOCK_IDS = 2 << 20
#: Bytes of input (as the plan's statistics give them) for which a file is written.
FILE_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
MANIFEST = "_token-shards-"
#: Distinct words and runs that an encoder remembers, and bytes of a text that it splits at once.
WORDS, SLICE = 400_000, 1 << 20

_LEAST = -(1 << 63)
#: ASCII marks but for the apostrophe, letters, ASCII marks.
_CORE = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")
_BLANKS = b" \t\n\x0b\x0c\r"
_BLANK, _LETTER, _MARK, _ODD = range(4)  # kinds of bytes; a word with an odd byte is taken apart by itself
# fixed values of the file format
_HEAD = struct.Struct("<4sIIIQQQ")  # magic, bytes of a symbol, first rule, rules, documents, symbols, checksum
_TAIL = struct.Struct("<Q4s")  # bytes of the list of blocks, magic
_MAGIC = b"RPB1"
_NO_KEY, _GOES_ON = 1, 2  # flags of a document: without key, begun in an earlier block


# -- ids


def numbering() -> defaultdict:
    """Numbers keys in order of appearance."""
    out: defaultdict = defaultdict()
    out.default_factory = out.__len__
    return out


class Table:
    """Id lists of numbered texts, in growing arrays."""

    def __init__(self) -> None:
        self.begin = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint32)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts with these numbers, one after the other; ids of each)."""
        size = self.size[at]
        out = np.repeat(self.begin[at] - (np.cumsum(size) - size), size)
        out += np.arange(len(out))
        return self.flat[out], size


def word_merges(path: str) -> bpe.Merges | None:
    """The merges of a byte-level vocabulary whose words end in marked symbols, or None for another
    kind of model. Bytes from 256 on are those that end a word."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end = model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not end or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
        return None
    letters, vocab = bpe.byte_letters(), model["vocab"]
    symbols = {k: bytes(letters[c] for c in body) for t, k in vocab.items() if (body := t.removesuffix(end)) and all(c in letters for c in body)}
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    left, right, result = (np.array([vocab[t] for t in texts], dtype=np.int64) for texts in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
    merges = bpe.Merges(left, right, np.arange(len(pairs)), result, symbols, whole=False)
    merges.byte_symbol = np.zeros(512, dtype=np.int32)
    for c, byte in letters.items():
        merges.byte_symbol[byte], merges.byte_symbol[256 + byte] = vocab.get(c, 0), vocab.get(c + end, 0)
    return merges


class Encoder:
    """Ids of texts by a tokenizers file, without added special tokens.

    Where the tokenizer treats what blanks separate independently of each other (probed once), each
    distinct word is encoded once, and texts are put together from words. Where it also parts
    letters from ASCII marks beside them and only lower-cases Latin letters (probed too), words of
    such letters and marks are cut into runs of either, for all texts at once, and each distinct run
    is encoded once. Other words are looked at one by one. The letters of all new words are merged
    together in padded matrices (``bpe``); all else goes to the library."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.starts = frozenset(t[:1].encode()[0] for t in self.added if t)
        self.by_word = self._separable()
        self.merges = word_merges(path) if self.by_word else None
        self.by_core = self.merges is not None and self._cored()
        self.kinds = self._kinds()
        self._forget()

    def _encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _separable(self) -> bool:
        parts = ["a", "Ab", "don't", "'s", "\u00e9", "e\u0301", "\u0301", "12", "...", "</w>", "\u5b83", "\u03a3", "<|endoftext|>", "\u00a0", "\u200d"]
        for i, x in enumerate(parts):
            y, blank = parts[(i * 7 + 3) % len(parts)], chr(_BLANKS[i % len(_BLANKS)])
            if self._encode(f"{blank}{x}{blank}{blank}{y}{blank}") != self._encode(x) + self._encode(y):
                return False
        return True

    def _cored(self) -> bool:
        letters = [chr(c) for c in [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]]
        words = ["".join(letters[k::7]) for k in range(7)] + letters
        flat, size = self._merged([w.encode() for w in words])
        own = [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])]
        same = all(ids == self._encode(w) == self._encode(w.upper().replace("SS", "ß").replace("Ÿ", "ÿ")) for ids, w in zip(own, words))
        marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
        after = all(self._encode(w + m + n) == self._encode(w) + self._encode(m + n) for w in words[:2] for m in marks for n in ("", "'", "!"))
        before = all(self._encode(n + m + w) == self._encode(n + m) + self._encode(w) for w in ("s", *words[:2]) for m in marks if m != "'" for n in ("", "!"))
        between = all(self._encode(v + m + w) == self._encode(v) + self._encode(m) + self._encode(w) for v in ("s", *words[:2]) for w in ("s", words[1]) for c in marks if c != "'" for m in (c, c + "!"))
        return same and after and before and between

    def _kinds(self) -> np.ndarray:
        """Kind of each byte. Where words can't be cut into runs all but blanks are odd."""
        kinds = np.full(256, _ODD, dtype=np.uint8)
        kinds[list(_BLANKS)] = _BLANK
        if self.by_core:
            for byte in range(33, 127):
                if chr(byte).isalpha():
                    kinds[byte] = _LETTER
                elif not chr(byte).isdigit() and chr(byte) != "'":
                    kinds[byte] = _MARK
            kinds[list(self.starts)] = _ODD
        return kinds

    def _forget(self) -> None:
        self.number, self.core, self.other = numbering(), numbering(), numbering()
        self.words, self.cores, self.others = Table(), Table(), Table()
        self.runs = PieceTable()
        # number in ``words`` of each run and of each odd word
        self.run_at, self.word_at = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def _merged(self, cores: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of words of letters."""
        return self._merged_bytes(np.frombuffer(b"".join(cores), dtype=np.uint8), np.array([len(c) for c in cores], dtype=np.int64))

    def _merged_bytes(self, letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that stand one after the other."""
        end = np.cumsum(sizes)
        buffer = np.concatenate([letters, np.zeros(16, dtype=np.uint8)]).astype(np.uint16)
        buffer[end - 1] += 256
        flat, size = self.merges.encode(buffer, end - sizes, end)
        return flat.astype(np.uint32), size

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.empty(0, dtype=np.uint32), *found]), np.array([len(x) for x in found], dtype=np.int64)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """New words: marks, letters, marks; or as a whole. Their numbers in ``words``."""
        core, other, matched = self.core, self.other, _CORE.fullmatch
        known = len(core), len(other)
        before, middle, behind = [], [], []
        for word in words:
            text = word.decode("utf-8", "surrogatepass")
            found = matched(text) if self.by_core and (self.starts.isdisjoint(word) or not any(t in text for t in self.added)) else None
            if found is None:
                before.append(-1)
                middle.append(-1)
                behind.append(other[text])
            else:
                lead, letters, tail = found.groups()
                before.append(other[lead] if lead else -1)
                middle.append(core[letters.lower()])
                behind.append(other[tail] if tail else -1)
        if len(core) > known[0]:
            self.cores.add(*self._merged([t.encode("utf-8") for t in islice(core, known[0], None)]))
        if len(other) > known[1]:
            self.others.add(*self._one_by_one(list(islice(other, known[1], None))))
        # the parts of all words, those of letters numbered after the others
        parts = np.array([before, middle, behind], dtype=np.int64).T
        parts[:, 1] += np.where(parts[:, 1] >= 0, len(other), 0)
        joined = Table()
        joined.add(self.others.flat, self.others.size)
        joined.add(self.cores.flat, self.cores.size)
        there = parts >= 0
        flat, size = joined.ids(parts[there])
        each = np.zeros(parts.shape, dtype=np.int64)
        each[there] = size
        return self._keep(flat, each.sum(axis=1))

    def _keep(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Adds to ``words``; the numbers given."""
        first = len(self.words.size)
        self.words.add(flat, size)
        return np.arange(first, first + len(size))

    def _odd(self, words: list[bytes]) -> np.ndarray:
        """Numbers in ``words``."""
        known = len(self.number)
        at = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.number) > known:
            self.word_at = np.concatenate([self.word_at, self._learn(list(islice(self.number, known, None)))])
        return self.word_at[at]

    def _runs(self, buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers in ``words`` of runs of lower-case letters or of marks."""
        at, begin, end = self.runs.number(Pieces(buffer, begin, end, np.empty(0, dtype=np.int64)))
        if len(begin):
            letters = self.kinds[buffer[begin]] != _MARK
            new, size = np.empty(len(begin), dtype=np.int64), end - begin
            if letters.any():
                new[letters] = self._keep(*self._merged_bytes(bpe.gather(buffer, begin[letters], size[letters]), size[letters]))
            marks = [buffer[b:e].tobytes().decode() for b, e in zip(begin[~letters].tolist(), end[~letters].tolist())]
            if marks:
                new[~letters] = self._keep(*self._one_by_one(marks))
            self.run_at = np.concatenate([self.run_at, new])
        return self.run_at[at]

    def _lowered(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(bytes with lower-case ASCII and Latin-1 letters and 16 zero bytes, kind of each byte)."""
        buffer = np.frombuffer(bytearray(raw.lower() + bytes(16)), dtype=np.uint8)  # lower-cases ASCII alone
        kind = self.kinds[np.frombuffer(raw, dtype=np.uint8)]
        if self.by_core and 0xC3 not in self.starts:
            # U+00C0 to U+00FF but for the signs of multiplication and division
            at = np.flatnonzero(buffer == 0xC3) + 1
            at = at[(buffer[at] != 0x97) & (buffer[at] != 0xB7)]
            kind[at - 1] = kind[at] = _LETTER
            buffer[at[buffer[at] < 0x9F]] += 0x20
        return buffer, kind

    def _ids(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids of each word or run, place of each in ``raw``)."""
        if self.runs.size + len(self.number) > WORDS:
            self._forget()
        buffer, kind = self._lowered(raw)
        edge = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(raw)]])
        begin, end = edge[:-1], edge[1:]
        kind = kind[begin]
        real = np.flatnonzero(kind != _BLANK)
        odd = np.zeros(len(real), dtype=bool)
        if (kind == _ODD).any():
            word = np.cumsum(kind == _BLANK)  # runs of one word stand between two blanks
            has = np.zeros(int(word[-1]) + 1, dtype=bool)
            has[word[kind == _ODD]] = True
            word = word[real]
            odd = has[word]
            other = word[1:] != word[:-1]
            first, last = np.concatenate([[True], other]), np.concatenate([other, [True]])
            begin, end = begin[real[~odd | first]], end[real[~odd | last]]
            odd = odd[~odd | first]
        else:
            begin, end = begin[real], end[real]
        at = np.empty(len(begin), dtype=np.int64)
        at[~odd] = self._runs(buffer, begin[~odd], end[~odd])
        if odd.any():
            at[odd] = self._odd([raw[b:e] for b, e in zip(begin[odd].tolist(), end[odd].tolist())])
        return *self.words.ids(at), begin

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each text)."""
        if not self.by_word:
            return self._one_by_one(texts)
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        if len(raw) == 1 and len(raw[0]) > SLICE:
            ids = np.concatenate([self._ids(part)[0] for part in _slices(raw[0])])
            return ids, np.array([len(ids)], dtype=np.int64)
        joined = b" ".join(raw)
        if not joined:
            return np.empty(0, dtype=np.uint32), np.zeros(len(raw), dtype=np.int64)
        ids, size, begin = self._ids(joined)
        text_end = np.cumsum([len(r) + 1 for r in raw])
        after = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(begin, text_end)]
        return ids, np.diff(after, prepend=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, size = self.flat(texts)
        return np.split(ids, np.cumsum(size)[:-1]) if len(size) else []


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """The worker's encoder, kept for its next tasks. A task has a core, so the library keeps to one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def _slices(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        end = at + SLICE
        while end < len(raw) and raw[end] not in _BLANKS:  # a word stays whole
            end += 1
        yield raw[at:end]
        at = end


def _closed(ids: np.ndarray, size: np.ndarray, end_id: int) -> pa.Array:
    """Each text's ids and the end id, as bytes."""
    after = np.cumsum(size + 1)
    own = np.ones(len(ids) + len(size), dtype=bool)
    own[after - 1] = False
    out = np.full(len(own), end_id, dtype="<u4")
    out[own] = ids
    if 4 * len(out) >= 1 << 31:
        raise ValueError("token shards: a text has too many ids")
    offset = np.concatenate([[0], 4 * after]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offset), pa.py_buffer(out)])


def boundaries(keys: DataFrame, ranges: int) -> np.ndarray:
    """Upper ends of all ranges of a key column but the last, null as the smallest key; reads that column alone."""
    if ranges < 2:
        return np.empty(0, dtype=np.int64)
    column = F.coalesce(F.col(keys.columns[0]).cast("long"), F.lit(_LEAST))
    row = keys.select(F.percentile_approx(column, [k / ranges for k in range(1, ranges)], max(10_000, 10 * ranges)).alias("at")).first()
    return np.array(row["at"] or [], dtype=np.int64)


def encoded(df: DataFrame, path: str, end_id: int, bounds: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, ids, range) of every row; ids end with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows = encoder_of(path), 0
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("key")
            for a, b in steps(texts):
                ids = _closed(*encoder.flat(texts[a:b]), end_id)
                part = keys.slice(a, b - a)
                key = part.fill_null(_LEAST).to_numpy(zero_copy_only=False)
                # a key that fills several ranges goes to each in turn
                low, high = (np.searchsorted(bounds, key, side=side) for side in ("left", "right"))
                to = low + (rows + np.arange(len(key))) % (high - low + 1)
                rows += len(key)
                yield pa.RecordBatch.from_arrays([part, ids, pa.array(to.astype(np.int32))], ["key", "ids", "range"])

    bounded_batches(df.sparkSession)
    return keyed_text(df, id_col, text_col).mapInArrow(run, "key long, ids binary, range int")


def stored(df: DataFrame, folder: str, path: str, end_id: int, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all texts in ascending order of the id column; the shards as a DataFrame.

    ``ranges``: default one for each ``FILE_BYTES`` of input, and as many as shuffle partitions at least."""
    spark = df.sparkSession
    ranges = ranges or target_partitions(df, FILE_BYTES)
    bounds = boundaries(df.select(F.col(f"`{id_col}`").alias("key")), ranges)
    rows = encoded(df, path, end_id, bounds, id_col, text_col).repartitionById(len(bounds) + 1, "range")
    register(spark)
    rows.sortWithinPartitions(F.asc_nulls_first("key")).select("key", "ids").write.format("token_shards").mode("append").save(folder)
    return spark.read.format("token_shards").load(folder)


# -- the data source


def register(spark: SparkSession) -> None:
    """Make ``format("token_shards")`` known to a session. Spark pushes predicates to Python sources
    only where the session allows it, whenever a read is planned, so this stays set."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenShards)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    file: dict | None


@dataclass
class File(InputPartition):
    path: str
    start: int


class TokenShards(DataSource):
    """``format("token_shards")``; option path; a schema of fewer columns reads fewer."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShardReader(self.options["path"], schema.fieldNames())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("token_shards: shards are written once")
        return ShardWriter(self.options["path"])


class ShardWriter(DataSourceArrowWriter):
    """Rows (key, ids), in ascending order of key over and within the partitions."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        partition = TaskContext.get().partitionId()
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        name, sink, blocks = f"{uuid.uuid4().hex}.rps", None, []
        try:
            for block in _blocks(iterator):
                sink = sink or fs.open_output_stream(f"{folder}/{name}", compression=None)
                raw, entry = block_bytes(*block)
                blocks.append(entry | {"at": sink.tell(), "bytes": len(raw)})
                sink.write(raw)
            if sink is not None:
                listed = json.dumps(blocks).encode()
                sink.write(listed + _TAIL.pack(len(listed), _MAGIC))
        finally:
            if sink is not None:
                sink.close()
        if not blocks:
            return Written(partition, None)
        total = {k: sum(b[k] for b in blocks) for k in ("docs", "ids")}
        return Written(partition, {"name": name, "low": blocks[0]["low"], "high": blocks[-1]["high"]} | total)

    def commit(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        files = [m.file for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition) if m.file]
        with fs.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{folder}/{m.file['name']}")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[np.ndarray], bool]]:
    """(keys, ids of each, whether the first goes on from the block before)."""
    keys: list[int | None] = []
    parts: list[np.ndarray] = []
    held, goes_on = 0, False
    for batch in batches:
        for key, raw in zip(batch.column("key").to_pylist(), batch.column("ids")):
            ids = np.frombuffer(raw.as_buffer(), dtype="<u4") if raw.is_valid else np.empty(0, dtype="<u4")
            while True:
                keys.append(key)
                parts.append(ids[: BLOCK_IDS - held].copy())
                held += len(parts[-1])
                ids = ids[len(parts[-1]) :]
                if held < BLOCK_IDS:
                    break
                yield keys, parts, goes_on
                keys, parts, held, goes_on = [], [], 0, len(ids) > 0
                if not goes_on:
                    break
    if keys:
        yield keys, parts, goes_on


def block_bytes(keys: list[int | None], parts: list[np.ndarray], goes_on: bool) -> tuple[bytes, dict]:
    sizes = np.array([len(p) for p in parts], dtype="<i8")
    starts = np.cumsum(sizes) - sizes
    ids = np.concatenate(parts)
    grammar, symbols, at = repair.compress(ids, starts)
    width = symbols.dtype.itemsize
    flags = np.array([_NO_KEY if k is None else 0 for k in keys], dtype=np.uint8)
    flags[0] |= _GOES_ON if goes_on else 0
    values = np.array([_LEAST if k is None else k for k in keys], dtype="<i8")
    kind = f"<u{width}"
    body = b"".join(x.tobytes() for x in (values, flags, sizes, at.astype("<i8"), grammar.left.astype(kind), grammar.right.astype(kind), grammar.length.astype("<i8"), symbols.astype(kind)))
    head = _HEAD.pack(_MAGIC, width, grammar.first, len(grammar.left), len(keys), len(symbols), zlib.crc32(body))
    return head + body, {"docs": len(keys) - goes_on, "ids": int(sizes.sum()), "low": int(values[0]), "high": int(values[-1])}


class Block:
    """A block's documents; grammar and symbols are read when asked for."""

    def __init__(self, source: pa.NativeFile, at: int, size: int | None = None) -> None:
        self.source = source
        self.body = None
        if size is None:
            raw = source.read_at(_HEAD.size, at)
        else:
            whole = source.read_at(size, at)
            raw, self.body = whole[: _HEAD.size], whole[_HEAD.size :]
        magic, self.width, self.first, self.rules, docs, self.symbols, crc = _HEAD.unpack(raw)
        if magic != _MAGIC or self.body is not None and zlib.crc32(self.body) != crc:
            raise ValueError(f"token shards: a damaged block at {at}")
        self.at = at + _HEAD.size
        values, flags = self._array("<i8", 0, docs), self._array(np.uint8, 8 * docs, docs)
        self.sizes, self.symbol_at = self._array("<i8", 9 * docs, docs), self._array("<i8", 17 * docs, docs)
        self.keys = [None if f & _NO_KEY else k for k, f in zip(values.tolist(), flags.tolist())]
        self.goes_on = bool(docs and flags[0] & _GOES_ON)
        self.rules_at = 25 * docs
        self._grammar: repair.Grammar | None = None

    def _array(self, kind: str | type, offset: int, count: int) -> np.ndarray:
        kind = np.dtype(kind)
        raw = self.body[offset : offset + count * kind.itemsize] if self.body is not None else self.source.read_at(count * kind.itemsize, self.at + offset)
        return np.frombuffer(raw, dtype=kind)

    @property
    def grammar(self) -> repair.Grammar:
        if self._grammar is None:
            kind, n = f"<u{self.width}", self.rules
            arrays = (self._array(kind, self.rules_at, n), self._array(kind, self.rules_at + self.width * n, n), self._array("<i8", self.rules_at + 2 * self.width * n, n))
            self._grammar = repair.Grammar(self.first, *arrays)
        return self._grammar

    def symbols_of(self, begin: int, end: int) -> np.ndarray:
        return self._array(f"<u{self.width}", self.rules_at + (2 * self.width + 8) * self.rules + self.width * begin, end - begin)

    def ids(self, doc: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the block's part of a document."""
        after = int(self.symbol_at[doc + 1]) if doc + 1 < len(self.keys) else self.symbols
        return self.grammar.expand(self.symbols_of(int(self.symbol_at[doc]), after), begin, end)

    def all_ids(self) -> list[np.ndarray]:
        return np.split(self.grammar.expand(self.symbols_of(0, self.symbols)), np.cumsum(self.sizes)[:-1])


def blocks_of(source: pa.NativeFile) -> list[dict]:
    size = source.size()
    length, magic = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
    if magic != _MAGIC:
        raise ValueError("token shards: no list of blocks")
    return json.loads(source.read_at(length, size - _TAIL.size - length))


def files_of(path: str) -> list[dict]:
    """The files of the manifest, in order, with the ids before each."""
    fs, folder = file_system(path.rstrip("/"))
    found = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.startswith(MANIFEST))
    if len(found) > 1:
        raise ValueError("token shards: a folder holds one written table")
    out, start = [], 0
    for manifest in found:
        with fs.open_input_stream(manifest) as source:
            for entry in json.loads(source.read()):
                out.append(entry | {"path": f"{folder}/{entry['name']}", "start": start})
                start += entry["ids"]
    return out


@dataclass
class KeyRange:
    """What the pushed predicates leave of the keys; rows without a key pass none of them."""

    low: int = _LEAST
    high: int = (1 << 63) - 1
    among: frozenset | None = None
    bound: bool = field(default=False)

    def within(self, low: int, high: int) -> bool:
        return low <= self.high and high >= self.low and (self.among is None or any(low <= k <= high for k in self.among))

    def holds(self, key: int | None) -> bool:
        return not self.bound or key is not None and self.low <= key <= self.high and (self.among is None or key in self.among)


class ShardReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]) -> None:
        self.path, self.columns = path.rstrip("/"), columns
        self.keys = KeyRange()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != ("key",) or not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            k, self.keys.bound = self.keys, True
            if isinstance(f, (EqualTo, In)):
                values = frozenset([f.value] if isinstance(f, EqualTo) else (v for v in f.value if v is not None))
                k.among = values if k.among is None else k.among & values
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                k.low = max(k.low, f.value + isinstance(f, GreaterThan))
            else:
                k.high = min(k.high, f.value - isinstance(f, LessThan))

    def partitions(self) -> list[File]:
        return [File(f["path"], f["start"]) for f in files_of(self.path) if self.keys.within(f["low"], f["high"])] or [File("", 0)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = file_system(self.path)
        kinds = {"key": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
        schema = pa.schema([(c, kinds[c]) for c in self.columns])
        decode = "ids" in self.columns
        rows: list[dict] = []
        held, last = 0, None  # a document may go on in the next block
        with fs.open_input_file(partition.path) as source:
            for document in self._documents(source, partition.start, decode):
                if last is not None and document["goes_on"]:
                    last["n_tokens"] += document["n_tokens"]
                    last["parts"] += document["parts"]
                    continue
                if last is not None and self.keys.holds(last["key"]):
                    rows.append(_row(last))
                    held += 50 + 4 * last["n_tokens"]
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                last = document
            if last is not None and self.keys.holds(last["key"]):
                rows.append(_row(last))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _documents(self, source: pa.NativeFile, start: int, decode: bool) -> Iterator[dict]:
        """Documents, or parts of them, of the blocks in range."""
        for entry in blocks_of(source):
            if not self.keys.within(entry["low"], entry["high"]):
                start += entry["ids"]
                continue
            block = Block(source, entry["at"], entry["bytes"] if decode else None)
            parts = block.all_ids() if decode else [None] * len(block.keys)
            for i, (key, n, ids) in enumerate(zip(block.keys, block.sizes.tolist(), parts)):
                yield {"key": key, "start": start, "n_tokens": n, "parts": [ids] if decode else [], "goes_on": not i and block.goes_on}
                start += n


def _row(held: dict) -> dict:
    return held | {"ids": b"".join(p.astype("<u4").tobytes() for p in held["parts"])}


class Shards:
    """Random access to a written table without Spark, as a training loader needs it."""

    def __init__(self, path: str) -> None:
        self.fs, _ = file_system(path)
        self.files = files_of(path)
        self.starts = np.array([f["start"] for f in self.files] + [sum(f["ids"] for f in self.files)], dtype=np.int64)

    def __len__(self) -> int:
        return int(self.starts[-1])

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the whole table; reads the rules and symbols that they need."""
        out = [np.empty(0, dtype=np.uint32)]
        first = int(np.searchsorted(self.starts, begin, side="right")) - 1
        for file in self.files[max(first, 0) :]:
            at = file["start"]
            if at >= end:
                break
            with self.fs.open_input_file(file["path"]) as source:
                for entry in blocks_of(source):
                    if at < end and at + entry["ids"] > begin:
                        block = Block(source, entry["at"])
                        after = at + np.cumsum(block.sizes)
                        for doc in range(int(np.searchsorted(after, begin, side="right")), len(block.keys)):
                            before = int(after[doc] - block.sizes[doc])
                            if before >= end:
                                break
                            out.append(block.ids(doc, max(begin - before, 0), min(end, int(after[doc])) - before).astype(np.uint32))
                    at += entry["ids"]
        return np.concatenate(out)
