"""Operator 1: byte-level BPE encoding and decoding.

Texts are cut into pieces by the public split pattern; every distinct piece of
a worker is merged once in length-bucketed padded matrices (``bpe``). Nothing
is shuffled: each task streams Arrow batches and works on bounded steps of
characters, whatever the length of a text.

Defined results: a null text is the empty text; the empty text has no ids and
the digest of no bytes; a null key stays null; repeated rows give repeated
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakestar.llm import bpe
from lakestar.llm.common import bounded_batches, keyed_text, steps, texts_of


def encoded(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, ids array<int>) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.rank_encoder(path)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("key")
            for a, b in steps(texts):
                flat, counts = encoder.encode(texts[a:b])
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), ids], ["key", "ids"])

    bounded_batches(df.sparkSession)
    return keyed_text(df, id_col, text_col).mapInArrow(run, "key long, ids array<int>")


def decoded(ids: DataFrame, path: str, id_col: str = "key", ids_col: str = "ids") -> DataFrame:
    """(key, bytes) of every row of ids; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = bpe.rank_file(path)
        for batch in batches:
            rows = [merges.decode(np.array(x or [], dtype=np.int64))[0].tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, pa.binary())], ["key", "bytes"])

    bounded_batches(ids.sparkSession)
    return ids.selectExpr(f"cast(`{id_col}` as long) key", f"`{ids_col}` ids").mapInArrow(run, "key long, bytes binary")


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.rank_encoder(path)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("key")
            for a, b in steps(texts):
                flat, counts = encoder.encode(texts[a:b])
                raw, lengths = encoder.merges.decode(flat)
                ids = memoryview(flat.astype("<u4")).cast("B")
                at = np.concatenate(([0], np.cumsum(counts)))
                byte_at = np.concatenate(([0], np.cumsum(lengths)))[at]
                raw = memoryview(np.ascontiguousarray(raw))
                at, byte_at = at.tolist(), byte_at.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(a, b - a),
                        pa.array(counts, pa.int64()),
                        pa.array([hashlib.sha256(ids[4 * x : 4 * y]).hexdigest() for x, y in zip(at, at[1:])], pa.string()),
                        pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(byte_at, byte_at[1:])], pa.string()),
                    ],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    bounded_batches(df.sparkSession)
    out = keyed_text(df, id_col, text_col).mapInArrow(run, "key long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", id_col)
