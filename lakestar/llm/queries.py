"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm import bpe_codec, embedding_dedup, langid, license_scan, packing, periodic, pii, quality, simhash, spelling, token_count, token_shards, warc
from lakestar.llm.common import table
from lakestar.session import work_dir

RANKS = "byte_bpe_50k.tiktoken"
MERGES = "byte_bpe_50k.json"
WORDS = "word_bpe_49k.json"


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scanned(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(MERGES), limit=1024)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(table(spark, sf_dir, "documents"), radius=3, shingle=3, seed=42)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(MERGES), capacity=1024, end_id=2)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicated(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least=1000)


def op11_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_dir(spark)}/token-shards-{uuid.uuid4().hex}"
    held = token_shards.stored(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORDS), end_id=2)
    return held.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def without_letter(key: int, word: str) -> str:
    """The contract's planted misspellings: of one (document, word) pair in 97, one letter goes."""
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"), shortest=5, least=3, ratio=2, rewrite=without_letter)


def with_loops(docs: DataFrame) -> DataFrame:
    """The contract's planted loops: in one document of ten the words from one on repeat a period.

    (doc_id, text); words are joined by blanks where they repeat, other texts stay."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.select("*", F.size("words").cast("long").alias("n"))
    rows = rows.select("*", F.expr("if(n > 0, g % n, null)").alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    loop = F.expr("slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), int(ceil((n - a) / p)))), 1, int(n - a))")
    looped = F.array_join(F.concat(F.expr("slice(words, 1, int(a))"), loop), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.detected(with_loops(table(spark, sf_dir, "documents")), shortest=12)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("run"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        (-F.col("run.start")).alias("start"),
        F.col("run.length").alias("length"),
        (-F.col("run.period")).alias("period"),
        F.expr("1000 * run.length div -run.period").alias("exponent_milli"),
        F.sha2(F.encode("lines", "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_license_scan": op2_license_scan,
    "op3_pii": op3_pii,
    "op4_token_counts": op4_token_counts,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_token_shards": op11_token_shards,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Statements only where SQL expresses the whole result.
ORACLE: dict[str, str] = {}
