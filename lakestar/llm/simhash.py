"""Operator 5: SimHash near-duplicates by tiled exact comparison.

Equal fingerprints are one class (grouped with map-side combine, so groups of
copies never meet). Distinct fingerprints fall into cells by the population
counts of their four 16-bit words; a cell larger than ``TILE`` is cut into
tiles by a hash. The counts of two fingerprints within the radius differ by no
more than the radius in sum, so a tile only meets tiles of cells that near: it
is sent to those cells (a fixed list of neighbours, an equi-join), and all other
tile pairs are skipped. A pair of tiles is compared exactly by numpy exclusive-or
and bit counts, and reports links that span its connected parts, never all pairs.

Defined results: a null or empty text has the fingerprint zero, which links like
any other; null keys take part, and are the smallest key of no component unless
it has none but null; repeated rows give repeated rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import bounded_batches, checkpointed, keyed_text, texts_of, unclashed
from lakestar.llm.components import components

#: Fingerprints of a tile.
TILE = 16_384
#: Cells of a comparison matrix held at once.
MATRIX = 1 << 20

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64 bits; a bit is set if it is set in over half the hashes of the shingles, repeats included."""
    words = text.encode("utf-8").translate(_LOWER).split()  # bytes are split at exactly the six ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = [b" ".join(words[i : i + shingle]) for i in range(n)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in joined), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, bits) of every text; bits is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(bits.view(np.int64))], ["key", "bits"])

    bounded_batches(df.sparkSession)
    return keyed_text(df, id_col, text_col).mapInArrow(run, "key long, bits long")


def spanning(hits: np.ndarray, of: np.ndarray) -> list[tuple[int, int]]:
    """Links between rows and columns that connect the same as all hits of a matrix do.

    ``of`` holds a part number for each column and is updated: columns of one
    part are connected already. A row yields one link for each part it hits.
    """
    links = []
    for row in np.flatnonzero(hits.any(axis=1)).tolist():
        at = np.flatnonzero(hits[row])
        parts, first = np.unique(of[at], return_index=True)
        links.extend((row, int(at[i])) for i in first.tolist())
        if len(parts) > 1:
            of[np.isin(of, parts)] = parts[0]
    return links


def near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links between two tiles of fingerprints, as (from a, from b)."""
    rows = max(1, MATRIX // max(1, len(b)))
    of = np.arange(len(b))
    for at in range(0, len(a), rows):
        hits = np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius
        if same:  # a fingerprint need not meet itself
            k = np.arange(min(rows, len(a) - at))
            hits[k, at + k] = False
        if hits.any():
            links = np.array(spanning(hits, of))
            yield a[at + links[:, 0]], b[links[:, 1]]


def _neighbours(radius: int, words: int = 4) -> list[tuple[int, ...]]:
    """Differences of cell counts within the radius; of two opposite ones only the first, and none at all."""
    steps = (d for d in itertools.product(range(-radius, radius + 1), repeat=words) if sum(map(abs, d)) <= radius)
    return [d for d in steps if d >= (0,) * words]


def linked(distinct: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b) links that connect all fingerprints (column bits, all different) within the radius."""
    spark = distinct.sparkSession
    word = [F.bit_count(F.shiftrightunsigned("bits", 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(4)]
    cells = distinct.select("bits", *[w.alias(f"c{i}") for i, w in enumerate(word)])
    key = [f"c{i}" for i in range(4)]
    # at most 17**4 cells
    sizes = cells.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(float(tile))).cast("long").alias("cuts"))
    tiles = (
        cells.join(F.broadcast(sizes), key)
        .withColumn("cut", F.pmod(F.xxhash64("bits"), F.col("cuts")))
        .groupBy(*key, "cut")
        .agg(F.collect_list("bits").alias("bits"))  # about ``tile`` rows
    )
    tiles = checkpointed(tiles)
    # a fixed list of differences: each tile goes to the cells in reach
    steps = F.array(*[F.array(*map(F.lit, d)) for d in _neighbours(radius)])
    visits = tiles.withColumn("d", F.explode(steps)).select(*[(F.col(k) + F.col("d")[i]).alias(k) for i, k in enumerate(key)], F.col("cut").alias("other_cut"), F.col("bits").alias("other"), (F.col("d") == F.array(*[F.lit(0)] * 4)).alias("home"))
    pairs = tiles.join(visits, key).where("not home or cut <= other_cut").select("bits", "other", (F.col("home") & (F.col("cut") == F.col("other_cut"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy().view(np.uint64) for c in ("bits", "other"))
                for x, y in near(a, b, radius, batch.column("same")[i].as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    bounded_batches(spark)
    return pairs.mapInArrow(run, "a long, b long")


def deduplicated(df: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the smallest key reachable."""
    rows = checkpointed(fingerprints(df, shingle, seed, id_col, text_col))
    classes = checkpointed(rows.groupBy("bits").agg(F.min("key").alias("least")))
    # links name fingerprints; components are taken over them, then named by the smallest key
    found = components(linked(classes.select("bits"), radius))
    member = classes.join(found.select(F.col("node").alias("bits"), "component"), "bits", "left")
    member = member.select("bits", "least", F.coalesce("component", "bits").alias("component"))
    # combined on the map side, and cut off here: the join below is then a plain one, whose hot keys Spark can split
    names = checkpointed(member.groupBy("component").agg(F.min("least").alias("component_id")))
    named = member.join(names, "component").select("bits", "component_id")
    return rows.join(named, "bits").select(F.col("key").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(df: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that with its smallest key, with all columns.

    A key names a document: of several rows with one key one stays. Rows
    without a key cannot be named and all stay.
    """
    found = deduplicated(df.where(F.col(f"`{id_col}`").isNotNull()), radius, shingle, seed, id_col, text_col)
    name = unclashed(df.columns, "kept_key")
    kept = found.where(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias(name)).agg(F.count("*").alias("n"))
    kept = checkpointed(kept)
    key = F.col(f"`{id_col}`").cast("long")
    once = df.join(kept.where("n = 1").select(name), key == F.col(name), "left_semi")
    more = df.join(kept.where("n > 1").select(name), key == F.col(name), "left_semi").dropDuplicates([id_col])
    return once.unionByName(more).unionByName(df.where(key.isNull()))
