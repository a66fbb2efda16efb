"""Operator 7: embedding near-duplicates by a subspace pigeonhole join.

Unit vectors at cosine t or more are at most d = sqrt(2 - 2t) apart. After a
rotation their coordinates are split into ``BLOCKS`` blocks, each with a share
of the squared distance in proportion to its dimensions: a pair within d is
within its share in at least one block. Each block is range-joined: vectors
fall into cells of half the block's radius by one coordinate of the block (a
cell larger than ``TILE`` is cut by a hash), and a tile meets only the tiles of
cells in reach, by an equi-join. A pair of tiles is compared by block distance,
and what passes is verified by the cosine of the whole vectors in double
precision. A pair that passes in several blocks counts in the first; block
distances are taken over coordinates rounded to a fine grid, where sums are
exact, so that all blocks agree which one is first.

Equal vectors are one class (grouped with map-side combine), so groups of
copies never meet. Tiles report the number of links of each class and links
that span the connected parts, never all pairs.

The rotation only serves the speed: principal axes of at most ``SAMPLE``
vectors, dealt over the blocks. Defined results: vectors that are null, empty,
zero or hold null or non-finite components, and rows without a key, link with
nothing; vectors of different dimension don't link; repeated rows are copies;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import bounded_batches, checkpointed
from lakestar.llm.components import components
from lakestar.llm.simhash import spanning

BLOCKS = 4
#: Vectors of a tile.
TILE = 8192
#: Cells of a comparison matrix held at once.
MATRIX = 1 << 19
#: Cells of a block up to which their sizes are sent to every task.
CELLS = 100_000
#: Vectors that the rotation is fitted on.
SAMPLE = 4096
#: Coordinates are rounded to this fraction of one.
GRID = float(1 << 20)
#: Cells of a block's radius.
FINE = 2


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows over their length; scaled first, so that no square under- or overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with each row of b, both given as they are."""
    sizes = [np.sqrt((x * x).sum(axis=1)) for x in (a, b)]
    if all(np.isfinite(s).all() and (s > 1e-100).all() and (s < 1e100).all() for s in sizes):
        return (a @ b.T) / (sizes[0][:, None] * sizes[1][None, :])
    return unit(a) @ unit(b).T


class Rotations:
    """A rotation for each dimension: the fitted one, or else a fixed random one."""

    def __init__(self, fitted: dict[int, np.ndarray]) -> None:
        self.fitted = fitted

    def of(self, dim: int) -> np.ndarray:
        if dim not in self.fitted:
            self.fitted[dim] = _random(dim)
        return self.fitted[dim]

    def grid(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated unit vectors on the grid. einsum without BLAS: a row's result doesn't depend on the other rows."""
        return np.rint(np.einsum("ij,jk->ik", unit(vectors), self.of(vectors.shape[1]), optimize=False) * GRID)


@lru_cache(maxsize=16)
def _random(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]


def blocks_of(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(BLOCKS, dim) + 1).round().astype(int)
    return [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]


def budgets(dim: int, threshold: float) -> list[float]:
    """Squared distance of each block, in grid units; the rounding's share is added."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + np.sqrt(dim) / GRID + 1e-9
    return [(reach * GRID) ** 2 * (b.stop - b.start) / dim for b in blocks_of(dim)]


def fit_rotations(classes: DataFrame) -> Rotations:
    """Principal axes of a bounded sample, dealt over the blocks in turn."""
    rows = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").toArrow()
    by_dim: dict[int, list] = {}
    for v in rows.column("vector").to_pylist():
        by_dim.setdefault(len(v), []).append(v)
    fitted = {}
    for dim, vectors in by_dim.items():
        if len(vectors) >= 2 * dim:
            x = unit(np.array(vectors, dtype=np.float64))
            axes = np.linalg.eigh(np.cov(x.T).reshape(dim, dim))[1][:, ::-1]
            blocks = blocks_of(dim)
            place = np.concatenate([np.arange(k, dim, len(blocks)) for k in range(len(blocks))])
            sizes = [b.stop - b.start for b in blocks]
            # the k-th block takes axes k, k + blocks, ...; uneven sizes move a few axes on
            fitted[dim] = axes[:, place] if sum(sizes) == dim else axes
    return Rotations(fitted)


def compare(a: np.ndarray, b: np.ndarray, rotations: Rotations, block: int, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(offset of the first row, hits) over row ranges of a tile pair; hits are verified pairs whose first block this is."""
    dim = a.shape[1]
    parts, limits = blocks_of(dim), budgets(dim, threshold)
    ga, gb = rotations.grid(a), rotations.grid(b)
    squares = [((ga[:, p] ** 2).sum(axis=1), (gb[:, p] ** 2).sum(axis=1)) for p in parts]

    def within(k: int, at: slice) -> np.ndarray:
        return squares[k][0][at, None] + squares[k][1] - 2 * (ga[at, parts[k]] @ gb[:, parts[k]].T) <= limits[k]

    rows = max(1, MATRIX // max(1, len(b)))
    for begin in range(0, len(a), rows):
        at = slice(begin, begin + rows)
        hits = within(block, at)
        if same:  # each pair once, none with itself
            hits &= np.arange(len(b)) > np.arange(begin, begin + len(hits))[:, None]
        if not hits.any():
            continue
        some = np.flatnonzero(hits.any(axis=0))
        near = np.zeros_like(hits)
        near[:, some] = cosine(a[at], b[some]) >= threshold
        hits &= near
        for k in range(block):
            if hits.any():
                hits &= ~within(k, at)
        if hits.any():
            yield begin, hits


def links_of(batch: pa.RecordBatch, rotations: Rotations, threshold: float) -> Iterator[pa.RecordBatch]:
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i].as_py() for c in ("dim", "block", "same")}
        node_a, node_b, n_a, n_b = (batch.column(c)[i].values.to_numpy() for c in ("nodes", "other_nodes", "sizes", "other_sizes"))
        a, b = (_matrix(batch.column(c)[i], row["dim"]) for c in ("vectors", "other_vectors"))
        of = np.arange(len(b))
        sum_a, sum_b, links = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64), []
        for begin, hits in compare(a, b, rotations, row["block"], threshold, row["same"]):
            sum_a[begin : begin + len(hits)] += hits @ n_b
            sum_b += n_a[begin : begin + len(hits)] @ hits
            links += [(begin + x, y) for x, y in spanning(hits, of)]
        for node, total in ((node_a, sum_a), (node_b, sum_b)):
            some = np.flatnonzero(total)
            if len(some):
                yield _rows(node[some], node[some], total[some])
        if links:
            x, y = np.array(links).T
            yield _rows(node_a[x], node_b[y], np.zeros(len(x), dtype=np.int64))


def _rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])


def _matrix(vectors: pa.ListScalar, dim: int) -> np.ndarray:
    return vectors.values.flatten().to_numpy().astype(np.float64).reshape(-1, dim)


def linked(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): with a = b the number of vectors that some tile links class a with, else a spanning link."""
    spark = classes.sparkSession
    rotations = spark.sparkContext.broadcast(fit_rotations(classes))  # bounded by dim squared

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                rows = batch.take(at)
                grid = rotations.value.grid(rows.column("vector").flatten().to_numpy().astype(np.float64).reshape(-1, dim))
                for k, (part, limit) in enumerate(zip(blocks_of(dim), budgets(dim, threshold))):
                    # a little wider than a share of the radius, so that rounding never leaves the reach
                    cell = np.floor(grid[:, part.start] / (np.sqrt(limit) / FINE * 1.001)).astype(np.int64) if limit else grid[:, part.start].astype(np.int64)
                    n = rows.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array([dim] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array(cell), *(rows.column(c) for c in ("node", "size", "vector"))], ["dim", "block", "cell", "node", "size", "vector"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = classes.select("node", "size", "vector").mapInArrow(place, f"dim int, block int, cell long, node long, size long, vector {kind}")
    placed = checkpointed(placed)
    key = ["dim", "block", "cell"]
    cuts = placed.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(float(TILE))).cast("long").alias("cuts"))
    # a coordinate of a unit vector lies in -1 .. 1, so a block has at most so many cells
    if 2 + 2 * FINE / np.sqrt(max(0.0, 2 - 2 * threshold) / BLOCKS + 1e-12) <= CELLS:
        cuts = F.broadcast(cuts)
    tiles = (
        placed.join(cuts, key)
        .groupBy(*key, F.pmod(F.xxhash64("node"), F.col("cuts")).alias("cut"))
        .agg(F.collect_list(F.struct("node", "size", "vector")).alias("rows"))  # about ``TILE`` rows
        .select(*key, "cut", F.col("rows.node").alias("nodes"), F.col("rows.size").alias("sizes"), F.col("rows.vector").alias("vectors"))
    )
    tiles = checkpointed(tiles)
    visits = tiles.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(FINE)))).select(
        "dim", "block", (F.col("cell") + F.col("step")).alias("cell"), "step", F.col("cut").alias("other_cut"), *[F.col(c).alias(f"other_{c}") for c in ("nodes", "sizes", "vectors")]
    )
    pairs = tiles.join(visits, key).where("step > 0 or cut <= other_cut").withColumn("same", F.expr("step = 0 and cut = other_cut")).drop("cell", "cut", "other_cut", "step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from links_of(batch, rotations.value, threshold)

    return pairs.mapInArrow(run, "a long, b long, n long")


def deduplicated(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{vector_col}`").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("key").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    classes = checkpointed(rows.where("valid").groupBy("vector").agg(F.min("key").alias("node"), F.count("*").alias("size")))
    found = checkpointed(linked(classes, threshold))
    links = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    parts = components(found.where("a <> b").select("a", "b"))
    named = classes.join(links, "node", "left").join(parts, "node", "left").select("vector", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked_rows = rows.where("valid").join(named, "vector").select("key", "n_links", "component_id")
    others = rows.where("not valid").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = linked_rows.unionByName(others)
    return out.select(F.col("key").alias(id_col), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
