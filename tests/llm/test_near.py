"""Operators 5 and 7 and connected components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestar.llm import embedding_dedup, simhash
from lakestar.llm.components import _state, components

from . import brute


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops", "none"])
def test_components(spark, shape):
    rnd = random.Random(3)
    edges = {
        "chain": [(i, i + 1) for i in rnd.sample(range(300), 300)],
        "star": [(500, i) for i in range(200)] + [(0, 900)],
        "random": [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)],
        "loops": [(1, 1), (2, 2), (2, 3), (3, 2), (2, 3)],
        "none": [],
    }[shape]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    reach = {a: set() for a in range(1001)}
    for a, b in edges:
        reach[a].add(b)
        reach[b].add(a)
    parts = brute.connected(1001, lambda i: reach[i])
    assert got == {n: parts[n] for n in nodes}


def test_state_of_many_edges(spark):
    """Hashes of 40 bits each that add up beyond a long."""
    n = 18_000_000
    edges = spark.range(0, n, 1, 8).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    count, total = _state(edges)
    assert count == n and 2**63 < total < n * 2**40
    assert _state(edges.where("a > 0")) != (count, total) and _state(edges.limit(0)) == (0, 0)


def test_fingerprints():
    for text in ("", "one", "Two words", "a b c", "a b c d A B C", "ÄÖ x y z " * 50, "the\x1cfile x y z"):
        assert simhash.fingerprint(text) == brute.fingerprint(text)


def near_texts():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(300)) for _ in range(6)]
    out = [*base, base[0], base[0].upper()]
    for b in base[:3]:
        for _ in range(12):
            w = b.split()
            w[rnd.randrange(300)] = rnd.choice(words)
            out.append(" ".join(w))
    return out


def test_simhash_query(spark, odd, documents, empty):
    crowd = spark.createDataFrame(list(enumerate(near_texts(), 5000)), "doc_id long, text string")
    for df in (crowd, odd, documents):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        assert Counter(map(tuple, simhash.deduplicated(df).collect())) == Counter(brute.near_dedup(rows))
    assert simhash.deduplicated(empty).count() == 0


@pytest.mark.parametrize("tile", [3, 64])
def test_small_tiles_lose_no_link(spark, tile):
    """Many close fingerprints cut into many tiles connect as all pairs do, and few links are sent."""
    rnd = random.Random(tile)
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(6):
            prints.add(f)
            f ^= (1 << rnd.randrange(64)) | (1 << rnd.randrange(64))
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    df = spark.createDataFrame([(f,) for f in signed], "bits long")
    links = [tuple(r) for r in simhash.linked(df, 3, tile).collect()]
    place = {f: i for i, f in enumerate(signed)}
    near = {i: [j for j, g in enumerate(signed) if bin((f ^ g) & (2**64 - 1)).count("1") <= 3] for i, f in enumerate(signed)}
    assert all(place[b] in near[place[a]] for a, b in links)
    sides = {i: [] for i in near}
    for a, b in links:
        sides[place[a]].append(place[b])
    assert brute.connected(len(signed), near.get) == brute.connected(len(signed), sides.get)


def test_spanning_keeps_parts_and_is_small():
    rnd = np.random.default_rng(1)
    for share in (0.02, 0.2, 1.0):
        hits = rnd.random((40, 50)) < share
        links = simhash.spanning(hits, np.arange(50))
        assert len(links) <= 90 and all(hits[x, y] for x, y in links)
        full = {i: [40 + j for j in np.flatnonzero(hits[i])] if i < 40 else [] for i in range(90)}
        some = {i: [40 + y for x, y in links if x == i] for i in range(90)}
        assert brute.connected(90, full.get) == brute.connected(90, some.get)


def test_representatives_keep_columns_and_one_of_each(odd, documents, empty):
    for df in (odd, documents):
        rows = [(r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] is not None]
        kept = simhash.representatives(df)
        assert kept.columns == df.columns
        got = kept.collect()
        whole = set(map(tuple, df.collect()))
        assert all(tuple(r) in whole for r in got)
        assert Counter(r["doc_id"] for r in got if r["doc_id"] is not None) == Counter({c for _, _, c in brute.near_dedup(rows)})
        assert sum(r["doc_id"] is None for r in got) == df.where("doc_id is null").count()
    assert simhash.representatives(empty).count() == 0


def vectors(dim, seed):
    rnd = np.random.default_rng(seed)
    centre = rnd.standard_normal((8, dim))
    out = [c + s * rnd.standard_normal(dim) for c in centre for s in (0, 0, 0.01, 0.3, 0.45, 0.5, 0.55, 0.6)]
    return [*out, *rnd.standard_normal((40, dim)), out[0] * 3, -out[0]]


def odd_vectors():
    return [None, [], [0.0, 0.0], [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1e-30, 1e-31], [1e30, 1e29], [1.0], [3.0], [-1.0]]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_query(spark, kind, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)  # workers are forked anew for the closure: the plan alone uses it
    for dim in (3, 24, 64):
        rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors(dim, dim), 10)]
        df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label string, node int")
        got = Counter(map(tuple, embedding_dedup.deduplicated(df).collect()))
        assert got == Counter(brute.vector_dedup(rows))


def test_embedding_odd_rows(spark):
    rows = [*enumerate(odd_vectors()), (6, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, embedding_dedup.deduplicated(df).collect())) == Counter((k, n, c, c == k) for k, n, c, _ in brute.vector_dedup(rows))
    assert embedding_dedup.deduplicated(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet").limit(150)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    rows += [(10_000 + k, [x + 0.01 for x in v]) for k, v in rows[:40]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert Counter(map(tuple, embedding_dedup.deduplicated(df).collect())) == Counter(brute.vector_dedup(rows))


def test_each_pair_counts_in_one_block():
    rnd = np.random.default_rng(5)
    for dim in (2, 5, 64):
        a = rnd.standard_normal((60, dim))
        b = a + rnd.choice([0.0, 1e-9, 0.05, 0.3], (60, 1)) * rnd.standard_normal((60, dim))
        rotations = embedding_dedup.Rotations({})
        total = np.zeros((60, 60), dtype=int)
        for block in range(len(embedding_dedup.blocks_of(dim))):
            for begin, hits in embedding_dedup.compare(a, b, rotations, block, 0.9, False):
                total[begin : begin + len(hits)] += hits
        assert (total == (embedding_dedup.cosine(a, b) >= 0.9)).all()
