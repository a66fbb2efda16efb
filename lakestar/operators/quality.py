"""Set-based replacements for the warehouse DDL constraints (PK, NOT NULL,
FOREIGN KEY, UNIQUE, VARCHAR lengths). Each check is one Spark job whose
result is a small report; nothing row-level reaches the driver."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.lookup import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small
from lakestar.session import concurrently

# ---------------------------------------------------------------------------
# Maximum text lengths declared by the registry DDL.
REGISTRY_MAX_LENGTHS = {
    "customers": {"customer_name": 100, "email": 100, "country": 50, "membership_tier": 20},
    "stores": {"store_name": 100, "city": 50, "state": 50, "country": 50},
}
# ---------------------------------------------------------------------------

#: Words of 64 keys in a bitmap that is sent to every task: 16 MB, 128 million neighbouring keys.
MAX_BITMAP_WORDS = 2_000_000


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_violations(tables: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Per (table, key column): key values occurring more than once, and the
    surplus rows they carry. NULL keys count as violations of a primary key."""
    frames = []
    for name, df, key in tables:
        per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        frames.append(
            per_key.agg(
                F.count_if((F.col("n") > 1) | F.col("k").isNull()).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("surplus_rows"),
            ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "duplicate_keys", "surplus_rows")
        )
    return _union(frames)


def dense_key_surplus(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of a dense long key, and values missing below the greatest.

    A bitmap per 32,768 neighbouring values is built on the map side, so a few
    kilobytes per bucket and task are shuffled instead of every key.
    """
    k = F.col(key)
    buckets = df.where(k.isNotNull()).groupBy(F.bitmap_bucket_number(k).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.max(k).alias("top"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(k))).alias("different")
    )
    total = buckets.agg(F.sum("n").alias("n"), F.sum("different").alias("different"), F.max("top").alias("top"))
    return total.select(
        F.lit(key).alias("key_column"),
        F.coalesce(F.col("n") - F.col("different"), F.lit(0)).cast("long").alias("surplus_rows"),
        F.coalesce(F.col("top") - F.col("different"), F.lit(0)).cast("long").alias("missing_keys"),
    )


def dense_key_violations(name: str, df: DataFrame, key: str) -> DataFrame:
    """The row of ``key_violations`` for a dense long key: the bitmaps are
    counted first, and only a key that they find repeated is grouped in full.
    Runs the counting at once."""
    found = dense_key_surplus(df, key).first()  # one row
    nulls = df.where(F.col(key).isNull()).limit(1).count()
    if found["surplus_rows"] or nulls:
        return key_violations([(name, df, key)])
    return df.sparkSession.createDataFrame([(name, key, 0, 0)], "table_name string, key_column string, duplicate_keys long, surplus_rows long")


def null_violations(tables: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """Per (table, column): rows holding NULL in a NOT NULL column. One
    aggregate pass per table, unpivoted with ``stack``."""
    frames = []
    for name, df, cols in tables:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = "stack({n}, {pairs}) as (column_name, null_rows)".format(
            n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols)
        )
        frames.append(counts.selectExpr(stack).select(F.lit(name).alias("table_name"), "column_name", "null_rows"))
    return _union(frames)


@dataclass(frozen=True)
class KeyBitmap:
    """The keys of a dense long column, a bit each, as 64-bit words from ``low`` on."""

    low: int
    words: np.ndarray

    def holds(self, key: Column, spark: SparkSession) -> Column:
        """Whether a key is one of them; the words travel as a scalar subquery, a value of the plan."""
        if not len(self.words):
            return F.lit(False)
        held = spark.createDataFrame(pa.table({"words": pa.array([self.words], pa.list_(pa.int64()))})).scalar()
        at = F.shiftright(key, 6)
        inside = at.between(self.low, self.low + len(self.words) - 1)
        word = F.get(held, F.when(inside, at - F.lit(self.low)).cast("int"))
        bit = F.bit_get(F.coalesce(word, F.lit(0).cast("long")), key.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        return inside & (bit == 1)


def key_bitmap(keys: DataFrame, column: str, max_words: int = MAX_BITMAP_WORDS, rows_at_most: int | None = None) -> KeyBitmap | None:
    """The bitmap of a column's keys, or None if they are no integers or would
    need more than ``max_words`` words. Runs at once: words are made on the map
    side, and at most ``max_words`` + 1 of them, 16 bytes each, are fetched."""
    if dict(keys.dtypes)[column] not in ("bigint", "int", "smallint", "tinyint") or (rows_at_most or 0) > 64 * max_words:
        return None
    k = F.col(column).cast("long")
    words = keys.where(k.isNotNull()).groupBy(F.shiftright(k, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("bits")
    )
    found = words.limit(max_words + 1).toArrow()
    at, bits = (found.column(c).to_numpy() for c in ("at", "bits"))
    if not len(at):
        return KeyBitmap(0, np.empty(0, dtype=np.int64))
    low, high = int(at.min()), int(at.max())
    if high - low >= max_words:
        return None
    dense = np.zeros(high - low + 1, dtype=np.int64)
    dense[at - low] = bits
    return KeyBitmap(low, dense)


def fk_violations(
    fact: DataFrame,
    refs: list[tuple[str, DataFrame, str]],
    known_rows: dict[str, int] | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bitmap_words: int = MAX_BITMAP_WORDS,
) -> DataFrame:
    """Per foreign key: fact rows whose key has no match in the dimension, and
    the distinct keys they hold. A NULL key has no match.

    Dense integer keys of a dimension become a bitmap, and one pass over the
    fact tests all such keys, without an exchange, a join or a checkpoint; only
    keys found to have orphans are looked at again. Other keys are reduced to
    (key, rows), combined on the map side, and anti joined with the dimension's
    keys, which are broadcast only if their number (given in ``known_rows``, or
    measured) is within ``max_broadcast_rows``.

    Runs at once: a job for each dimension's bitmap and one over the fact. Only
    the anti joins wait for the caller.
    """
    spark, known = fact.sparkSession, known_rows or {}
    bitmaps = concurrently([lambda r=r: key_bitmap(r[1].select(r[0]), r[0], max_bitmap_words, known.get(r[2])) for r in refs])
    orphan = {fk: ~F.coalesce(b.holds(F.col(fk).cast("long"), spark), F.lit(False)) for (fk, _, _), b in zip(refs, bitmaps) if b is not None}
    counts: dict[str, tuple[int, int]] = {}
    if orphan:
        rows = fact.agg(*[F.count_if(c).alias(fk) for fk, c in orphan.items()]).first()
        for fk, condition in orphan.items():
            keys = fact.where(condition).select(fk).distinct().count() if rows[fk] else 0
            counts[fk] = (keys, rows[fk])
    frames = []
    for fk, dim, dim_name in refs:
        named = (F.lit(fk).alias("fk_column"), F.lit(dim_name).alias("ref_table"))
        if fk in counts:
            frames.append(spark.createDataFrame([(fk, dim_name, *counts[fk])], "fk_column string, ref_table string, orphan_keys long, orphan_rows long"))
            continue
        mine = fact.groupBy(F.col(fk).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        dim_keys, _ = broadcast_if_small(dim.select(F.col(fk).alias("k")).distinct(), max_broadcast_rows, rows_at_most=known.get(dim_name))
        orphans = mine.join(dim_keys, "k", "left_anti")
        frames.append(orphans.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphan_rows")).select(*named, "orphan_keys", "orphan_rows"))
    return _union(frames)


def length_violations(tables: list[tuple[str, DataFrame, dict[str, int]]]) -> DataFrame:
    frames = []
    for name, df, limits in tables:
        cols = list(limits)
        counts = df.agg(*[F.count_if(F.length(F.col(c)) > limits[c]).alias(c) for c in cols])
        stack = "stack({n}, {triples}) as (column_name, max_length, violations)".format(
            n=len(cols), triples=", ".join(f"'{c}', {limits[c]}, `{c}`" for c in cols)
        )
        frames.append(counts.selectExpr(stack).select(F.lit(name).alias("table_name"), "column_name", "max_length", "violations"))
    return _union(frames)


def assert_clean(report: DataFrame, count_cols: list[str], what: str) -> None:
    """Raise with the offending report rows if any count is non-zero."""
    cond = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in count_cols])
    bad = report.where(cond).collect()  # report rows: one per table/column
    if bad:
        raise ValueError(f"{what} violated: " + "; ".join(str(r.asDict()) for r in bad))
