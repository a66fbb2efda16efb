"""Size-checked broadcast joins, with a hot-key salted shuffle join beyond the bound.

A side is broadcast only after its rows and bytes have been measured against
bounds. Above the bound the join becomes a shuffle join in which only the hot
keys, and rows with a NULL key, are split: keys of the left side with more than ``hot_rows`` rows are
found with a map-side combined count, each of their rows carries a salt in
[0, salts) derived from a hash of the row, and only the matching lookup rows
are replicated once per salt (``explode`` of a sequence, not a cross join).
A key holding a third of all left rows is thereby spread over ``salts``
tasks; every other key joins unsalted. AQE's skew handling stays on as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
DEFAULT_SALTS = 32
DEFAULT_HOT_ROWS = 1_000_000
_SALT = "__salt"
_HOT = "__hot"


# Bytes of a value held in a broadcast relation, by type; text and other open-ended types are measured.
_FIXED_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "date": 4, "timestamp": 8}
_ROW_BYTES = 16


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one combined aggregate: no row leaves its task."""
    fixed = _ROW_BYTES + sum(_FIXED_BYTES.get(t, 0) for _, t in df.dtypes)
    open_ended = [c for c, t in df.dtypes if t not in _FIXED_BYTES]
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in open_ended], F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()
    return row["n"], row["n"] * fixed + row["b"]


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    rows_at_most: int | None = None,
) -> tuple[DataFrame, bool]:
    """``rows_at_most``: a known bound of the rows; without open-ended columns it bounds the bytes too and saves the measuring."""
    fixed = all(t in _FIXED_BYTES for _, t in df.dtypes)
    if rows_at_most is not None and (fixed or rows_at_most > max_rows):
        n, size = rows_at_most, rows_at_most * (_ROW_BYTES + sum(_FIXED_BYTES.get(t, 0) for _, t in df.dtypes))
    else:
        n, size = measured(df)
    small = n <= max_rows and size <= max_bytes
    return (F.broadcast(df) if small else df), small


def _null_key(on: list[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def hot_keys(left: DataFrame, on: list[str], hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Keys of ``left`` holding more than ``hot_rows`` rows (at most
    rows / hot_rows of them). Rows with a NULL key are salted whatever their number."""
    return (
        left.where(~_null_key(on))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > hot_rows)
        .select(*on)
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    salts: int = DEFAULT_SALTS,
    hot_rows: int = DEFAULT_HOT_ROWS,
    max_hot_keys: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join with the left side's hot keys spread over ``salts`` tasks.

    The salt is a hash of the left row's columns, so a recomputed task
    assigns the same salts (no random numbers). Valid for inner and left
    joins: each left row meets exactly one copy of each matching right row.
    """
    if how not in ("left", "left_outer", "inner"):
        raise ValueError(f"salted join supports inner/left joins, not {how}")
    hot, small = broadcast_if_small(hot_keys(left, on, hot_rows).withColumn(_HOT, F.lit(True)), max_hot_keys)
    if not small:  # too many hot keys to list: salt every key
        hot = None
    row_hash = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts))
    all_salts = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    if hot is None:
        salted_left = left.withColumn(_SALT, row_hash)
        replicated = right.withColumn(_SALT, F.explode(all_salts))
    else:
        salted_left = left.join(hot, on, "left").withColumn(
            _SALT, F.when(F.col(_HOT) | _null_key(on), row_hash).otherwise(F.lit(0).cast("long"))
        ).drop(_HOT)
        replicated = right.join(hot, on, "left").withColumn(
            _SALT, F.explode(F.when(F.col(_HOT), all_salts).otherwise(F.array(F.lit(0).cast("long"))))
        ).drop(_HOT)
    return salted_left.join(replicated, [*on, _SALT], how).drop(_SALT)


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    salts: int = DEFAULT_SALTS,
    rows_at_most: int | None = None,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """``rows_at_most``: a known upper bound of the lookup's rows (e.g. the
    row count of the dimension it was aggregated from); saves the count."""
    side, small = broadcast_if_small(lookup, max_rows, rows_at_most=rows_at_most)
    if small:
        return left.join(side, on, how)
    keys = [on] if isinstance(on, str) else list(on)
    return salted_join(left, lookup, keys, how, salts, hot_rows)
