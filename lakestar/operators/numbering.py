"""Dense 1..n numbering over a total order without a single-task window.

``row_number() over (order by ...)`` with no partition moves every row into
one task. Instead:

1. ``stage_ordered`` range-partitions on the order columns, sorts within each
   partition and checkpoints the result into the session's checkpoint dir, so
   every later pass (and any recomputation after an executor loss) sees the
   same partitions in the same order;
2. ``partition_counts`` counts rows per staged partition (optionally also rows
   matching conditions) in one aggregate pass: one row per partition;
3. ``partition_offsets`` turns those counts into prefix offsets with a window
   over that tiny table;
4. ``number_rows`` adds in-partition position (``monotonically_increasing_id``
   minus the partition bits) and the partition's offset, via a broadcast join
   on the partition id. The broadcast side has exactly one row per partition,
   so its size is bounded by the partition count.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.session import checkpoint_dir

PID = "__pid"
POS = "__pos"


def stage_in_place(df: DataFrame) -> DataFrame:
    """Checkpoint rows that are already in the order of their files, without any exchange."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


KEPT = "__kept"
ROW = "__row"


@contextmanager
def _rows_as_they_come(spark: SparkSession) -> Iterator[None]:
    """Within, a partitioned write keeps a file open for each partition value
    instead of sorting its rows by it, so files hold rows in arrival order."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, "4")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage_columns(df: DataFrame, keep: Column, path: str) -> DataFrame:
    """Stage rows, in the order of their partitions, as Parquet below ``path``.

    What later passes need to number rows is stored with them: the partition
    ``__pid`` and the position ``__pos`` in it. Rows that are kept and others
    go to files of their own (``__kept``), one each for a partition, so the
    place ``__row`` in its file numbers a row among those of its kind. A pass
    reads the columns it needs, and only the kept rows if that is enough.
    """
    spark = df.sparkSession
    rows = df.select("*", F.spark_partition_id().alias(PID), local_position().alias(POS), keep.alias(KEPT))
    with _rows_as_they_come(spark):
        rows.write.option("maxRecordsPerFile", 0).partitionBy(KEPT).parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select("*", F.col("_metadata.row_index").alias(ROW))


def stage_ordered(df: DataFrame, order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_dir(spark)
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = df.repartitionByRange(num_partitions, *order_cols).sortWithinPartitions(*order_cols)
    return staged.checkpoint(eager=True)


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def _parse_bytes(text: str) -> int:
    """A Spark byte-size setting such as ``10g`` or ``9223372036854775807b``."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", text)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df``; None when it is not known."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        unknown = _parse_bytes(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. remote session)
        return None
    return None if size >= unknown else size


def target_partitions(df: DataFrame, bytes_per_partition: int = TARGET_PARTITION_BYTES) -> int:
    """Partition count for a full shuffle of ``df``: the optimizer's size
    estimate (file sizes for scans; no job runs) over the target partition
    size, and at least ``spark.sql.shuffle.partitions``. An unknown size (the
    optimizer's default estimate) falls back to that floor."""
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    if size is None:
        return floor
    return int(max(floor, -(-size // bytes_per_partition)))


#: Cells of equal width, for each range, into which a key's span is cut.
CELLS = 256


def key_ranges(df: DataFrame, column: str, ranges: int) -> Column | None:
    """Number of a row's range, for rows whose order begins with this whole-number column.

    The ends of the ranges are quantiles, moved up to the next of many cells of equal width, so a row
    finds its range by one division. Reads that column alone, where ``repartitionByRange`` computes
    whole rows to sample them and then compares a row with one end after the other. NULL is in the
    first range. None where it would not part the rows evenly (a cell, a key or NULL fills more
    than a range), so that all order columns have to part them."""
    key = F.col(column).cast("long")
    if ranges < 2 or df.schema[column].dataType.typeName() not in ("long", "integer", "short", "byte"):
        return None
    quantiles = F.percentile_approx(key, [k / ranges for k in range(1, ranges)], max(10_000, 10 * ranges))
    row = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), quantiles.alias("ends"), F.count_if(key.isNull()).alias("none"), F.count(F.lit(1)).alias("n")).first()
    if row["ends"] is None or row["none"] * ranges > row["n"] or row["high"] - row["low"] >= 1 << 62:
        return None
    low, width = row["low"], (row["high"] - row["low"]) // (CELLS * ranges) + 1
    ends = [(end - low) // width for end in row["ends"]]
    if len(set(ends)) < len(ends):
        return None
    of_cell = [bisect_left(ends, cell) for cell in range((row["high"] - low) // width + 1)]
    cell = F.call_function("div", key - F.lit(low).cast("long"), F.lit(width).cast("long")).cast("int")
    return F.when(key.isNull(), 0).otherwise(F.get(F.split(F.lit(",".join(map(str, of_cell))), ",").cast("array<int>"), cell))


def local_position() -> Column:
    """0-based position of the row within its partition, in arrival order."""
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)


def partition_counts(staged: DataFrame, conditions: dict[str, Column] | None = None) -> DataFrame:
    """(__pid, n[, n_<name> ...]): rows per partition, and rows matching each
    condition, in one pass."""
    conditions = conditions or {}
    return staged.groupBy(F.spark_partition_id().alias(PID)).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"n_{k}") for k, c in conditions.items()]
    )


def partition_offsets(counts: DataFrame, count_col: str = "n") -> DataFrame:
    """(__pid, __off): rows in all earlier partitions."""
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(PID, F.coalesce(F.sum(count_col).over(before), F.lit(0)).cast("long").alias("__off"))


def run_offsets(runs: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Offsets of runs of rows that are in order within a partition.

    ``runs`` has a row for each run: ``key`` (with the partition id), its rows
    ``n``, its kept rows ``n_kept`` and the position ``first`` of its first row
    in the partition. ``order`` sorts the runs of all partitions. The result
    (key, __off_all, __off_kept) turns a row's position in its partition,
    before and after the rows that are not kept went, into its place in the
    whole. Its size is that of ``runs``: partitions, or splits of files.
    """
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(PID).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    return runs.select(
        *key,
        (before("n", earlier) - F.col("first")).cast("long").alias("__off_all"),
        (before("n_kept", earlier) - before("n_kept", inside)).cast("long").alias("__off_kept"),
    )


def number_rows(
    staged: DataFrame,
    out_col: str,
    where: Column | None = None,
    start: int = 1,
) -> DataFrame:
    """Append ``out_col`` = position (from ``start``) in partition/row order.

    ``staged`` must come from ``stage_ordered`` (or be a narrow transformation
    of it). With ``where`` only the matching rows are kept and numbered.
    """
    rows = staged if where is None else staged.where(where)
    located = rows.withColumn(PID, F.spark_partition_id()).withColumn(POS, local_position())
    numbered = located.join(F.broadcast(partition_offsets(partition_counts(rows))), PID, "inner")
    return numbered.withColumn(out_col, F.col(POS) + F.col("__off") + F.lit(start)).drop(PID, POS, "__off")


def number_in_file_order(df: DataFrame, file_position: list[str], out_col: str, start: int = 0) -> DataFrame:
    """Number rows read with file positions by (file, place in the file), without an exchange of the rows."""
    staged = stage_in_place(df)
    key = [PID, *file_position[:2]]
    located = staged.withColumn(PID, F.spark_partition_id()).withColumn(POS, local_position())
    runs = located.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("n_kept"), F.min(POS).alias("first"))
    offsets = run_offsets(runs, key, file_position[:2])
    numbered = located.join(F.broadcast(offsets), key, "inner")
    return numbered.withColumn(out_col, F.col(POS) + F.col("__off_all") + F.lit(start)).drop(PID, POS, "__off_all", "__off_kept", *file_position)
