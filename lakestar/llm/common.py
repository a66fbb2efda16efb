"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.session import checkpoint_dir

#: Characters that one vectorised step works on; bounds a worker's memory, not the input.
STEP_CHARS = 1_500_000

#: Bytes of one Arrow batch sent to a Python worker.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, so long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (key, text) of any table; a null text stays null."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))


def steps(texts: list[str], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` characters; a longer text has a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unclashed(columns: list[str], wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken, name = {c.lower() for c in columns}, wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name


def kept_rows(df: DataFrame, text_col: str, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """Rows of any table whose text passes, with all their columns.

    ``keep`` maps a list of texts to a list of booleans. Columns travel as they
    are, so names that a judgement would use can't clash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(texts_of(batch, text_col)), pa.bool_()))

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
