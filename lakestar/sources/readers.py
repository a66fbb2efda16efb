"""Bronze readers. Every reader fixes its schema or picks columns by header
name; none infers types (an extra pass, and unstable across files)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from lakestar import schemas


# ---------------------------------------------------------------------------
# Field texts of a CSV that stand for a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# ---------------------------------------------------------------------------
_LONGEST_TOKEN = max(len(t.encode()) for t in MISSING_TOKENS)

FILE_POSITION = {"_src_file": "string", "_src_block": "long", "_src_row": "long"}


def with_file_position(df: DataFrame) -> DataFrame:
    """Attach the row's position in its input files as order columns: file
    path, split start offset, and the row counter of the scan partition.

    Rows of one split are read in file order within one partition, so the
    three columns order rows by (file path, position in file); the counter is
    taken right on the scan, before any shuffle, so a recomputed task yields
    the same values. Must be applied directly to a file-source DataFrame.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_block"),
        F.monotonically_increasing_id().alias("_src_row"),
    )


def _with_order(schema: StructType, order_columns: dict[str, str] | None) -> StructType:
    return StructType([*schema.fields, *(StructField(n, _parse_datatype_string(t)) for n, t in (order_columns or {}).items())])


def read_registry(
    spark: SparkSession, path: str, table: str, order_columns: dict[str, str] | None = None, file_order: bool = False
) -> DataFrame:
    """Customer or store registry stored as Parquet. The source's row order,
    which decides between rows of one key, comes from ``order_columns`` (name
    -> type) or, with ``file_order``, from the position in the files."""
    schema = {"customers": schemas.REGISTRY_CUSTOMERS, "stores": schemas.REGISTRY_STORES}[table]
    df = spark.read.schema(_with_order(schema, order_columns)).parquet(path)
    return with_file_position(df) if file_order else df


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Registry table from an OLTP database, split into ``num_partitions``
    parallel range reads on ``partition_column`` (the driver jar must be on the
    classpath). Not exercised by the tests: no database runs here."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=properties or {},
    )


def read_catalogue(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    order_columns: dict[str, str] | None = None,
    file_order: bool = False,
) -> DataFrame:
    """Product catalogue as JSON: one object per line, or (``multi_line``)
    files that each hold one array of objects, like an API payload. Fields are
    bound by name; fields other than id/title/price/category and the order
    columns are dropped."""
    df = spark.read.schema(_with_order(schemas.CATALOGUE, order_columns)).option("multiLine", multi_line).json(path)
    return with_file_position(df) if file_order else df


def _read_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Every column as text under its header name; the caller selects by name
    and casts, since a supplied schema would bind columns by position.

    A doubled quote inside a quoted field is a quote. ``multi_line`` allows
    line breaks inside quoted fields; such files are not split, so it is an
    option of the source. Files whose headers differ are refused instead of
    being read by position.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"CSV at {path} lacks columns {missing}")
    return raw


def _typed(name: str, type_: str) -> Column:
    """A text field cast to its type, missing-value texts as NULL. Texts that are a number, or longer
    than every missing-value text, are not looked up among these (none of them is a number but NaN)."""
    text = F.col(f"`{name}`")
    value = F.when((F.octet_length(text) > _LONGEST_TOKEN) | ~text.isin(MISSING_TOKENS), text).cast(type_)
    if type_ in ("int", "long"):
        value = F.coalesce(text.try_cast(type_), value)
    elif type_ == "double":
        value = F.coalesce(F.nanvl(text.try_cast(type_), F.lit(None).cast(type_)), value)
    return value.alias(name)


def read_ledger(
    spark: SparkSession, path: str, order_columns: dict[str, str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Sales ledger CSV with a header row. ``order_columns`` (name -> type)
    carries the ledger's row order for positional numbering; a file without
    one needs its position attached at ingest."""
    cols = dict(schemas.LEDGER_COLUMNS)
    cols.update(order_columns or {})
    return _read_csv(spark, path, list(cols), multi_line=multi_line).select(*[_typed(c, t) for c, t in cols.items()])


def read_ledger_in_file_order(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Sales ledger CSV without an order column: its order is file order."""
    raw = _read_csv(spark, path, list(schemas.LEDGER_COLUMNS), multi_line=multi_line)
    return with_file_position(raw).select(*[_typed(c, t) for c, t in schemas.LEDGER_COLUMNS.items()], *FILE_POSITION)


def _cp1252_c1_table() -> tuple[str, str]:
    # Latin-1 decodes bytes 0x80-0x9F to C1 controls; windows-1252 assigns
    # printable characters to most of them. Derive the table from the codec.
    src, dst = [], []
    for b in range(0x80, 0xA0):
        try:
            ch = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            continue
        src.append(chr(b))
        dst.append(ch)
    return "".join(src), "".join(dst)


_C1_SRC, _C1_DST = _cp1252_c1_table()


def read_orders_extract(
    spark: SparkSession, path: str, position_column: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Orders extract CSV in windows-1252. Spark's CSV reader does not accept
    that charset, so read ISO-8859-1 (identical outside 0x80-0x9F) and map
    the C1 range to the windows-1252 characters.

    A row's position is the column named, or else its place in the files
    (``FILE_POSITION`` columns; ``registry.positioned`` numbers them from 0).
    A segment column that the extract does not have is read as NULL.
    """
    needed = [c for c in schemas.ORDERS_EXTRACT_COLUMNS if c not in schemas.OPTIONAL_EXTRACT_COLUMNS]
    raw = _read_csv(spark, path, needed + ([position_column] if position_column else []), "ISO-8859-1", multi_line)
    columns = [
        F.translate(_typed(c, t), _C1_SRC, _C1_DST).alias(c) if c in raw.columns else F.lit(None).cast(t).alias(c)
        for c, t in schemas.ORDERS_EXTRACT_COLUMNS.items()
    ]
    if position_column:
        return raw.select(*columns, _typed(position_column, "long"))
    return with_file_position(raw).select(*columns, *FILE_POSITION)


@dataclass
class SourceChoice:
    df: DataFrame
    source: str
    errors: dict[str, str]


def choose_source(candidates: list[tuple[str, Callable[[], DataFrame] | None]]) -> SourceChoice:
    """First configured source that opens (its schema resolves); failures are
    kept in ``errors`` for the run report instead of being swallowed."""
    errors: dict[str, str] = {}
    for name, open_source in candidates:
        if open_source is None:
            continue
        try:
            df = open_source()
            df.schema  # resolve now: missing paths/tables fail here
            return SourceChoice(df, name, errors)
        except Exception as exc:  # noqa: BLE001 - reported to the caller
            errors[name] = f"{type(exc).__name__}: {exc}"
    raise RuntimeError(f"no source available: {errors or 'none configured'}")
