"""A warehouse version as tables of the session catalog.

Each version's tables are external tables of their own names, with statistics;
views of the plain names stand for the current version's. Publishing replaces
the views one after the other and then drops the tables of versions that are
gone, so a query that was planned before goes on reading its version.

Statistics: row counts and sizes of all tables, and column statistics (distinct
values, ranges, nulls) of the dimensions' columns and of the fact's keys, which
is what the cost-based optimizer needs to order joins. The fact is partitioned
by year and month; ``_fact_by_month`` has these columns, so a join with the
calendar on them prunes its partitions at run time.

Names that begin with an underscore are internal and not listed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions.numeric import sqlite_round
from lakestar.plans import gold, marts
from lakestar.session import concurrently

DATABASE = "lakestar"
BY_MONTH = "_fact_by_month"
_PARTITIONS = ["year", "month"]


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _table_of(name: str, version: str) -> str:
    return f"_{name}__{version.replace('-', '_')}".lower()


def publish(spark: SparkSession, version_path: str, database: str = DATABASE, fact_columns: bool = True) -> list[str]:
    """Register a published version's tables and switch the views to them; the views' names.

    Runs at once. ``fact_columns``: also collect the statistics of the fact's
    foreign keys, which takes a pass over these columns.
    """
    version = version_path.rstrip("/").rsplit("/", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    concurrently([lambda t=t: _register(spark, database, t, version_path, fact_columns) for t in schemas.GOLD_COLUMNS])
    for t, columns in schemas.GOLD_COLUMNS.items():
        listed = ", ".join(_quoted(c) for c in columns)
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, t)} AS SELECT {listed} FROM {_quoted(database, _table_of(t, version))}")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, BY_MONTH)} AS SELECT * FROM {_quoted(database, _table_of('fact_sales', version))}")
    _drop_gone(spark, database, version_path.rstrip("/").rsplit("/", 1)[0])
    return sorted(schemas.GOLD_COLUMNS)


def _register(spark: SparkSession, database: str, table: str, version_path: str, fact_columns: bool) -> None:
    version = version_path.rstrip("/").rsplit("/", 1)[-1]
    name = _quoted(database, _table_of(table, version))
    fact = table == "fact_sales"
    schema = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schemas.GOLD_SCHEMAS[table].fields)
    if fact:
        schema += "".join(f", {c} int" for c in _PARTITIONS)
    partitioned = f"PARTITIONED BY ({', '.join(_PARTITIONS)})" if fact else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {partitioned} LOCATION '{_text(f'{version_path}/{table}')}'")
    if fact:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    keys = [k for k, _ in schemas.FACT_FOREIGN_KEYS]
    if not fact:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    elif fact_columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(keys + _PARTITIONS)}")
    else:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def _drop_gone(spark: SparkSession, database: str, root: str) -> None:
    """Drop the tables of versions whose files are gone (external tables: only the entries go)."""
    for t in spark.catalog.listTables(database):
        found = re.fullmatch(r"_\w+?__(v\d+)_([0-9a-f]+)", t.name)
        if found and not gold.path_exists(spark, f"{root}/{found[1]}-{found[2]}"):
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, t.name)}")


def list_tables(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """(table_name, rows) of the current version's tables, as any session of
    the application sees them: names and row counts come from the catalog. A
    session's temporary views, which the catalog lists with every database, are none."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary and not t.name.startswith("_"))
    rows = [(n, _row_count(spark, database, n)) for n in names]
    return spark.createDataFrame(rows, "table_name string, rows long")


def _row_count(spark: SparkSession, database: str, view: str) -> int | None:
    """Row count in the statistics of the table behind a view."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, view)}").collect()}
    table = re.search(rf"`(_{view}__\w+)`", described["View Text"])
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, table[1])}").collect()}
    found = re.search(r"(\d+) rows", described.get("Statistics", ""))
    return int(found[1]) if found else None


def tables(spark: SparkSession, database: str = DATABASE) -> marts.Tables:
    """The current version's tables by way of the catalog, for the marts and the sandbox."""
    found = {t: spark.table(_quoted(database, t)) for t in schemas.GOLD_COLUMNS}
    by_month = spark.table(_quoted(database, BY_MONTH))
    return {**found, "_fact_by_month": by_month}


def trend_of_quarter(spark: SparkSession, quarter: int, database: str = DATABASE) -> DataFrame:
    """The monthly trend of one quarter of every year. Joined with the calendar
    on the fact's partition columns too: only the quarter's partitions are read."""
    t = tables(spark, database)
    days = t["dim_time"].where(F.col("quarter") == quarter).select("time_key", "year", "month")
    joined = t["_fact_by_month"].join(days, ["time_key", "year", "month"])
    rows = joined.groupBy("year", "month").agg(F.sum(marts.cents("total_revenue")).alias("revenue_c"), F.sum(marts.cents("total_profit")).alias("profit_c"), F.sum("quantity").alias("units"))
    return rows.orderBy(F.desc("year"), F.desc("month")).select(
        F.col("year").alias("Year"),
        F.col("month").alias("Month"),
        sqlite_round(marts.money("revenue_c")).alias("Monthly Revenue ($)"),
        sqlite_round(marts.money("profit_c")).alias("Monthly Profit ($)"),
        F.col("units").alias("Quantity Sold"),
    )
