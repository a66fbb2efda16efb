"""End-to-end build: landing files -> bronze -> gold -> marts.

``build`` is the production entry point (bronze DataFrames in, a switched
warehouse version out). ``testdata_warehouse`` prepares the landing zone from
the driver's tables once per application and scale directory, builds once, and
hands out DataFrames over the written gold tables, so many registered queries
share one build.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.functions.text import period_label
from lakestar.operators.numbering import target_partitions
from lakestar.plans import gold, marts, published, silver
from lakestar.session import work_dir
from lakestar.sources import readers, testmap

_LOCK = threading.RLock()
_CACHE: dict[tuple[str, str], "BuiltWarehouse"] = {}
_LANDINGS: dict[tuple[str, str], dict[str, str]] = {}


@dataclass
class BuiltWarehouse:
    landing: dict[str, str]
    root: str
    version_path: str
    counts: dict[str, int]
    build_seconds: float
    staged: DataFrame | None = None
    summary: DataFrame | None = None
    _opened: dict = field(default_factory=dict)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The version's tables, opened once per application: a version is
        immutable, so the file listing is reused across queries."""
        app = spark.sparkContext.applicationId
        if self._opened.get("app") != app:
            self._opened |= {"app": app, "tables": gold.open_tables(spark, self.version_path)}
        return dict(self._opened["tables"])

    def stage_counts(self, spark: SparkSession) -> DataFrame:
        return gold.read_stage_counts(spark, self.version_path)


def bronze_from_landing(spark: SparkSession, landing: dict[str, str]) -> gold.Bronze:
    return gold.Bronze(
        customers=readers.read_registry(spark, landing["registry/customers"], "customers", testmap.SOURCE_ORDER),
        stores=readers.read_registry(spark, landing["registry/stores"], "stores"),
        products=readers.read_catalogue(spark, landing["catalogue"], order_columns=testmap.SOURCE_ORDER),
        sales=readers.read_ledger(spark, landing["ledger"], testmap.LEDGER_ORDER),
        order_cols=list(testmap.LEDGER_ORDER),
        customer_order=list(testmap.SOURCE_ORDER),
        product_order=list(testmap.SOURCE_ORDER),
    )


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"))


def register_build(
    spark: SparkSession, sf_dir: str, landing: dict[str, str], root: str, result: gold.BuildResult
) -> BuiltWarehouse:
    """Make an externally run build the one the registered queries use."""
    wh = BuiltWarehouse(
        landing, root, result.version_path, result.counts, result.seconds, result.staged, result.summary
    )
    with _LOCK:
        _CACHE[_key(spark, sf_dir)] = wh
    return wh


def _base(spark: SparkSession, sf_dir: str) -> str:
    return f"{work_dir(spark)}/{_key(spark, sf_dir)[1].strip('/').replace('/', '_').replace('.', '_')}"


def landing_for(spark: SparkSession, sf_dir: str, parts: Sequence[str] = testmap.LANDING_PARTS) -> dict[str, str]:
    """The landing zone with these parts at least, each written once per application; what reads the
    sources alone needs no build."""
    key = _key(spark, sf_dir)
    with _LOCK:
        if key in _CACHE:
            return _CACHE[key].landing
        landing = _LANDINGS.setdefault(key, {})
        absent = [part for part in parts if part not in landing]
        if absent:
            landing.update(testmap.write_landing(spark, sf_dir, f"{_base(spark, sf_dir)}/landing", absent))
        return landing


def product_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the product dimension: as the build counted them if it ran, else counted from the source."""
    key = _key(spark, sf_dir)
    with _LOCK:
        if key in _CACHE:
            return _CACHE[key].counts["dim_products"]
    bronze = bronze_from_landing(spark, landing_for(spark, sf_dir))
    return silver.dim_products(bronze.products, bronze.product_order).count()


def testdata_warehouse(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> BuiltWarehouse:
    key = _key(spark, sf_dir)
    with _LOCK:
        if key in _CACHE and not rebuild:
            return _CACHE[key]
        base, landing = _base(spark, sf_dir), landing_for(spark, sf_dir)
        result = gold.build(spark, bronze_from_landing(spark, landing), f"{base}/warehouse")
        wh = BuiltWarehouse(
            landing, f"{base}/warehouse", result.version_path, result.counts, result.seconds, result.staged, result.summary
        )
        _CACHE[key] = wh
        return wh


@dataclass
class SecondWarehouse:
    """A warehouse that was asked for twice, and built the first time."""

    version_path: str
    calls: list[tuple[int, bool, bool, int]]  # call, whether it existed before, whether the version is that of the first call, rows of the fact


_SECOND: dict[tuple[str, str], SecondWarehouse] = {}


Place = str | Callable[[], str]


def chosen_bronze(spark: SparkSession, places: dict[str, list[tuple[str, Place]]]) -> gold.Bronze:
    """Sources from the first of their (name, path) places that opens; unreadable dates are set aside.

    A path may be a function that prepares the place, called when the places before it have failed.
    The build keeps with its version which places were read and which failed.
    """
    order = testmap.SOURCE_ORDER
    openers = {
        "customers": lambda p: readers.read_registry(spark, p, "customers", order),
        "stores": lambda p: readers.read_registry(spark, p, "stores"),
        "products": lambda p: readers.read_catalogue(spark, p, multi_line=True, order_columns=order),
        "ledger": lambda p: readers.read_ledger(spark, p, testmap.LEDGER_ORDER),
    }
    chosen, uses = {}, []
    for table, opened in openers.items():
        choice = readers.choose_source([(name, lambda p=path: opened(p() if callable(p) else p)) for name, path in places[table]])
        chosen[table] = choice.df
        uses += [gold.SourceUse(table, name, error) for name, error in choice.errors.items()]
        uses.append(gold.SourceUse(table, choice.source))
    return gold.Bronze(
        customers=chosen["customers"],
        stores=chosen["stores"],
        products=chosen["products"],
        sales=chosen["ledger"],
        order_cols=list(testmap.LEDGER_ORDER),
        customer_order=list(order),
        product_order=list(order),
        dates=silver.DateRule(quarantine=True),
        sources=uses,
    )


def second_warehouse(spark: SparkSession, sf_dir: str) -> SecondWarehouse:
    """A warehouse over the second landing, asked for twice: the catalogue comes as arrays, some
    dates can't be read, and the first places of the registry and of the catalogue don't exist."""
    key = _key(spark, sf_dir)
    with _LOCK:
        if key in _SECOND:
            return _SECOND[key]
        landing = landing_for(spark, sf_dir, ["registry/customers", "registry/stores"])
        base = f"{_base(spark, sf_dir)}/second"
        own = testmap.write_second_landing(spark, sf_dir, f"{base}/landing")
        places = {
            "customers": [("remote", f"{base}/unreachable/customers"), ("local", landing["registry/customers"])],
            "stores": [("remote", f"{base}/unreachable/stores"), ("local", landing["registry/stores"])],
            "products": [("remote", f"{base}/unreachable/products"), ("mirror", f"{base}/unreachable/mirror"), ("local", own["catalogue"])],
            # the first landing's ledger is as large as the second's: written if it is turned to
            "ledger": [("remote", own["ledger"]), ("local", lambda: landing_for(spark, sf_dir, ["ledger"])["ledger"])],
        }
        calls, first = [], None
        for n in (1, 2):
            existed = gold.warehouse_exists(spark, f"{base}/warehouse")
            version = gold.ensure_warehouse(spark, f"{base}/warehouse", lambda: chosen_bronze(spark, places))
            first = first or version
            calls.append((n, existed, version == first, gold.open_tables(spark, version)["fact_sales"].count()))
        _SECOND[key] = SecondWarehouse(first, calls)
        return _SECOND[key]


def published_database(spark: SparkSession, sf_dir: str) -> str:
    """The database that shows the warehouse of the registered queries; published once per version."""
    wh = testdata_warehouse(spark, sf_dir)
    database = "lakestar_" + _key(spark, sf_dir)[1].strip("/").replace("/", "_").replace(".", "_").replace("-", "_").replace(":", "_")
    with _LOCK:
        if wh._opened.get("database") != (spark.sparkContext.applicationId, database):
            published.publish(spark, wh.version_path, database)
            wh._opened["database"] = (spark.sparkContext.applicationId, database)
    return database


def all_reports(tables: dict[str, DataFrame]) -> DataFrame:
    """The report set as one long table: (report, item, metric, value), a row for each figure.

    ``item`` names what the figure is of: category, customer, month or country."""
    frames = []
    for name, df in run_all_reports(tables).items():
        labels = [c for c, t in df.dtypes if t == "string"] or ["Year", "Month"]
        item = period_label(F.col("Year"), F.col("Month")) if labels == ["Year", "Month"] else F.col(f"`{labels[0]}`")
        figures = [c for c in df.columns if c not in labels]
        pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in figures)
        rows = df.withColumn("item", item).selectExpr("item", f"stack({len(figures)}, {pairs}) as (metric, value)")
        frames.append(rows.select(F.lit(name).alias("report"), "item", "metric", "value"))
    return reduce(DataFrame.unionByName, frames)


def run_all_reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The console report set: categories, top 5 customers, first 10 months of
    the trend, countries. The fact is read once: one pass with a grouping set
    for each key, checkpointed, serves all reports."""
    once = {**tables, "fact_sales": marts.summed_fact(tables)}
    return {
        "sales_by_category": marts.sales_by_category(once),
        "top_customers": marts.top_customers(once, 5),
        "recent_months": marts.monthly_sales_trend(once).limit(10),
        "revenue_by_country": marts.revenue_by_country(once),
    }


def rebuild_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh idempotence: build again from the same landing files with
    another partition count (that of the first build, doubled and one more) and
    compare every gold table with the current version by row count and by the
    sum of its row hashes, so that only one row per task is exchanged."""
    wh = testdata_warehouse(spark, sf_dir)
    bronze = bronze_from_landing(spark, wh.landing)
    again = gold.build(spark, bronze, f"{wh.root}-rebuild", num_partitions=2 * target_partitions(bronze.sales) + 1)
    first, second = wh.tables(spark), gold.open_tables(spark, again.version_path)
    frames = []
    for name in marts.list_tables(first):
        columns = first[name].columns

        def digest(df: DataFrame, tag: str) -> DataFrame:
            # two independent hashes; sums are free of order, and exact
            hashes = (F.xxhash64(*columns), F.hash(*columns).cast("long"))
            return df.agg(F.count(F.lit(1)).alias(f"n_{tag}"), *[F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).alias(f"h{i}_{tag}") for i, h in enumerate(hashes)])

        both = digest(first[name], "a").withColumn("k", F.lit(1)).join(digest(second[name].select(*columns), "b").withColumn("k", F.lit(1)), "k")  # a row each
        same = (F.col("n_a") == F.col("n_b")) & (F.col("h0_a") == F.col("h0_b")) & (F.col("h1_a") == F.col("h1_b"))
        frames.append(both.select(F.lit(name).alias("table_name"), F.col("n_a").alias("rows"), same.alias("identical")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def ledger_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame | None]:
    """The staged ledger and its summary: those of the build if it ran in this
    session, else staged once per application."""
    key = _key(spark, sf_dir)
    with _LOCK:
        wh = testdata_warehouse(spark, sf_dir)
        if wh.staged is None:
            t, bronze = wh.tables(spark), bronze_from_landing(spark, wh.landing)
            lookups = silver.country_lookups(t["dim_customers"], t["dim_stores"])
            wh.staged = silver.stage_sales(bronze.sales, lookups, max(wh.counts["dim_products"], 1), bronze.order_cols)
            wh.summary = None
        _CACHE[key] = wh
        return wh.staged, wh.summary


def numbered_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conformed ledger row (pruned ones included) with its transaction
    sequence ``_txn``."""
    return silver.numbered(*ledger_state(spark, sf_dir))
