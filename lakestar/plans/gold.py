"""Gold build: bronze -> silver -> star schema, written as a new version and
switched in only after the constraint checks pass (full refresh, as the
modelled warehouse drops and recreates its tables on every run)."""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lakestar import schemas
from lakestar.operators import quality
from lakestar.operators.numbering import target_partitions
from lakestar.plans import lease, marts, silver
from lakestar.session import checkpoint_dir, concurrently, shuffles_deleted

CURRENT_POINTER = "_CURRENT"
STAGE_COUNTS = "_stage_counts"
SOURCES = "_sources"


@dataclass(frozen=True)
class SourceUse:
    """A source that was read, or that was tried and failed (``error``)."""

    table: str
    source: str
    error: str | None = None


@dataclass
class Bronze:
    """Source tables. The order columns give the rows of a source their order:
    they number the ledger and decide which of several rows of a key is first
    (without any, the smallest row is)."""

    customers: DataFrame
    stores: DataFrame
    products: DataFrame
    sales: DataFrame
    order_cols: list[str]
    customer_order: list[str] | None = None
    product_order: list[str] | None = None
    dates: silver.DateRule = silver.DateRule()
    sources: list[SourceUse] = field(default_factory=list)


@dataclass
class BuildResult:
    version_path: str
    counts: dict[str, int] = field(default_factory=dict)
    seconds: float = 0.0
    timings: dict[str, float] = field(default_factory=dict)
    # staged ledger and its summary, reusable in this session, and the folder of the former
    staged: DataFrame | None = None
    summary: DataFrame | None = None
    staging: str | None = None


def _observed_write(df: DataFrame, path: str, name: str, metrics: list, partition_by: list[str] | None = None) -> dict:
    obs = Observation(name)
    df.observe(obs, *metrics).write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return obs.get


#: Versions that a build leaves in the warehouse, the new one included.
KEEP_VERSIONS = 3
LOCK = "_BUILDING"
#: Marks a version that was switched to; without it a version is a failed build's.
PUBLISHED = "_PUBLISHED"
MONTHS = "_months"
HEAD = "_head"
QUARANTINE = "_quarantine"


def build(
    spark: SparkSession,
    bronze: Bronze,
    warehouse_root: str,
    num_partitions: int | None = None,
    keep_versions: int = KEEP_VERSIONS,
    lease_seconds: float = lease.LEASE_SECONDS,
) -> BuildResult:
    """Write a new version, check it, and switch to it. One build at a time
    works on a warehouse (``lease``); a failed version is deleted at once, and
    so are published versions beyond ``keep_versions``."""
    root = warehouse_root.rstrip("/")
    with lease.held(spark, f"{root}/{LOCK}", lease_seconds) as lock:
        out = f"{root}/v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        try:
            with shuffles_deleted(spark):
                result = _build(spark, bronze, out, num_partitions)
            lock.check()
            write_small_file(spark, f"{out}/{PUBLISHED}", "\n")
        except BaseException:
            delete_path(spark, out)
            raise
        # switch: readers resolve the current version through this pointer
        write_small_file(spark, f"{root}/{CURRENT_POINTER}", out.rsplit("/", 1)[-1] + "\n")
        remove_old_versions(spark, root, keep_versions)
    return result


def _build(spark: SparkSession, bronze: Bronze, out: str, num_partitions: int | None) -> BuildResult:
    t0 = time.time()
    counts: dict[str, int] = {}
    timings: dict[str, float] = {}
    one = F.count(F.lit(1))

    # dimensions: small, written first (as concurrent jobs) so the fact reads
    # them back from disk. Output counts are observed in the write's result
    # stage (exactly once even when tasks are retried); bronze inputs are
    # counted by their own small jobs, since an observation below the
    # keep-first shuffle would sit in a map stage that a lost executor can
    # make Spark recompute.
    def write_dim(name, df):
        m = _observed_write(df, f"{out}/dim_{name}", f"dim_{name}", [one.alias("n")])
        return {f"dim_{name}": m["n"]}

    def count_bronze(name, src):
        return {f"bronze_{name}": src.count()}

    for part in concurrently([
        lambda: write_dim("customers", silver.dim_customers(bronze.customers, bronze.customer_order)),
        lambda: write_dim("products", silver.dim_products(bronze.products, bronze.product_order)),
        lambda: write_dim("stores", silver.dim_stores(bronze.stores)),
        lambda: count_bronze("customers", bronze.customers),
        lambda: count_bronze("products", bronze.products),
        lambda: count_bronze("stores", bronze.stores),
    ]):
        counts.update(part)

    timings["dims"] = time.time() - t0
    dim_c = spark.read.parquet(f"{out}/dim_customers")
    dim_s = spark.read.parquet(f"{out}/dim_stores")
    n_products = max(counts["dim_products"], 1)

    lookups = silver.country_lookups(dim_c, dim_s)
    staging = silver.staging_path(spark)
    staged = silver.stage_sales(bronze.sales, lookups, n_products, bronze.order_cols, num_partitions, bronze.dates, staging)
    timings["stage_ledger"] = time.time() - t0

    # one small summary pass over the staged ledger feeds the calendar (every
    # ledger date, pruned rows included), the numbering offsets and counters
    summary = silver.ledger_summary(staged).checkpoint(eager=True)
    totals = silver.summary_runs(summary).agg(
        F.sum("n").alias("ledger_rows"), *[F.sum(c).alias(c) for c in silver.SUMMARY_COUNTERS]
    ).first()  # one row
    counts["bronze_ledger"] = int(totals["ledger_rows"] or 0)
    for k in silver.SUMMARY_COUNTERS:
        counts[k] = int(totals[k] or 0)
    timings["summary"] = time.time() - t0

    # one file group per month: reports on the latest months read only theirs.
    # This is one more exchange of the fact.
    day = F.to_date("time_key")
    fact = silver.number_sales(staged, summary).withColumns({"year": F.year(day), "month": F.month(day)})
    fact_parts = num_partitions or target_partitions(bronze.sales)
    by_month = silver.grouped_by_month(fact, summary, fact_parts)
    fact_metrics = [
        one.alias("n"),
        F.min("sales_key").alias("min_key"),
        F.max("sales_key").alias("max_key"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in schemas.FACT_SALES],
    ]
    dates = silver.summary_dates(summary)
    jobs = [
        lambda: _observed_write(silver.dim_time_from_dates(dates), f"{out}/dim_time", "dim_time", [one.alias("n")]),
        lambda: _observed_write(by_month, f"{out}/fact_sales", "fact_sales", fact_metrics, ["year", "month"]),
        lambda: silver.kept_months(summary).write.mode("overwrite").parquet(f"{out}/{MONTHS}"),
    ]
    if bronze.dates.quarantine:
        aside = silver.numbered(staged, summary).where(F.col("_bad_date").isNotNull())
        aside = aside.select(F.col("_txn").alias("ledger_row"), F.col("_bad_date").alias("date_text"), "product_key", "quantity", "unit_price")
        jobs.append(lambda: aside.write.mode("overwrite").parquet(f"{out}/{QUARANTINE}"))
    tm, fm, *_ = concurrently(jobs)
    # the first rows are looked at most often: found by file statistics once, here
    first = spark.read.schema(schemas.GOLD_SCHEMAS["fact_sales"]).parquet(f"{out}/fact_sales").where(F.col("sales_key") <= marts.HEAD_ROWS)
    first.coalesce(1).sortWithinPartitions("sales_key").write.mode("overwrite").parquet(f"{out}/{HEAD}")
    counts["dim_time"] = tm["n"]
    counts["fact_sales"] = fm["n"]
    timings["fact_sales"] = time.time() - t0

    _check_version(spark, out, fm, counts)
    timings["checks"] = time.time() - t0

    for use in bronze.sources:
        if use.error is None:
            counts[f"source_{use.table}_{use.source}"] = counts[f"bronze_{use.table}"]
        else:
            counts[f"failed_{use.table}_{use.source}"] = 0
    uses = "".join(json.dumps({"table_name": u.table, "source": u.source, "used": u.error is None, "error": u.error}) + "\n" for u in bronze.sources)
    write_small_file(spark, f"{out}/{SOURCES}/part-0.json", uses)
    lines = "".join(json.dumps({"stage": k, "rows": v}) + "\n" for k, v in sorted(counts.items()))
    write_small_file(spark, f"{out}/{STAGE_COUNTS}/part-0.json", lines)
    return BuildResult(out, counts, time.time() - t0, timings, staged, summary, staging)


def _check_version(spark: SparkSession, out: str, fact_metrics: dict, counts: dict[str, int]) -> None:
    """Keys, nulls and references of a written version; raises on the first that is broken."""
    opened = open_tables(spark, out)
    tables = {t: opened[t] for t in schemas.GOLD_COLUMNS if t != "fact_sales"}
    fact = opened["fact_sales"]
    # the fact's keys are dense 1..n by construction: their range is observed
    # by the write, their uniqueness is counted in bitmaps
    n = fact_metrics["n"]
    if n and (fact_metrics["min_key"] != 1 or fact_metrics["max_key"] != n):
        raise ValueError(f"fact_sales keys are not 1..{n}: {fact_metrics}")
    nulls = {k: v for k, v in fact_metrics.items() if k.startswith("null_") and v}
    if nulls:
        raise ValueError(f"fact_sales NOT NULL violated: {nulls}")
    reports = [
        (quality.key_violations([(t, df, schemas.GOLD_KEYS[t]) for t, df in tables.items()]),
         ["duplicate_keys"], "primary key"),
        (quality.dense_key_surplus(fact, schemas.GOLD_KEYS["fact_sales"]), ["surplus_rows", "missing_keys"], "fact_sales primary key"),
        (quality.null_violations([(t, df, schemas.GOLD_COLUMNS[t]) for t, df in tables.items()]),
         ["null_rows"], "NOT NULL"),
        (quality.fk_violations(
            fact, [(fk, tables[dim], dim) for fk, dim in schemas.FACT_FOREIGN_KEYS],
            known_rows={t: counts[t] for t in tables if t in counts},
        ), ["orphan_rows"], "foreign key"),
    ]
    concurrently([(lambda r=r: quality.assert_clean(*r)) for r in reports])


def remove_old_versions(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all but the newest ``keep`` published versions, and what builds
    that died left unpublished; the current version stays in any case. For the
    holder of the build lock only: a version being written is not published."""
    folder, fs = _fs_path(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
    names = sorted((n for n in names if re.fullmatch(r"v\d+-[0-9a-f]+", n)), key=lambda n: int(n[1:].split("-")[0]))
    current = read_small_file(spark, f"{root}/{CURRENT_POINTER}").strip()
    published = [n for n in names if n == current or path_exists(spark, f"{root}/{n}/{PUBLISHED}")]
    stay = {*published[-max(1, keep) :], current}
    old = [n for n in names if n not in stay]
    for name in old:
        delete_path(spark, f"{root}/{name}")
    return old


def staging_folders(spark: SparkSession) -> set[str]:
    """Folders of the checkpoints that this application has written so far."""
    folder, fs = _fs_path(spark, checkpoint_dir(spark))
    return {f.getPath().toString() for f in fs.listStatus(folder) if f.getPath().getName().startswith("rdd-")}


def delete_path(spark: SparkSession, path: str) -> None:
    target, fs = _fs_path(spark, path)
    fs.delete(target, True)


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small metadata file: written under a temporary name, then
    moved over the target in one overwriting rename, so that readers see the
    old or the new content at any time. Stores without such a rename get one
    overwriting create, which they make visible as a whole when it is closed."""
    target, fs = _fs_path(spark, path)
    tmp, _ = _fs_path(spark, f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def put(at, overwrite):
        stream = fs.create(at, overwrite)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    except Py4JJavaError:  # no such interface for this store
        put(target, True)
        return
    put(tmp, True)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(fs.makeQualified(tmp), fs.makeQualified(target), how)


def read_small_file(spark: SparkSession, path: str) -> str:
    target, fs = _fs_path(spark, path)
    stream = fs.open(target)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        return reader.readLine() or ""
    finally:
        stream.close()


def current_version_path(spark: SparkSession, warehouse_root: str) -> str:
    root = warehouse_root.rstrip("/")
    return f"{root}/{read_small_file(spark, f'{root}/{CURRENT_POINTER}').strip()}"


def read_stage_counts(spark: SparkSession, version_path: str) -> DataFrame:
    return spark.read.schema("stage string, rows long").json(f"{version_path}/{STAGE_COUNTS}")


def read_sources(spark: SparkSession, version_path: str) -> DataFrame:
    """The sources that a version's build read, and those that it tried in vain."""
    return spark.read.schema("table_name string, source string, used boolean, error string").json(f"{version_path}/{SOURCES}")


def read_quarantine(spark: SparkSession, version_path: str) -> DataFrame:
    """The ledger rows that a version's build set aside, with the text of their date."""
    schema = "ledger_row long, date_text string, product_key long, quantity long, unit_price double"
    return spark.read.schema(schema).parquet(f"{version_path}/{QUARANTINE}")


def open_tables(spark: SparkSession, version_path: str) -> dict[str, DataFrame]:
    """Gold tables of one version, with their fixed schemas (no footer-based
    schema inference). ``_fact_by_month`` is the fact with its partition
    columns, ``_months`` the months that have sales, ``_head`` the fact's first
    rows by key."""
    opened = {
        t: spark.read.schema(schemas.GOLD_SCHEMAS[t]).parquet(f"{version_path}/{t}")
        for t in schemas.GOLD_COLUMNS
        if t != "fact_sales"
    }
    by_month = StructType([*schemas.GOLD_SCHEMAS["fact_sales"].fields, StructField("year", IntegerType()), StructField("month", IntegerType())])
    opened["_fact_by_month"] = spark.read.schema(by_month).parquet(f"{version_path}/fact_sales")
    opened["_months"] = spark.read.schema("year int, month int").parquet(f"{version_path}/{MONTHS}")
    opened["_head"] = spark.read.schema(schemas.GOLD_SCHEMAS["fact_sales"]).parquet(f"{version_path}/{HEAD}")
    opened["fact_sales"] = opened["_fact_by_month"].drop("year", "month")
    return opened


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _fs_path(spark, path)
    return bool(fs.exists(target))


def warehouse_exists(spark: SparkSession, warehouse_root: str) -> bool:
    return path_exists(spark, f"{warehouse_root.rstrip('/')}/{CURRENT_POINTER}")


def ensure_warehouse(spark: SparkSession, warehouse_root: str, bronze_factory) -> str:
    """Current version path; builds one first when the warehouse has none. Nothing reads that build's staged ledger again."""
    if not warehouse_exists(spark, warehouse_root):
        delete_path(spark, build(spark, bronze_factory(), warehouse_root).staging)
    return current_version_path(spark, warehouse_root)
