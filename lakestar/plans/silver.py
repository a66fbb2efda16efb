"""Silver layer: cleaned dimensions and the conformed sales fact."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions.keys import stable_key
from lakestar.functions.numeric import half_even_round
from lakestar.functions.text import py_strip, title_case, txn_id
from lakestar.operators.dedup import first_per_key, keep_first
from lakestar.operators.lookup import broadcast_if_small, salted_join
from lakestar.operators.numbering import KEPT, PID, POS, ROW, estimated_bytes, key_ranges, run_offsets, stage_columns, target_partitions
from lakestar.session import work_dir
from lakestar.sources.readers import FILE_POSITION

# ---------------------------------------------------------------------------
# Fixed values of the conformance rules.
UNIT_COST_RATIO = 0.65
PROFIT_RATIO = 0.35
DEFAULT_QUANTITY = 1.0
DEFAULT_UNIT_PRICE = 25.0
DEFAULT_STORE_KEY = 1
NULL_PRODUCT_TEXT = "nan"
# ---------------------------------------------------------------------------


def dim_customers(customers: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Keep the first row per customer_id, strip/title names and countries,
    strip/lower e-mails."""
    first = keep_first(customers, ["customer_id"], order_cols or customers.columns)
    return first.select(
        F.col("customer_id").cast("long").alias("customer_key"),
        title_case(py_strip(F.col("customer_name"))).alias("customer_name"),
        F.lower(py_strip(F.col("email"))).alias("email"),
        title_case(py_strip(F.col("country"))).alias("country"),
        F.col("membership_tier"),
    )


def dim_products(products: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    first = keep_first(products, ["id"], order_cols or products.columns)
    return first.select(
        F.col("id").cast("long").alias("product_key"),
        py_strip(F.col("title")).alias("product_name"),
        title_case(py_strip(F.col("category"))).alias("category"),
        F.col("price").cast("double").alias("unit_price"),
        half_even_round(F.col("price").cast("double") * F.lit(UNIT_COST_RATIO)).alias("unit_cost"),
    )


def dim_stores(stores: DataFrame) -> DataFrame:
    """Rename and project only: store text is loaded as it comes."""
    return stores.select(F.col("store_id").cast("long").alias("store_key"), "store_name", "city", "state", "country")


@dataclass(frozen=True)
class DateRule:
    """How ledger dates are read: the first format that fits, else the ISO
    form of a date or timestamp. Text that is no date stops the build; with
    ``quarantine`` the row is set aside (no date, counted, its text kept)."""

    formats: tuple[str, ...] = ("M/d/yyyy",)
    quarantine: bool = False

    def parsed(self, text: Column) -> Column:
        """NULL for text that is no date."""
        return F.coalesce(F.expr("try_cast(`{}` as date)".format(_DATE_TEXT)), *[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in self.formats])

    def date(self, text: Column) -> Column:
        parsed = self.parsed(text)
        if self.quarantine:
            return parsed
        wrong = F.raise_error(F.concat(F.lit("ledger date cannot be read: "), text)).cast("date")
        return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(wrong)


_DATE_TEXT = "Date"


def ledger_dates(sales: DataFrame, dates: DateRule = DateRule()) -> DataFrame:
    """Parsed ledger date; NULL stays NULL."""
    return sales.select(dates.date(F.col(_DATE_TEXT)).alias("d"))


def dim_time_from_dates(dates: DataFrame) -> DataFrame:
    """Calendar rows for the distinct non-null dates (map-side de-duplicated)."""
    d = F.col("d")
    return (
        dates.where(d.isNotNull())
        .distinct()
        .select(
            F.date_format(d, "yyyy-MM-dd").alias("time_key"),
            F.dayofmonth(d).alias("day"),
            F.month(d).alias("month"),
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.date_format(d, "EEEE").alias("day_of_week"),
            (F.weekday(d) >= 5).alias("is_weekend"),
        )
    )


def dim_time(sales: DataFrame) -> DataFrame:
    return dim_time_from_dates(ledger_dates(sales))


def country_to_customer(dim_c: DataFrame) -> DataFrame:
    """country -> first customer_key (lowest key) of that country."""
    return first_per_key(dim_c.select("country", "customer_key"), "country", "customer_key")


def country_to_store(dim_s: DataFrame) -> DataFrame:
    """raw store country -> first store_key (lowest key)."""
    return first_per_key(dim_s.select("country", "store_key"), "country", "store_key")


@dataclass
class CountryLookups:
    """Customer and store of each country; ``small`` if both may be broadcast."""

    customers: DataFrame
    stores: DataFrame
    small: bool


def country_lookups(dim_c: DataFrame, dim_s: DataFrame) -> CountryLookups:
    """Both lookups hold one row per country; each is measured before it may be broadcast."""
    cust = country_to_customer(dim_c).withColumnRenamed("country", "_country")
    stores = country_to_store(dim_s).withColumnRenamed("country", "_country").withColumnRenamed("store_key", "_store")
    (cust, small_c), (stores, small_s) = broadcast_if_small(cust), broadcast_if_small(stores)
    return CountryLookups(cust, stores, small_c and small_s)


def conform_sales(
    sales: DataFrame,
    lookups: CountryLookups,
    n_products: int,
    order_cols: list[str],
    dates: DateRule = DateRule(),
) -> DataFrame:
    """Ledger rows with conformed keys and measures, before numbering/pruning.

    With small lookups this is row-level work and keeps partitions and order;
    else the lookups are salted shuffle joins. The product key is a row-level
    hash (no join at all).
    """
    country = title_case(py_strip(F.col("Country").cast("string")))
    quantity = F.coalesce(F.col("Order_Quantity"), F.lit(DEFAULT_QUANTITY)).cast("long")
    unit_price = F.coalesce(F.col("Unit_Price"), F.lit(DEFAULT_UNIT_PRICE)).cast("double")
    product = F.coalesce(F.col("Product").cast("string"), F.lit(NULL_PRODUCT_TEXT))
    # row-level work in projections of its own: fused with the joins it makes a
    # method that is too long for the JVM to compile
    base = sales.select(
        *order_cols,
        dates.date(F.col(_DATE_TEXT)).alias("_date"),
        F.col(_DATE_TEXT).alias("_date_text"),
        country.alias("_country"),
        stable_key(product, n_products).alias("product_key"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        half_even_round(quantity * unit_price).alias("total_revenue"),
        F.col("Order_Quantity").isNull().alias("_filled_qty"),
        F.col("Unit_Price").isNull().alias("_filled_price"),
    )
    joined = base
    for side in (lookups.customers, lookups.stores):
        joined = joined.join(side, "_country", "left") if lookups.small else salted_join(joined, side, ["_country"])
    return joined.select(
        *order_cols,
        "_date",
        F.when(F.col("_date").isNull(), F.col("_date_text")).alias("_bad_date"),
        F.col("customer_key"),
        "product_key",
        F.coalesce(F.col("_store"), F.lit(DEFAULT_STORE_KEY)).cast("long").alias("store_key"),
        F.date_format(F.col("_date"), "yyyy-MM-dd").alias("time_key"),
        "quantity",
        "unit_price",
        "total_revenue",
        half_even_round(F.col("total_revenue") * F.lit(PROFIT_RATIO)).alias("total_profit"),
        F.col("_store").isNull().alias("_default_store"),
        "_filled_qty",
        "_filled_price",
    )


def in_file_order(order_cols: list[str]) -> bool:
    return list(order_cols) == list(FILE_POSITION)


#: Bytes of a ledger from which on reading its first order column ahead saves more than the job costs.
KEY_RANGES_BYTES = 64 << 20


def staging_plan(
    sales: DataFrame,
    lookups: CountryLookups,
    n_products: int,
    order_cols: list[str],
    num_partitions: int | None = None,
    dates: DateRule = DateRule(),
) -> DataFrame:
    """The conformed ledger in order, before it is staged.

    In file order the scan's partitions are kept: no exchange of the ledger.
    Otherwise the raw columns are range-partitioned, and rows are conformed and
    sorted after the exchange, so that sampling and shuffling never pay for it. The partition count follows the size of the raw scan.
    A ledger of ``KEY_RANGES_BYTES`` or more is parted by its first order column alone where that does it evenly.
    """
    if num_partitions is None:
        num_partitions = target_partitions(sales)
    if not lookups.small:
        # the salted joins move the rows: order them afterwards
        rows = conform_sales(sales, lookups, n_products, order_cols, dates)
        return rows.repartitionByRange(num_partitions, *order_cols).sortWithinPartitions(*order_cols)
    if in_file_order(order_cols):
        return conform_sales(sales, lookups, n_products, order_cols, dates)
    # sorted last: the optimizer drops a sort below a join
    large = (estimated_bytes(sales) or 0) >= KEY_RANGES_BYTES
    to = key_ranges(sales, order_cols[0], num_partitions) if large else None
    sales = sales.repartitionByRange(num_partitions, *order_cols) if to is None else sales.repartitionById(num_partitions, to)
    return conform_sales(sales, lookups, n_products, order_cols, dates).sortWithinPartitions(*order_cols)


def stage_sales(
    sales: DataFrame,
    lookups: CountryLookups,
    n_products: int,
    order_cols: list[str],
    num_partitions: int | None = None,
    dates: DateRule = DateRule(),
    path: str | None = None,
) -> DataFrame:
    """Conform and order the ledger once and stage it as Parquet (``path``:
    default a new folder below the work folder), the rows that will be pruned
    apart from the others."""
    rows = staging_plan(sales, lookups, n_products, order_cols, num_partitions, dates)
    # the files that a row came from tell the order of runs only where the scan's partitions were kept
    rows = rows if in_file_order(order_cols) and lookups.small else rows.drop(*FILE_POSITION)
    return stage_columns(rows, keep_condition(), path or staging_path(sales.sparkSession))


def staging_path(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/staging/{uuid.uuid4().hex}"


def _run_columns(staged: DataFrame) -> list[str]:
    return list(FILE_POSITION)[:2] if "_src_file" in staged.columns else []


def ledger_summary(staged: DataFrame) -> DataFrame:
    """One pass over the staged ledger with GROUPING SETS ((run), (date)): per
    run (a staged partition, or a split of a file in it) the row count, kept
    rows, first position and the pruning/default counters, and the distinct
    ledger dates with their kept rows. Its size is runs + distinct dates,
    independent of the ledger's row count; it feeds the numbering offsets, the
    calendar and the run counters."""
    run = _run_columns(staged)
    rows = staged.select(
        PID,
        *run,
        F.col("_date").alias("d"),
        F.col(POS).alias("_pos"),
        *[
            c.alias(n)
            for n, c in {
                "_keep": F.col(KEPT),
                "_no_customer": F.col("customer_key").isNull(),
                "_no_date": F.col("time_key").isNull(),
                "_bad_date": F.col("_bad_date").isNotNull(),
                "_default_store": F.col("_default_store"),
                "_filled_qty": F.col("_filled_qty"),
                "_filled_price": F.col("_filled_price"),
            }.items()
        ],
    )
    return rows.groupingSets([[PID, *run], ["d"]], PID, *run, "d").agg(
        F.grouping(PID).alias("is_date"),
        F.count(F.lit(1)).alias("n"),
        F.min("_pos").alias("first"),
        F.count_if("_keep").alias("n_kept"),
        F.count_if("_no_customer").alias("no_customer"),
        F.count_if("_no_date").alias("no_date"),
        F.count_if("_bad_date").alias("quarantined"),
        F.count_if(~F.col("_keep")).alias("pruned_rows"),
        F.count_if("_default_store").alias("default_store"),
        F.count_if("_filled_qty").alias("filled_quantity"),
        F.count_if("_filled_price").alias("filled_price"),
    )


def summary_runs(summary: DataFrame) -> DataFrame:
    """Per-run rows of the ledger summary."""
    return summary.where(F.col("is_date") == 0).drop("d", "is_date")


def summary_dates(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("is_date") == 1).select("d")


def kept_months(summary: DataFrame) -> DataFrame:
    """Months of the dates that have kept rows."""
    kept = summary.where((F.col("is_date") == 1) & (F.col("n_kept") > 0))
    return kept.select(F.year("d").alias("year"), F.month("d").alias("month")).distinct()


SUMMARY_COUNTERS = ["no_customer", "no_date", "quarantined", "pruned_rows", "default_store", "filled_quantity", "filled_price"]


def keep_condition():
    return F.col("customer_key").isNotNull() & F.col("product_key").isNotNull() & F.col("time_key").isNotNull()


def numbered(staged: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Every staged ledger row with ``_txn``, its place in the ledger, and
    ``sales_key``, its place among the kept rows (NULL for others).

    Both come from the stored positions and the offsets in ``summary`` (a row
    for each run), which are joined by a broadcast of that size.
    """
    run = _run_columns(staged)
    runs = summary_runs(summary if summary is not None else ledger_summary(staged))
    offsets = run_offsets(runs, [PID, *run], run or [PID])
    rows = staged.join(F.broadcast(offsets), [PID, *run], "inner")
    return rows.withColumns({
        "_txn": F.col(POS) + F.col("__off_all") + F.lit(1),
        "sales_key": F.when(F.col(KEPT), F.col(ROW) + F.col("__off_kept") + F.lit(1)),
    }).drop(PID, POS, ROW, "__off_all", "__off_kept")


def number_sales(staged: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """transaction_id over every ledger row, sales_key 1..n over the rows that
    have a customer and a date; only these rows' files are read."""
    rows = numbered(staged, summary).where(F.col(KEPT))
    return rows.select(
        "sales_key",
        txn_id(F.col("_txn")).alias("transaction_id"),
        F.col("customer_key").cast("long").alias("customer_key"),
        F.col("product_key").cast("long").alias("product_key"),
        "store_key",
        "time_key",
        "quantity",
        "unit_price",
        "total_revenue",
        "total_profit",
    )


def grouped_by_month(fact: DataFrame, summary: DataFrame, parts: int) -> DataFrame:
    """The fact (with year and month) dealt to about ``parts`` partitions by
    month: a large month has several, small neighbours share one. The months'
    rows are known from the summary, so nothing is sampled; fetches a row for
    each month at once."""
    kept = summary.where((F.col("is_date") == 1) & (F.col("n_kept") > 0))
    months = kept.groupBy(F.year("d").alias("year"), F.month("d").alias("month")).agg(F.sum("n_kept").alias("n")).orderBy("year", "month").collect()
    each = max(1, -(-sum(r["n"] for r in months) // parts))
    places, at, filled = [], 0, 0
    for r in months:
        if filled and filled + r["n"] > each:
            at, filled = at + 1, 0
        cuts = -(-r["n"] // each)
        places.append((r["year"], r["month"], at, cuts))
        if cuts > 1:
            at += cuts
        else:
            filled += r["n"]
    placed = fact.sparkSession.createDataFrame(places, "year int, month int, __first int, __cuts int")
    to = F.col("__first") + F.pmod(F.xxhash64("sales_key"), F.col("__cuts")).cast("int")
    dealt = fact.join(F.broadcast(placed), ["year", "month"]).withColumn("__to", to).repartitionById(at + 1, "__to")
    return dealt.drop("__first", "__cuts", "__to").sortWithinPartitions("year", "month", "sales_key")


def fact_columns() -> list[str]:
    return list(schemas.FACT_SALES)
