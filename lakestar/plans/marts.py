"""Marts over the gold star schema.

Plan shape shared by every mart: aggregate the fact on the dimension key
first (partial + final hash aggregate, so a hot key costs one row per task),
then join that aggregate - at most one row per dimension key - to the
dimension and re-aggregate on the reported attribute. The fact itself is
never shuffled or joined row by row, whatever the size of the dimension.

Money columns are cent-rounded by the build, so their sums are taken over
integer cents: exact, independent of partitioning and cheaper than decimal
sums. Reported figures are rounded like SQLite ``ROUND``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions.numeric import safe_ratio, sqlite_round
from lakestar.functions.text import period_label
from lakestar.session import checkpoint_dir

Tables = dict[str, DataFrame]


def cents(col: str) -> Column:
    return F.rint(F.col(col) * F.lit(100.0)).cast("long")


def money(col: str) -> Column:
    """Exact cents back to a double amount."""
    return F.col(col) / F.lit(100.0)


#: Rows by key that a version keeps as its head table.
HEAD_ROWS = 1000

_MEASURES = {
    "orders": lambda: F.count("sales_key"),
    "revenue_rows": lambda: F.count("total_revenue"),
    "units": lambda: F.sum("quantity"),
    "revenue_c": lambda: F.sum(cents("total_revenue")),
    "profit_c": lambda: F.sum(cents("total_profit")),
}
_REPORT_KEYS = ["product_key", "customer_key", "time_key"]


def summed_fact(tables: Tables) -> DataFrame:
    """The fact reduced to a row for each value of each report key, in one
    pass; ``_fact_by`` reads it like the fact."""
    fact = tables["fact_sales"]
    checkpoint_dir(fact.sparkSession)
    summed = fact.groupingSets([[k] for k in _REPORT_KEYS], *_REPORT_KEYS).agg(
        *[F.grouping(k).alias(f"_no_{k}") for k in _REPORT_KEYS], *[m().alias(n) for n, m in _MEASURES.items()]
    )
    return summed.checkpoint(eager=True)


def _fact_by(tables: Tables, key: str) -> DataFrame:
    fact = tables["fact_sales"]
    if f"_no_{key}" in fact.columns:
        return fact.where(F.col(f"_no_{key}") == 0).select(key, *_MEASURES)
    return fact.groupBy(key).agg(*[m().alias(n) for n, m in _MEASURES.items()])


_SUMS = ["orders", "revenue_rows", "units", "revenue_c", "profit_c"]


def _rollup(joined: DataFrame, *group: str) -> DataFrame:
    return joined.groupBy(*group).agg(*[F.sum(c).alias(c) for c in _SUMS])


def _by_category(tables: Tables) -> DataFrame:
    p = tables["dim_products"].select("product_key", "category")
    return _rollup(_fact_by(tables, "product_key").join(p, "product_key"), "category")


def _by_customer(tables: Tables) -> DataFrame:
    c = tables["dim_customers"].select("customer_key", "customer_name", "country", "membership_tier")
    return _fact_by(tables, "customer_key").join(c, "customer_key")


def _by_month(tables: Tables) -> DataFrame:
    t = tables["dim_time"].select("time_key", "year", "month")
    return _rollup(_fact_by(tables, "time_key").join(t, "time_key"), "year", "month")


def latest_months(tables: Tables, n: int) -> DataFrame:
    """The fact's rows of its ``n`` latest months with sales. The months (at
    most ``n`` rows) become literals, so that only their partitions are read."""
    months = tables["_months"].orderBy(F.desc("year"), F.desc("month")).limit(n).collect()
    wanted = F.lit(False)
    for r in months:
        wanted = wanted | ((F.col("year") == r["year"]) & (F.col("month") == r["month"]))
    return tables["_fact_by_month"].where(wanted).drop("year", "month")


def head_of_fact(tables: Tables, n: int) -> DataFrame:
    """The fact's first ``n`` rows by key (keys are 1..n). A version keeps its
    first rows as a table of their own, so that the fact's files stay closed;
    beyond that table, and without it, file statistics prune the fact."""
    head = tables.get("_head")
    rows = head if head is not None and n <= HEAD_ROWS else tables["fact_sales"]
    return rows.where(F.col("sales_key") <= n)


def sales_by_category(tables: Tables) -> DataFrame:
    g = _by_category(tables)
    return g.orderBy(F.desc("revenue_c")).select(
        F.col("category").alias("Product Category"),
        F.col("orders").alias("Total Orders"),
        F.col("units").alias("Total Units Sold"),
        sqlite_round(money("revenue_c")).alias("Total Revenue ($)"),
        sqlite_round(money("profit_c")).alias("Total Profit ($)"),
        sqlite_round(safe_ratio(F.col("profit_c").cast("double"), F.col("revenue_c").cast("double")) * F.lit(100.0)).alias(
            "Profit Margin (%)"
        ),
    )


def top_customers(tables: Tables, limit: int = 5) -> DataFrame:
    g = _by_customer(tables)
    return g.orderBy(F.desc("revenue_c"), F.asc("customer_key")).limit(limit).select(
        F.col("customer_name").alias("Customer Name"),
        F.col("country").alias("Country"),
        F.col("membership_tier").alias("Loyalty Tier"),
        F.col("orders").alias("Transaction Count"),
        sqlite_round(money("revenue_c")).alias("Total Spent ($)"),
    )


def monthly_sales_trend(tables: Tables) -> DataFrame:
    g = _by_month(tables)
    return g.orderBy(F.desc("year"), F.desc("month")).select(
        F.col("year").alias("Year"),
        F.col("month").alias("Month"),
        sqlite_round(money("revenue_c")).alias("Monthly Revenue ($)"),
        sqlite_round(money("profit_c")).alias("Monthly Profit ($)"),
        F.col("units").alias("Quantity Sold"),
    )


def recent_months(tables: Tables, n: int = 10) -> DataFrame:
    """First rows of the trend (latest months first), as the console report."""
    return monthly_sales_trend({**tables, "fact_sales": latest_months(tables, n)})


def revenue_by_country(tables: Tables) -> DataFrame:
    per_customer = _by_customer(tables)
    g = per_customer.groupBy("country").agg(
        # customer_key is the dimension's primary key (checked at build), so
        # one row per customer here: a count is the distinct count
        F.count("customer_key").alias("customers"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )
    return g.orderBy(F.desc("revenue_c")).select(
        F.col("country").alias("Country"),
        F.col("customers").alias("Active Customers"),
        F.col("orders").alias("Total Orders"),
        sqlite_round(money("revenue_c")).alias("Total Revenue ($)"),
        sqlite_round(safe_ratio(money("revenue_c"), F.col("revenue_rows").cast("double"))).alias("Avg Order Value ($)"),
    )


def product_units_sold(tables: Tables) -> DataFrame:
    """Every product with its units sold (NULL when never sold); the fact is
    reduced to one row per product before the outer join."""
    sold = tables["fact_sales"].groupBy("product_key").agg(F.sum("quantity").alias("units"))
    p = tables["dim_products"]
    return p.join(sold, "product_key", "left").orderBy(F.desc_nulls_last("units"), F.asc("product_key")).select(
        F.col("product_key").alias("Product Key"),
        F.col("product_name").alias("Product Name"),
        F.col("category").alias("Category"),
        F.col("unit_price").alias("Unit Price ($)"),
        F.col("units").alias("Historical Units Sold"),
    )


def kpi_totals(tables: Tables) -> DataFrame:
    """Dashboard totals, summed over the already rounded category rows."""
    cat = sales_by_category(tables)
    t = cat.agg(
        F.sum(cents("Total Revenue ($)")).alias("rev_c"),
        F.sum(cents("Total Profit ($)")).alias("profit_c"),
        F.sum("Total Units Sold").alias("units"),
    )
    rev = F.coalesce(money("rev_c"), F.lit(0.0))
    profit = F.coalesce(money("profit_c"), F.lit(0.0))
    margin = F.when(rev > 0, profit / rev * F.lit(100.0)).otherwise(F.lit(0.0))
    return t.select(
        rev.alias("total_revenue"),
        profit.alias("total_profit"),
        F.bround(margin, 1).alias("avg_margin_pct"),
        F.coalesce(F.col("units"), F.lit(0)).cast("long").alias("total_units"),
    )


def period_series(tables: Tables) -> DataFrame:
    trend = monthly_sales_trend(tables)
    return trend.select(
        period_label(F.col("Year"), F.col("Month")).alias("Period"),
        "Monthly Revenue ($)",
        "Monthly Profit ($)",
    ).orderBy("Period")


# --- explorer ----------------------------------------------------------------


def list_tables(tables: Tables) -> list[str]:
    return sorted(t for t in tables if not t.startswith("_"))


def table_preview(tables: Tables, name: str, n: int = 100) -> DataFrame:
    """First ``n`` rows of a warehouse table in primary-key order; only names
    from the table listing are accepted."""
    key = name.lower()
    if key not in list_tables(tables):
        raise ValueError(f"unknown table {name!r}")
    df = head_of_fact(tables, n) if key == "fact_sales" else tables[key]
    return df.orderBy(schemas.GOLD_KEYS[key]).limit(n)
