"""Registered queries: Spark callables ``(spark, sf_dir) -> DataFrame`` and,
where the result is expressible in SQL, the DuckDB oracle statement over the
driver's pre-registered tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions import guard
from lakestar.functions.keys import stable_key
from lakestar.functions.text import py_strip, title_case, txn_id
from lakestar.operators import quality
from lakestar.operators.dedup import keep_first
from lakestar.oracle import R2, STABLE_KEY, STRIP, TITLE, WS, q, with_pipeline
from lakestar.plans import assistant, gold, intents, marts, published, silver
from lakestar.plans import registry as reg
from lakestar.plans.warehouse import (
    all_reports,
    bronze_from_landing,
    landing_for,
    numbered_ledger,
    product_count,
    published_database,
    rebuild_comparison,
    second_warehouse,
    testdata_warehouse,
)
from lakestar.sources import readers, testmap

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata_warehouse(spark, sf_dir).tables(spark)


def public_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = gold_tables(spark, sf_dir)
    return {t: tables[t] for t in marts.list_tables(tables)}


def _mart(fn, *args):
    return lambda spark, sf_dir: fn(gold_tables(spark, sf_dir), *args)


# --- I: marts -----------------------------------------------------------------

register("sales_by_category", with_pipeline(f"""
SELECT p.category AS "Product Category", COUNT(f.sales_key) AS "Total Orders",
       CAST(SUM(f.quantity) AS BIGINT) AS "Total Units Sold",
       {R2('SUM(f.total_revenue)')} AS "Total Revenue ($)",
       {R2('SUM(f.total_profit)')} AS "Total Profit ($)",
       {R2('(SUM(f.total_profit) / nullif(SUM(f.total_revenue), 0)) * 100')} AS "Profit Margin (%)"
FROM g_fact f JOIN g_dim_products p ON f.product_key = p.product_key
GROUP BY p.category ORDER BY SUM(f.total_revenue) DESC"""))(_mart(marts.sales_by_category))

register("top_customers", with_pipeline(f"""
SELECT c.customer_name AS "Customer Name", c.country AS "Country", c.membership_tier AS "Loyalty Tier",
       COUNT(f.sales_key) AS "Transaction Count", {R2('SUM(f.total_revenue)')} AS "Total Spent ($)"
FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key
GROUP BY c.customer_key, c.customer_name, c.country, c.membership_tier
ORDER BY SUM(f.total_revenue) DESC, c.customer_key LIMIT 5"""))(_mart(marts.top_customers, 5))

_TREND_SQL = f"""
SELECT t.year AS "Year", t.month AS "Month", {R2('SUM(f.total_revenue)')} AS "Monthly Revenue ($)",
       {R2('SUM(f.total_profit)')} AS "Monthly Profit ($)", CAST(SUM(f.quantity) AS BIGINT) AS "Quantity Sold"
FROM g_fact f JOIN g_dim_time t ON f.time_key = t.time_key
GROUP BY t.year, t.month ORDER BY t.year DESC, t.month DESC"""

register("monthly_sales_trend", with_pipeline(_TREND_SQL))(_mart(marts.monthly_sales_trend))
register("recent_months", with_pipeline(_TREND_SQL + " LIMIT 10"))(_mart(marts.recent_months, 10))

register("revenue_by_country", with_pipeline(f"""
SELECT c.country AS "Country", COUNT(DISTINCT c.customer_key) AS "Active Customers",
       COUNT(f.sales_key) AS "Total Orders", {R2('SUM(f.total_revenue)')} AS "Total Revenue ($)",
       {R2('AVG(f.total_revenue)')} AS "Avg Order Value ($)"
FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key
GROUP BY c.country ORDER BY SUM(f.total_revenue) DESC"""))(_mart(marts.revenue_by_country))

register("product_units_sold", with_pipeline("""
SELECT p.product_key AS "Product Key", p.product_name AS "Product Name", p.category AS "Category",
       p.unit_price AS "Unit Price ($)", CAST(SUM(f.quantity) AS BIGINT) AS "Historical Units Sold"
FROM g_dim_products p LEFT JOIN g_fact f ON p.product_key = f.product_key
GROUP BY p.product_key, p.product_name, p.category, p.unit_price
ORDER BY SUM(f.quantity) DESC NULLS LAST"""))(_mart(marts.product_units_sold))

_CATEGORY_ROWS = f"""
cat AS (
  SELECT {R2('SUM(f.total_revenue)')} AS rev, {R2('SUM(f.total_profit)')} AS profit, SUM(f.quantity) AS units
  FROM g_fact f JOIN g_dim_products p ON f.product_key = p.product_key GROUP BY p.category)"""

register("kpi_totals", with_pipeline(f"""
SELECT {R2('coalesce(SUM(rev), 0)')} AS total_revenue, {R2('coalesce(SUM(profit), 0)')} AS total_profit,
       round_even(CASE WHEN SUM(rev) > 0 THEN SUM(profit) / SUM(rev) * 100 ELSE 0 END, 1) AS avg_margin_pct,
       CAST(coalesce(SUM(units), 0) AS BIGINT) AS total_units
FROM cat""", extra_ctes=_CATEGORY_ROWS))(_mart(marts.kpi_totals))

register("period_series", with_pipeline(f"""
SELECT printf('%d-%02d', t.year, t.month) AS "Period", {R2('SUM(f.total_revenue)')} AS "Monthly Revenue ($)",
       {R2('SUM(f.total_profit)')} AS "Monthly Profit ($)"
FROM g_fact f JOIN g_dim_time t ON f.time_key = t.time_key
GROUP BY t.year, t.month ORDER BY 1"""))(_mart(marts.period_series))

# --- I8-I13: question templates ------------------------------------------------


def _template(intent):
    return lambda spark, sf_dir: intents.mart(intent, gold_tables(spark, sf_dir))


register("nl_category", with_pipeline(f"""
SELECT p.category AS "Category", {R2('SUM(f.total_revenue)')} AS "Revenue", CAST(SUM(f.quantity) AS BIGINT) AS "Quantity_Sold"
FROM g_fact f JOIN g_dim_products p ON f.product_key = p.product_key
GROUP BY p.category ORDER BY "Revenue" DESC"""))(_template("category"))

register("nl_customer", with_pipeline(f"""
SELECT c.customer_name AS "Customer", c.country AS "Country", c.membership_tier AS "Tier",
       {R2('SUM(f.total_revenue)')} AS "Total_Spent"
FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key
GROUP BY c.customer_key, c.customer_name, c.country, c.membership_tier
ORDER BY "Total_Spent" DESC, c.customer_key LIMIT 10"""))(_template("customer"))

register("nl_country", with_pipeline(f"""
SELECT c.country AS "Country", COUNT(f.sales_key) AS "Orders", {R2('SUM(f.total_revenue)')} AS "Revenue"
FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key
GROUP BY c.country ORDER BY "Revenue" DESC"""))(_template("country"))

register("nl_trend", with_pipeline(f"""
SELECT t.year AS "Year", t.month AS "Month", {R2('SUM(f.total_revenue)')} AS "Revenue",
       {R2('SUM(f.total_profit)')} AS "Profit"
FROM g_fact f JOIN g_dim_time t ON f.time_key = t.time_key
GROUP BY t.year, t.month ORDER BY "Year" DESC, "Month" DESC LIMIT 12"""))(_template("trend"))

register("nl_profit", with_pipeline(f"""
SELECT p.category AS "Category", {R2('SUM(f.total_revenue)')} AS "Revenue", {R2('SUM(f.total_profit)')} AS "Profit"
FROM g_fact f JOIN g_dim_products p ON f.product_key = p.product_key
GROUP BY p.category ORDER BY "Profit" DESC"""))(_template("profit"))

register("nl_default", with_pipeline("""
SELECT f.transaction_id, c.customer_name, p.product_name, p.category, f.total_revenue
FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key
JOIN g_dim_products p ON f.product_key = p.product_key
ORDER BY f.sales_key LIMIT 10"""))(_template("default"))

register("all_reports", with_pipeline(f"""
SELECT 'sales_by_category' AS report, item, metric, value FROM (
  SELECT p.category AS item, COUNT(*)::DOUBLE AS "Total Orders", SUM(f.quantity)::DOUBLE AS "Total Units Sold", {R2('SUM(f.total_revenue)')} AS "Total Revenue ($)",
         {R2('SUM(f.total_profit)')} AS "Total Profit ($)", {R2('SUM(f.total_profit) / SUM(f.total_revenue) * 100')} AS "Profit Margin (%)"
  FROM g_fact f JOIN g_dim_products p ON f.product_key = p.product_key GROUP BY p.category)
UNPIVOT (value FOR metric IN ("Total Orders", "Total Units Sold", "Total Revenue ($)", "Total Profit ($)", "Profit Margin (%)"))
UNION ALL SELECT 'top_customers', item, metric, value FROM (
  SELECT c.customer_name AS item, COUNT(*)::DOUBLE AS "Transaction Count", {R2('SUM(f.total_revenue)')} AS "Total Spent ($)"
  FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key GROUP BY c.customer_key, c.customer_name ORDER BY SUM(f.total_revenue) DESC, c.customer_key LIMIT 5)
UNPIVOT (value FOR metric IN ("Transaction Count", "Total Spent ($)"))
UNION ALL SELECT 'recent_months', item, metric, value FROM (
  SELECT printf('%d-%02d', t.year, t.month) AS item, {R2('SUM(f.total_revenue)')} AS "Monthly Revenue ($)", {R2('SUM(f.total_profit)')} AS "Monthly Profit ($)", SUM(f.quantity)::DOUBLE AS "Quantity Sold"
  FROM g_fact f JOIN g_dim_time t ON f.time_key = t.time_key GROUP BY t.year, t.month ORDER BY t.year DESC, t.month DESC LIMIT 10)
UNPIVOT (value FOR metric IN ("Monthly Revenue ($)", "Monthly Profit ($)", "Quantity Sold"))
UNION ALL SELECT 'revenue_by_country', item, metric, value FROM (
  SELECT c.country AS item, COUNT(DISTINCT c.customer_key)::DOUBLE AS "Active Customers", COUNT(*)::DOUBLE AS "Total Orders", {R2('SUM(f.total_revenue)')} AS "Total Revenue ($)",
         {R2('AVG(f.total_revenue)')} AS "Avg Order Value ($)"
  FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key GROUP BY c.country)
UNPIVOT (value FOR metric IN ("Active Customers", "Total Orders", "Total Revenue ($)", "Avg Order Value ($)"))"""))(_mart(all_reports))

register("table_preview", with_pipeline("""
SELECT * FROM g_fact ORDER BY sales_key LIMIT 100"""))(
    lambda spark, sf_dir: marts.table_preview(gold_tables(spark, sf_dir), "Fact_Sales", 100)
)

# --- B/H: silver dimensions and expressions -------------------------------------



def bronze(spark: SparkSession, sf_dir: str):
    return bronze_from_landing(spark, landing_for(spark, sf_dir))


register("dim_customers", with_pipeline("SELECT * FROM g_dim_customers"))(
    lambda spark, sf_dir: silver.dim_customers(bronze(spark, sf_dir).customers, ["row_no"])
)
register("dim_products", with_pipeline("SELECT * FROM g_dim_products"))(
    lambda spark, sf_dir: silver.dim_products(bronze(spark, sf_dir).products, ["row_no"])
)
register("dim_stores", with_pipeline("SELECT * FROM g_dim_stores"))(
    lambda spark, sf_dir: silver.dim_stores(bronze(spark, sf_dir).stores)
)
register("dim_time", with_pipeline("SELECT * FROM g_dim_time"))(
    lambda spark, sf_dir: silver.dim_time(bronze(spark, sf_dir).sales)
)

for _t in ("dim_customers", "dim_products", "dim_stores", "dim_time", "fact_sales"):
    register(f"gold_{_t}", with_pipeline(f"SELECT * FROM g_{_t.replace('fact_sales', 'fact')}"))(
        (lambda t: lambda spark, sf_dir: gold_tables(spark, sf_dir)[t].select(*schemas.GOLD_COLUMNS[t]))(_t)
    )

register("clean_customers", with_pipeline(f"""
SELECT customer_id, {STRIP('customer_name')} AS customer_name, {STRIP('email')} AS email,
       {STRIP('country')} AS country FROM bz_customers"""))(
    lambda spark, sf_dir: bronze(spark, sf_dir).customers.select(
        "customer_id",
        py_strip(F.col("customer_name")).alias("customer_name"),
        py_strip(F.col("email")).alias("email"),
        py_strip(F.col("country")).alias("country"),
    )
)

register("title_case", f"""
SELECT conv_id, turn, {TITLE('text')} AS titled FROM conversations""")(
    lambda spark, sf_dir: testmap.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", title_case(F.col("text")).alias("titled")
    )
)

register("stable_product_key", with_pipeline(f"""
SELECT DISTINCT "Product" AS product_name,
       {STABLE_KEY('coalesce("Product", ' + q(silver.NULL_PRODUCT_TEXT) + ')', '(SELECT greatest(count(*), 1) FROM g_dim_products)')} AS product_key
FROM bz_sales"""))(
    lambda spark, sf_dir: bronze(spark, sf_dir).sales.select(F.col("Product").alias("product_name")).distinct().select(
        "product_name",
        stable_key(
            F.coalesce(F.col("product_name"), F.lit(silver.NULL_PRODUCT_TEXT)),
            max(product_count(spark, sf_dir), 1),
        ).alias("product_key"),
    )
)

register("country_to_customer", with_pipeline("SELECT country, customer_key FROM g_cust_lookup"))(
    lambda spark, sf_dir: silver.country_to_customer(gold_tables(spark, sf_dir)["dim_customers"])
)


def _ledger_countries(spark, sf_dir):
    s = bronze(spark, sf_dir).sales
    return s.select(title_case(py_strip(F.col("Country"))).alias("country")).where(F.col("country").isNotNull()).distinct()


register("country_to_store", with_pipeline(f"""
SELECT c.ctry AS country, coalesce(s.store_key, {silver.DEFAULT_STORE_KEY})::BIGINT AS store_key
FROM (SELECT DISTINCT ctry FROM g_ledger WHERE ctry IS NOT NULL) c LEFT JOIN g_store_lookup s ON c.ctry = s.country"""))(
    lambda spark, sf_dir: _ledger_countries(spark, sf_dir)
    .join(silver.country_to_store(gold_tables(spark, sf_dir)["dim_stores"]), "country", "left")
    .select("country", F.coalesce(F.col("store_key"), F.lit(silver.DEFAULT_STORE_KEY)).cast("long").alias("store_key"))
)

_LEDGER_KEYS_SQL = ", ".join(f"l.{c}" for c in testmap.LEDGER_ORDER)
_LEDGER_KEYS = list(testmap.LEDGER_ORDER)

register("fact_measures", with_pipeline(f"""
SELECT {_LEDGER_KEYS_SQL}, c.quantity, c.unit_price, m.total_revenue, a.total_profit
FROM g_ledger l JOIN g_conformed c ON l.seq = c.seq JOIN g_measured m ON m.seq = l.seq JOIN g_all a ON a.seq = l.seq"""))(
    lambda spark, sf_dir: numbered_ledger(spark, sf_dir).select(
        *_LEDGER_KEYS, "quantity", "unit_price", "total_revenue", "total_profit"
    )
)

register("fill_defaults", with_pipeline("""
SELECT filled_quantity, filled_price, default_store, COUNT(*) AS ledger_rows, CAST(SUM(quantity) AS BIGINT) AS quantity
FROM g_conformed GROUP BY ALL"""))(
    lambda spark, sf_dir: numbered_ledger(spark, sf_dir).groupBy(
        F.col("_filled_qty").alias("filled_quantity"),
        F.col("_filled_price").alias("filled_price"),
        F.col("_default_store").alias("default_store"),
    ).agg(F.count(F.lit(1)).alias("ledger_rows"), F.sum("quantity").alias("quantity"))
)


def _prune_reason():
    return F.when(F.col("customer_key").isNull(), F.lit("no_customer")).when(F.col("time_key").isNull(), F.lit("no_date"))


register("orphan_prune", with_pipeline("""
SELECT transaction_id, CASE WHEN customer_key IS NULL THEN 'no_customer' ELSE 'no_date' END AS reason
FROM g_all WHERE customer_key IS NULL OR time_key IS NULL"""))(
    lambda spark, sf_dir: numbered_ledger(spark, sf_dir)
    .where(~silver.keep_condition())
    .select(txn_id(F.col("_txn")).alias("transaction_id"), _prune_reason().alias("reason"))
)


def _transaction_ids(spark, sf_dir):
    return numbered_ledger(spark, sf_dir).select(txn_id(F.col("_txn")).alias("transaction_id"), "sales_key", *_LEDGER_KEYS)


register("transaction_ids", with_pipeline(f"""
SELECT a.transaction_id, f.sales_key, {_LEDGER_KEYS_SQL}
FROM g_all a JOIN g_ledger l ON a.seq = l.seq LEFT JOIN g_fact f ON f.transaction_id = a.transaction_id"""))(
    _transaction_ids
)


register("dedup_first", with_pipeline("""
SELECT customer_id, customer_name, email, country, membership_tier FROM bz_customers
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_no) = 1"""))(
    lambda spark, sf_dir: keep_first(bronze(spark, sf_dir).customers, ["customer_id"], ["row_no"]).drop("row_no")
)

# --- A: sources -------------------------------------------------------------------

register("src_customers", with_pipeline("SELECT * FROM bz_customers"))(
    lambda spark, sf_dir: bronze(spark, sf_dir).customers
)
register("src_stores", with_pipeline("SELECT * FROM bz_stores"))(lambda spark, sf_dir: bronze(spark, sf_dir).stores)
register("src_products", with_pipeline("SELECT * FROM bz_products"))(
    lambda spark, sf_dir: bronze(spark, sf_dir).products
)
register("src_sales", with_pipeline("SELECT * FROM bz_sales"))(lambda spark, sf_dir: bronze(spark, sf_dir).sales)

_QUOTED = f"list_extract([{', '.join(q(x) for x in testmap.QUOTED_PRODUCTS)}], (p_partkey % {len(testmap.QUOTED_PRODUCTS)}) + 1)"
_NUMBER = f"list_extract([{', '.join(q(x) for x in testmap.MISSING_NUMBERS)}], (p_partkey % {len(testmap.MISSING_NUMBERS)}) + 1)"
register("src_sales_quoted", f"""
SELECT p_partkey::BIGINT AS p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN '2024-02-03' END AS "Date", p_type AS "Country",
       CASE WHEN {_QUOTED} NOT IN ('NA', 'n/a') THEN replace({_QUOTED}, '{{k}}', p_partkey::VARCHAR) END AS "Product",
       TRY_CAST({_NUMBER} AS DOUBLE) AS "Order_Quantity",
       CASE WHEN p_partkey % 3 = 0 AND {_NUMBER} IN ('1.5', '2') THEN {_NUMBER}::DOUBLE END AS "Unit_Price"
FROM part""".replace(f"TRY_CAST({_NUMBER} AS DOUBLE)", f"CASE WHEN {_NUMBER} IN ('1.5', '2') THEN {_NUMBER}::DOUBLE END"))(
    lambda spark, sf_dir: readers.read_ledger(
        spark, landing_for(spark, sf_dir)["ledger_quoted"], {"p_partkey": "long"}, multi_line=True
    )
)

_EXTRACT_SQL = f"""
bz_extract AS (
  SELECT c.c_custkey::BIGINT AS "Row ID",
         'Ab ' || (c.c_custkey % 7)::VARCHAR || ' Cd' || (c.c_custkey % 100)::VARCHAR AS "Customer Name",
         list_extract([{', '.join(q(s) for s in testmap.EXTRACT_SEGMENTS)}], (c.c_custkey % {len(testmap.EXTRACT_SEGMENTS)}) + 1) AS "Customer Segment",
         n.n_name || '-' || (c.c_custkey % 5)::VARCHAR AS "City", r.r_name AS "State"
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _extract(spark, sf_dir):
    return readers.read_orders_extract(
        spark, landing_for(spark, sf_dir)["orders_extract"], testmap.EXTRACT_POSITION
    )


register("src_orders_extract", f"WITH {_EXTRACT_SQL.strip()}\nSELECT * FROM bz_extract")(_extract)

# --- L2: registry -----------------------------------------------------------------


_COUNTRIES = "[" + ", ".join(q(c) for c in reg.COUNTRIES) + "]"
_TIER_CASE = "CASE seg " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in reg.SEGMENT_TIERS.items()) + f" ELSE {q(reg.DEFAULT_TIER)} END"
_WS_SPLIT = "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
_REGISTRY_CTES = f"""{_EXTRACT_SQL.strip()},
bz_positioned AS (SELECT *, row_number() OVER (ORDER BY "Row ID") - 1 AS pos FROM bz_extract),
r_uniq AS (
  SELECT pos, {STRIP('coalesce("Customer Name", ' + q(reg.MISSING_TEXT) + ')')} AS nm,
         {STRIP('coalesce("Customer Segment", ' + q(reg.MISSING_TEXT) + ')')} AS seg
  FROM bz_positioned QUALIFY row_number() OVER (PARTITION BY "Customer Name" ORDER BY pos) = 1),
r_tok AS (
  SELECT *, string_split_regex(nm, '{_WS_SPLIT}') AS parts FROM r_uniq),
r_named AS (
  SELECT pos, nm, seg,
         CASE WHEN nm = '' THEN {q(reg.DEFAULT_FIRST)} ELSE lower(parts[1]) END AS fst,
         CASE WHEN nm <> '' AND len(parts) > 1 THEN lower(parts[-1]) ELSE {q(reg.DEFAULT_LAST)} END AS lst
  FROM r_tok),
r_emails AS (
  SELECT pos, nm AS customer_name, fst || '.' || lst || {q(reg.EMAIL_DOMAIN)} AS base_email,
         row_number() OVER (PARTITION BY fst || '.' || lst ORDER BY pos) > 1 AS suffixed, fst, lst, seg
  FROM r_named),
r_customers AS (
  SELECT row_number() OVER (ORDER BY pos) AS customer_id, customer_name,
         CASE WHEN suffixed THEN fst || '.' || lst || pos::VARCHAR || {q(reg.EMAIL_DOMAIN)} ELSE base_email END AS email,
         list_extract({_COUNTRIES}, (pos % {len(reg.COUNTRIES)}) + 1) AS country,
         {_TIER_CASE} AS membership_tier, pos, base_email, suffixed
  FROM r_emails),
r_stores AS (
  SELECT row_number() OVER (ORDER BY pos) AS store_id,
         {q(reg.STORE_PREFIX)} || {STRIP('"City"')} AS store_name, {STRIP('"City"')} AS city, {STRIP('"State"')} AS state,
         list_extract({_COUNTRIES}, (pos % {len(reg.COUNTRIES)}) + 1) AS country
  FROM (SELECT pos, "City", "State" FROM bz_positioned
        QUALIFY row_number() OVER (PARTITION BY "City", "State" ORDER BY pos) = 1))"""


_REGISTRIES: dict[tuple[str, str], reg.Registry] = {}


def _registry(spark, sf_dir):
    """One registry per application and scale directory; its staged tables serve all queries.
    The extract is read without its position column: the place in the files counts."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _REGISTRIES:
        _REGISTRIES[key] = reg.build_registry(readers.read_orders_extract(spark, landing_for(spark, sf_dir)["orders_extract"]))
    return _REGISTRIES[key]


register("registry_customers", f"""WITH {_REGISTRY_CTES}
SELECT customer_id, customer_name, email, country, membership_tier FROM r_customers""")(
    lambda spark, sf_dir: _registry(spark, sf_dir).customers
)
register("registry_stores", f"WITH {_REGISTRY_CTES}\nSELECT * FROM r_stores")(
    lambda spark, sf_dir: _registry(spark, sf_dir).stores
)
register("registry_emails", f"""WITH {_REGISTRY_CTES}
SELECT pos, customer_name, base_email, email, suffixed FROM r_customers""")(
    lambda spark, sf_dir: _registry(spark, sf_dir).emails.select("pos", "customer_name", "base_email", "email", "suffixed")
)
_G, _P1, _P2 = "(c_custkey // 5)", "(c_custkey // 5 * 5 + 1)", "(c_custkey // 5 * 5 + 2)"
register("registry_email_chain", f"""
SELECT c_custkey::BIGINT AS pos, c_custkey % 5 IN (1, 2, 3) AS suffixed,
       'g' || {_G} || CASE c_custkey % 5 WHEN 0 THEN '.lee' WHEN 1 THEN '.lee' || {_P1} WHEN 2 THEN '.lee' || {_P1} || {_P2}
         WHEN 3 THEN '.lee' || {_P1} || {_P2} || (c_custkey // 5 * 5 + 3) ELSE '.other' END || {q(reg.EMAIL_DOMAIN)} AS email
FROM customer""")(
    lambda spark, sf_dir: reg.registry_emails(testmap.chained_names(spark, sf_dir)).select("pos", "suffixed", "email")
)
register("segment_tier", f"""WITH {_EXTRACT_SQL.strip()}
SELECT "Row ID", "Customer Segment",
       CASE {STRIP('"Customer Segment"')} {' '.join(f'WHEN {q(k)} THEN {q(v)}' for k, v in reg.SEGMENT_TIERS.items())} ELSE {q(reg.DEFAULT_TIER)} END AS membership_tier
FROM bz_extract""")(
    lambda spark, sf_dir: _extract(spark, sf_dir).select(
        "Row ID", "Customer Segment", reg.segment_tier(py_strip(F.col("Customer Segment"))).alias("membership_tier")
    )
)

# --- A13/A14: build audit -------------------------------------------------------

_STAGE_SQL = {
    "bronze_customers": "SELECT count(*) FROM bz_customers",
    "dim_customers": "SELECT count(*) FROM g_dim_customers",
    "bronze_products": "SELECT count(*) FROM bz_products",
    "dim_products": "SELECT count(*) FROM g_dim_products",
    "bronze_stores": "SELECT count(*) FROM bz_stores",
    "dim_stores": "SELECT count(*) FROM g_dim_stores",
    "dim_time": "SELECT count(*) FROM g_dim_time",
    "bronze_ledger": "SELECT count(*) FROM bz_sales",
    "pruned_rows": "SELECT count(*) FROM g_conformed WHERE customer_key IS NULL OR time_key IS NULL",
    "no_customer": "SELECT count(*) FROM g_conformed WHERE customer_key IS NULL",
    "no_date": "SELECT count(*) FROM g_conformed WHERE time_key IS NULL",
    "default_store": "SELECT count(*) FROM g_conformed WHERE default_store",
    "filled_quantity": "SELECT count(*) FROM g_conformed WHERE filled_quantity",
    "filled_price": "SELECT count(*) FROM g_conformed WHERE filled_price",
    "fact_sales": "SELECT count(*) FROM g_fact",
    "quarantined": "SELECT count(*) FROM g_ledger WHERE d IS NULL AND \"Date\" IS NOT NULL",
}
register("stage_row_counts", with_pipeline(
    "\nUNION ALL\n".join(f"SELECT {q(k)} AS stage, ({v})::BIGINT AS rows" for k, v in _STAGE_SQL.items())
))(lambda spark, sf_dir: testdata_warehouse(spark, sf_dir).stage_counts(spark))

# The second warehouse: places that fail, a catalogue in arrays, dates that can't be read.


def _second(read):
    return lambda spark, sf_dir: read(spark, second_warehouse(spark, sf_dir))


_UNREADABLE = "d IS NULL AND \"Date\" IS NOT NULL"
_PLACES = {"customers": ("remote", "local"), "stores": ("remote", "local"), "products": ("remote", "mirror", "local"), "ledger": ("remote",)}
register("second_stage_counts", with_pipeline("\nUNION ALL\n".join(
    [f"SELECT {q(k)} AS stage, ({v})::BIGINT AS rows" for k, v in _STAGE_SQL.items()]
    + [f"SELECT 'source_{t}_{places[-1]}', ({_STAGE_SQL['bronze_' + t]})::BIGINT" for t, places in _PLACES.items()]
    + [f"SELECT 'failed_{t}_{p}', 0" for t, places in _PLACES.items() for p in places[:-1]]
), dated=True))(_second(lambda spark, second: gold.read_stage_counts(spark, second.version_path)))
register("second_sources", "\nUNION ALL\n".join(
    f"SELECT {q(t)} AS table_name, {q(p)} AS source, {str(p == places[-1]).upper()} AS used, {'NULL' if p == places[-1] else q('PATH_NOT_FOUND')} AS error"
    for t, places in _PLACES.items() for p in places
))(_second(lambda spark, second: gold.read_sources(spark, second.version_path).withColumn("error", F.regexp_extract("error", "\\[([A-Z_]+)\\]", 1))))
register("second_dim_products", with_pipeline("SELECT * FROM g_dim_products", dated=True))(
    _second(lambda spark, second: gold.open_tables(spark, second.version_path)["dim_products"])
)
register("second_fact_sales", with_pipeline("SELECT * FROM g_fact", dated=True))(
    _second(lambda spark, second: gold.open_tables(spark, second.version_path)["fact_sales"])
)
register("quarantined_rows", with_pipeline(f"""
SELECT l.seq AS ledger_row, l."Date" AS date_text, c.product_key, c.quantity, c.unit_price
FROM g_ledger l JOIN g_conformed c ON l.seq = c.seq WHERE {_UNREADABLE.replace('d IS', 'l.d IS').replace('"Date"', 'l."Date"')}""", dated=True))(
    _second(lambda spark, second: gold.read_quarantine(spark, second.version_path))
)
register("built_if_absent", with_pipeline("""
SELECT n AS call, n > 1 AS existed, TRUE AS same_version, (SELECT count(*) FROM g_fact) AS fact_rows FROM (VALUES (1::BIGINT), (2)) calls(n)""", dated=True))(
    _second(lambda spark, second: spark.createDataFrame(second.calls, "call long, existed boolean, same_version boolean, fact_rows long"))
)

_GOLD_CTE = {t: f"g_{t}" if t != "fact_sales" else "g_fact" for t in schemas.GOLD_COLUMNS}

register("list_tables", with_pipeline("\nUNION ALL\n".join(f"SELECT {q(t)} AS table_name, count(*) AS rows FROM {c}" for t, c in sorted(_GOLD_CTE.items()))))(
    lambda spark, sf_dir: published.list_tables(spark, published_database(spark, sf_dir))
)
register("trend_of_quarter", with_pipeline(f"""
SELECT t.year AS "Year", t.month AS "Month", {R2('SUM(f.total_revenue)')} AS "Monthly Revenue ($)",
       {R2('SUM(f.total_profit)')} AS "Monthly Profit ($)", CAST(SUM(f.quantity) AS BIGINT) AS "Quantity Sold"
FROM g_fact f JOIN g_dim_time t ON f.time_key = t.time_key WHERE t.quarter = 2
GROUP BY t.year, t.month ORDER BY t.year DESC, t.month DESC"""))(
    lambda spark, sf_dir: published.trend_of_quarter(spark, 2, published_database(spark, sf_dir))
)

register("rebuild_is_identical", with_pipeline("\nUNION ALL\n".join(
    f"SELECT {q(t)} AS table_name, count(*)::BIGINT AS rows, TRUE AS identical FROM {c}"
    for t, c in sorted(_GOLD_CTE.items())
)))(lambda spark, sf_dir: rebuild_comparison(spark, sf_dir))

# --- J: constraint reports --------------------------------------------------------


def _pk_sql(name: str, cte: str, key: str) -> str:
    return (
        f"SELECT {q(name)} AS table_name, {q(key)} AS key_column, "
        f"count(*) FILTER (WHERE n > 1 OR k IS NULL) AS duplicate_keys, "
        f"coalesce(sum(n - 1) FILTER (WHERE n > 1), 0)::BIGINT AS surplus_rows "
        f"FROM (SELECT {key} AS k, count(*) AS n FROM {cte} GROUP BY {key})"
    )


register("pk_violations", with_pipeline("\nUNION ALL\n".join(
    [_pk_sql(t, _GOLD_CTE[t], schemas.GOLD_KEYS[t]) for t in schemas.GOLD_COLUMNS]
    + [_pk_sql("registry_customers", "r_customers", "email")]
), extra_ctes=_REGISTRY_CTES))(
    lambda spark, sf_dir: quality.key_violations(
        [(t, df, schemas.GOLD_KEYS[t]) for t, df in public_tables(spark, sf_dir).items() if t != "fact_sales"]
        + [("registry_customers", _registry(spark, sf_dir).customers, "email")]
    ).unionByName(quality.dense_key_violations("fact_sales", gold_tables(spark, sf_dir)["fact_sales"], schemas.GOLD_KEYS["fact_sales"]))
)

register("null_violations", with_pipeline("\nUNION ALL\n".join(
    f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {_GOLD_CTE[t]}"
    for t in schemas.GOLD_COLUMNS for c in schemas.GOLD_COLUMNS[t]
)))(
    lambda spark, sf_dir: quality.null_violations(
        [(t, df, schemas.GOLD_COLUMNS[t]) for t, df in public_tables(spark, sf_dir).items()]
    )
)

register("fk_violations", with_pipeline("\nUNION ALL\n".join(
    f"SELECT {q(fk)} AS fk_column, {q(dim)} AS ref_table, count(DISTINCT f.{fk}) AS orphan_keys, count(*) AS orphan_rows "
    f"FROM g_fact f WHERE NOT EXISTS (SELECT 1 FROM {_GOLD_CTE[dim]} d WHERE d.{fk} = f.{fk})"
    for fk, dim in schemas.FACT_FOREIGN_KEYS
)))(
    lambda spark, sf_dir: (lambda t: quality.fk_violations(
        t["fact_sales"], [(fk, t[dim], dim) for fk, dim in schemas.FACT_FOREIGN_KEYS]
    ))(gold_tables(spark, sf_dir))
)

_LEN_SOURCES = {"customers": "bz_customers", "stores": "bz_stores"}
register("length_violations", with_pipeline("\nUNION ALL\n".join(
    f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, {n} AS max_length, "
    f"count(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {_LEN_SOURCES[t]}"
    for t, limits in quality.REGISTRY_MAX_LENGTHS.items() for c, n in limits.items()
)))(
    lambda spark, sf_dir: (lambda b: quality.length_violations(
        [("customers", b.customers, quality.REGISTRY_MAX_LENGTHS["customers"]),
         ("stores", b.stores, quality.REGISTRY_MAX_LENGTHS["stores"])]
    ))(bronze(spark, sf_dir))
)


def _faults(spark, sf_dir):
    """Copies of the tables with faults put in: repeated and missing keys, nulls, orphans, long texts."""
    t = gold_tables(spark, sf_dir)
    c, p, f = t["dim_customers"], t["dim_products"], t["fact_sales"]
    repeated = c.unionByName(c.where("customer_key % 10 = 0")).unionByName(c.where("customer_key % 20 = 0").withColumn("customer_key", F.lit(None).cast("long")))
    again = f.unionByName(f.where("sales_key % 50 = 0"))
    nulls = p.withColumn("category", F.when(F.col("product_key") % 7 != 0, F.col("category")))
    orphans = f.withColumn("customer_key", F.when(F.col("sales_key") % 100 == 0, -F.col("sales_key")).otherwise(F.col("customer_key")))
    long = c.withColumn("country", F.when(F.col("customer_key") % 3 == 0, F.repeat(F.lit("x"), 51)).otherwise(F.col("country")))
    keys = quality.key_violations([("dim_customers", repeated, "customer_key")]).unionByName(quality.dense_key_violations("fact_sales", again, "sales_key"))
    return (
        keys.select(F.concat("table_name", F.lit(".keys")).alias("fault"), "duplicate_keys", "surplus_rows")
        .unionByName(quality.null_violations([("dim_products", nulls, ["category"])]).select(F.lit("null").alias("fault"), F.lit(0).cast("long").alias("duplicate_keys"), F.col("null_rows").alias("surplus_rows")))
        .unionByName(
            quality.fk_violations(orphans, [("customer_key", c, "dim_customers")]).select(F.lit("orphan").alias("fault"), F.col("orphan_keys").alias("duplicate_keys"), F.col("orphan_rows").alias("surplus_rows"))
        )
        .unionByName(
            quality.length_violations([("customers", long, {"country": 50})]).select(F.lit("length").alias("fault"), F.lit(0).cast("long").alias("duplicate_keys"), F.col("violations").alias("surplus_rows"))
        )
    )


register("constraint_faults", with_pipeline("""
SELECT 'dim_customers.keys' AS fault, count(*) FILTER (WHERE customer_key % 10 = 0) + (count(*) FILTER (WHERE customer_key % 20 = 0) > 0)::BIGINT AS duplicate_keys,
       count(*) FILTER (WHERE customer_key % 10 = 0) + greatest(count(*) FILTER (WHERE customer_key % 20 = 0) - 1, 0) AS surplus_rows FROM g_dim_customers
UNION ALL SELECT 'fact_sales.keys', count(*), count(*) FROM g_fact WHERE sales_key % 50 = 0
UNION ALL SELECT 'null', 0, count(*) FROM g_dim_products WHERE product_key % 7 = 0
UNION ALL SELECT 'orphan', count(*), count(*) FROM g_fact WHERE sales_key % 100 = 0
UNION ALL SELECT 'length', 0, count(*) FROM g_dim_customers WHERE customer_key % 3 = 0"""))(_faults)

# --- K: text operators over tables of statements / questions / replies ----------



def _text_source_sql(templates: list[str]) -> str:
    arr = "[" + ", ".join(q(t) for t in templates) + "]"
    return (
        f"SELECT 'orders' AS src, o_orderkey::BIGINT AS k1, 0::BIGINT AS k2, "
        f"replace(list_extract({arr}, (o_orderkey % {len(templates)})::BIGINT + 1), '{{k}}', o_orderkey::VARCHAR) AS text "
        f"FROM orders UNION ALL SELECT 'conversations', conv_id::BIGINT, turn::BIGINT, text FROM conversations"
    )


_W = "[\\p{L}\\p{N}_]"
_W_NOT = "[^\\p{L}\\p{N}_]"
_GUARD_CASE = (
    "CASE "
    + " ".join(
        f"WHEN regexp_matches(u, '(^|{_W_NOT}){kw}($|{_W_NOT})') THEN {q(guard.KEYWORD_MESSAGE.format(kw=kw))}"
        for kw in guard.FORBIDDEN_KEYWORDS
    )
    + " WHEN NOT (" + " OR ".join(f"starts_with(u, {q(p)})" for p in guard.READ_ONLY_PREFIXES) + ")"
    + f" THEN {q(guard.PREFIX_MESSAGE)} ELSE '' END"
)

register("sql_guard", f"""
WITH stm AS ({_text_source_sql(testmap.STATEMENT_TEMPLATES)}),
u AS (SELECT src, k1, k2, upper({STRIP('text')}) AS u FROM stm),
g AS (SELECT src, k1, k2, {_GUARD_CASE} AS reason FROM u)
SELECT src, k1, k2, reason, reason = '' AS is_safe FROM g""")(
    lambda spark, sf_dir: guard.with_sql_guard(testmap.statements(spark, sf_dir), "text").select(
        "src", "k1", "k2", "reason", "is_safe"
    )
)

_INTENT_CASE = (
    "CASE "
    + " ".join(
        "WHEN " + " OR ".join(f"contains(p, {q(w)})" for w in words) + f" THEN {q(name)}"
        for name, words in guard.INTENT_KEYWORDS
    )
    + f" ELSE {q(guard.DEFAULT_INTENT)} END"
)

register("route_questions", f"""
WITH qs AS ({_text_source_sql(testmap.QUESTION_TEMPLATES)})
SELECT src, k1, k2, {_INTENT_CASE} AS intent FROM (SELECT src, k1, k2, lower(text) AS p FROM qs)""")(
    lambda spark, sf_dir: guard.with_intent(testmap.questions(spark, sf_dir), "text").select("src", "k1", "k2", "intent")
)

# The statements of the six intents, written out: the engine makes its own from the templates.
_STATEMENTS = {
    "category": "SELECT d.category AS Category, SUM(s.revenue_c) / 100e0 AS Revenue, SUM(s.units) AS Quantity_Sold "
    "FROM (SELECT product_key, SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) AS revenue_c, SUM(quantity) AS units FROM fact_sales GROUP BY product_key) s "
    "JOIN dim_products d ON s.product_key = d.product_key GROUP BY d.category ORDER BY Revenue DESC, Category",
    "customer": "SELECT d.customer_name AS Customer, d.country AS Country, d.membership_tier AS Tier, SUM(s.revenue_c) / 100e0 AS Total_Spent "
    "FROM (SELECT customer_key, SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) AS revenue_c FROM fact_sales GROUP BY customer_key) s "
    "JOIN dim_customers d ON s.customer_key = d.customer_key GROUP BY d.customer_key, d.customer_name, d.country, d.membership_tier "
    "ORDER BY Total_Spent DESC, d.customer_key LIMIT 10",
    "country": "SELECT d.country AS Country, SUM(s.orders) AS Orders, SUM(s.revenue_c) / 100e0 AS Revenue "
    "FROM (SELECT customer_key, COUNT(sales_key) AS orders, SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) AS revenue_c FROM fact_sales GROUP BY customer_key) s "
    "JOIN dim_customers d ON s.customer_key = d.customer_key GROUP BY d.country ORDER BY Revenue DESC, Country",
    "trend": "SELECT d.year AS Year, d.month AS Month, SUM(s.revenue_c) / 100e0 AS Revenue, SUM(s.profit_c) / 100e0 AS Profit "
    "FROM (SELECT time_key, SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) AS revenue_c, SUM(CAST(ROUND(total_profit * 100) AS BIGINT)) AS profit_c "
    "FROM fact_sales GROUP BY time_key) s JOIN dim_time d ON s.time_key = d.time_key GROUP BY d.year, d.month ORDER BY Year DESC, Month DESC LIMIT 12",
    "profit": "SELECT d.category AS Category, SUM(s.revenue_c) / 100e0 AS Revenue, SUM(s.profit_c) / 100e0 AS Profit "
    "FROM (SELECT product_key, SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) AS revenue_c, SUM(CAST(ROUND(total_profit * 100) AS BIGINT)) AS profit_c "
    "FROM fact_sales GROUP BY product_key) s JOIN dim_products d ON s.product_key = d.product_key GROUP BY d.category ORDER BY Profit DESC, Category",
    "default": "SELECT f.transaction_id, c.customer_name, p.product_name, p.category, f.total_revenue FROM fact_sales f "
    "JOIN dim_customers c ON f.customer_key = c.customer_key JOIN dim_products p ON f.product_key = p.product_key WHERE f.sales_key <= 10 ORDER BY f.sales_key",
}
_SQL_CASE = "CASE intent " + " ".join(f"WHEN {q(i)} THEN {q(s)}" for i, s in _STATEMENTS.items()) + " END"

# Columns of each intent's data and their types; a row's text is its values with a bar between them.
_SHOWN = {
    "category": [("Category", "string"), ("Revenue", "decimal(20,2)"), ("Quantity_Sold", "bigint")],
    "customer": [("Customer", "string"), ("Country", "string"), ("Tier", "string"), ("Total_Spent", "decimal(20,2)")],
    "country": [("Country", "string"), ("Orders", "bigint"), ("Revenue", "decimal(20,2)")],
    "trend": [("Year", "int"), ("Month", "int"), ("Revenue", "decimal(20,2)"), ("Profit", "decimal(20,2)")],
    "profit": [("Category", "string"), ("Revenue", "decimal(20,2)"), ("Profit", "decimal(20,2)")],
    "default": [("transaction_id", "string"), ("customer_name", "string"), ("product_name", "string"), ("category", "string"), ("total_revenue", "decimal(20,2)")],
}


def _line(columns):
    return lambda row: F.concat_ws("|", *[F.try_variant_get(row, f"$.{c}", t).cast("string") for c, t in columns])


def _data_text(data):
    """The rows of a record's data as text lines, read from the VARIANT with the columns of its intent."""
    rows = F.try_variant_get(data, "$", "array<variant>")
    out = F.lit(None).cast("string")
    for name, columns in _SHOWN.items():
        out = F.when(F.col("intent") == name, F.array_join(F.transform(rows, _line(columns)), "\n")).otherwise(out)
    return out


def _money_sql(x: str) -> str:
    return f"CAST({R2(x)} AS DECIMAL(20,2))"


_REV, _PROFIT = _money_sql("SUM(f.total_revenue)"), _money_sql("SUM(f.total_profit)")
_JOINED = {t: f"g_fact f JOIN g_dim_{t} d ON f.{k} = d.{k}" for t, k in (("products", "product_key"), ("customers", "customer_key"), ("time", "time_key"))}
_DATA_CTES = f"""
data_rows AS (
  SELECT 'category' AS intent, row_number() OVER (ORDER BY rev DESC, category) AS n, concat_ws('|', category, rev, units) AS line
  FROM (SELECT d.category, {_REV} AS rev, SUM(f.quantity) AS units FROM {_JOINED['products']} GROUP BY d.category)
  UNION ALL SELECT 'customer', row_number() OVER (ORDER BY rev DESC, customer_key), concat_ws('|', customer_name, country, membership_tier, rev)
  FROM (SELECT d.customer_key, d.customer_name, d.country, d.membership_tier, {_REV} AS rev FROM {_JOINED['customers']}
        GROUP BY ALL ORDER BY rev DESC, customer_key LIMIT 10)
  UNION ALL SELECT 'country', row_number() OVER (ORDER BY rev DESC, country), concat_ws('|', country, n, rev)
  FROM (SELECT d.country, COUNT(*) AS n, {_REV} AS rev FROM {_JOINED['customers']} GROUP BY d.country)
  UNION ALL SELECT 'trend', row_number() OVER (ORDER BY year DESC, month DESC), concat_ws('|', year, month, rev, profit)
  FROM (SELECT d.year, d.month, {_REV} AS rev, {_PROFIT} AS profit FROM {_JOINED['time']} GROUP BY d.year, d.month ORDER BY year DESC, month DESC LIMIT 12)
  UNION ALL SELECT 'profit', row_number() OVER (ORDER BY profit DESC, category), concat_ws('|', category, rev, profit)
  FROM (SELECT d.category, {_REV} AS rev, {_PROFIT} AS profit FROM {_JOINED['products']} GROUP BY d.category)
  UNION ALL SELECT 'default', f.sales_key, concat_ws('|', f.transaction_id, c.customer_name, p.product_name, p.category, {_money_sql('f.total_revenue')})
  FROM g_fact f JOIN g_dim_customers c ON f.customer_key = c.customer_key JOIN g_dim_products p ON f.product_key = p.product_key WHERE f.sales_key <= 10),
data_texts AS (SELECT intent, string_agg(line, chr(10) ORDER BY n) AS data FROM data_rows GROUP BY intent),
qs AS ({_text_source_sql(testmap.QUESTION_TEMPLATES)}),
routed AS (SELECT src, k1, k2, text AS question, {_INTENT_CASE} AS intent FROM (SELECT *, lower(text) AS p FROM qs))"""


def _records(questions, found):
    """Records with their data as text: rendered once for each intent, before the questions are joined."""
    shown = found.select("intent", "sql", "success", _data_text(F.col("data")).alias("data"), "error")
    routed = guard.with_intent(questions, "text").withColumnRenamed("text", "question")
    return assistant.with_answers(routed, shown)


register("answer_records", with_pipeline(f"""
SELECT src, k1, k2, question, r.intent, {_SQL_CASE.replace('intent', 'r.intent', 1)} AS sql, TRUE AS success, d.data, NULL::VARCHAR AS error
FROM routed r LEFT JOIN data_texts d ON r.intent = d.intent""", extra_ctes=_DATA_CTES))(
    lambda spark, sf_dir: _records(testmap.questions(spark, sf_dir), assistant.answers(spark, gold_tables(spark, sf_dir)))
)


def _broken(spark, sf_dir):
    """The warehouse with a calendar that lacks its months (a fault while planning) and products whose category can't be read (one while running)."""
    t = gold_tables(spark, sf_dir)
    unreadable = F.when(F.col("product_key").isNotNull(), F.raise_error(F.lit("unreadable category"))).cast("string")
    return {**t, "dim_time": t["dim_time"].drop("month"), "dim_products": t["dim_products"].withColumn("category", unreadable)}


def _failures(spark, sf_dir):
    records = _records(testmap.questions(spark, sf_dir), assistant.answers(spark, _broken(spark, sf_dir)))
    return records.select("src", "k1", "k2", "intent", "success", "data", F.regexp_extract("error", "^\\[([A-Z_]+)", 1).alias("error_class"))


register("answer_failures", with_pipeline(f"""
SELECT src, k1, k2, r.intent, r.intent IN ('customer', 'country') AS success,
       CASE WHEN r.intent IN ('customer', 'country') THEN d.data END AS data,
       CASE WHEN r.intent = 'trend' THEN 'UNRESOLVED_COLUMN' WHEN r.intent NOT IN ('customer', 'country') THEN 'USER_RAISED_EXCEPTION' END AS error_class
FROM routed r LEFT JOIN data_texts d ON r.intent = d.intent""", extra_ctes=_DATA_CTES))(_failures)

_FENCE = f"(?s){guard.FENCE_OPEN}{WS}*(.*?){WS}*{guard.FENCE_CLOSE}"
register("extract_sql_block", f"""
WITH rp AS ({_text_source_sql(testmap.REPLY_TEMPLATES)}),
c AS (SELECT src, k1, k2, {STRIP('text')} AS c FROM rp),
p AS (SELECT src, k1, k2, CASE WHEN regexp_matches(c, {q(_FENCE)}) THEN {STRIP(f"regexp_extract(c, {q(_FENCE)}, 1)")} ELSE c END AS picked FROM c)
SELECT src, k1, k2, {STRIP(f"regexp_replace(picked, {q(guard.FENCE_OPEN + '|' + guard.FENCE_CLOSE)}, '', 'g')")} AS sql FROM p""")(
    lambda spark, sf_dir: testmap.replies(spark, sf_dir).select(
        "src", "k1", "k2", guard.extract_sql_block(F.col("text")).alias("sql")
    )
)

SANDBOX_DEFAULT_SQL = (
    "SELECT f.*, p.product_name, p.category, p.unit_price AS product_unit_price, p.unit_cost "
    "FROM Fact_Sales f JOIN Dim_Products p ON f.product_key = p.product_key WHERE f.sales_key <= 10 ORDER BY f.sales_key"
)


def _sandbox_default(spark, sf_dir):
    res = assistant.run_sandbox(spark, gold_tables(spark, sf_dir), SANDBOX_DEFAULT_SQL)
    if not res.success:
        raise RuntimeError(res.error)
    return res.data


register("sandbox_default", with_pipeline(
    SANDBOX_DEFAULT_SQL.replace("Fact_Sales", "g_fact").replace("Dim_Products", "g_dim_products")
))(_sandbox_default)
