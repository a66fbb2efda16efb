"""DuckDB SQL for every registered query: the whole pipeline (test mapping,
silver, gold numbering) re-expressed as CTEs over the driver's tables,
followed by each query's own SELECT. Independent of the Spark code path; only
the fixed values (keywords, mappings, ratios) are shared."""

from __future__ import annotations

from lakestar.functions.text import TITLE_EXCEPTIONS
from lakestar.plans import silver
from lakestar.sources import testmap

WS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def TITLE(x: str) -> str:
    """Python str.title(). RE2 has no Lowercase/Uppercase properties, so cased
    means Lu/Ll/Lt here (the Spark expression also counts Other_Lowercase
    characters such as "º"; the test texts contain none)."""
    cased = "\\p{Lu}\\p{Ll}\\p{Lt}"
    first = "CASE w[1] " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in TITLE_EXCEPTIONS.items()) + " ELSE upper(w[1]) END"
    return (
        f"CASE WHEN ({x}) IS NULL THEN NULL ELSE array_to_string(list_transform("
        f"regexp_extract_all({x}, '[{cased}]+|[^{cased}]+'), lambda w: {first} || lower(w[2:])), '') END"
    )


def HE2(x: str) -> str:
    """pandas/numpy round(2): half to even on x*100."""
    return f"(round_even(({x}) * 100.0::DOUBLE, 0) / 100.0::DOUBLE)"


def R2(x: str, d: int = 2) -> str:
    """SQLite ROUND(x, d): shortest decimal form, half away from zero."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def STABLE_KEY(x: str, n: str) -> str:
    acc = "0::BIGINT"
    for i in range(4):
        chunk = f"('0x' || substr(md5({x}), {1 + 8 * i}, 8))::BIGINT"
        acc = f"(({acc}) * 4294967296 + {chunk}) % ({n})"
    return f"(({acc}) + 1)"


def _tier_case(col: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in testmap.SEGMENT_TIERS.items())
    return f"CASE {col} {whens} END"


def _unless(rule: tuple[int, int], value: str) -> str:
    return f"CASE WHEN l.l_orderkey % {rule[0]} <> {rule[1]} THEN {value} END"


def _twice(once: str, key: str, remainder: int, changed: str) -> str:
    """All rows with row_no, and copies of some before or after their originals."""
    return (
        f"SELECT *, 2 * {key} + 1 AS row_no FROM {once} UNION ALL BY NAME "
        f"SELECT * REPLACE ({changed}), CASE WHEN {key} % 2 = 0 THEN 2 * {key} + 2 ELSE 2 * {key} END AS row_no "
        f"FROM {once} WHERE {key} % {testmap.TWICE_EVERY} = {remainder}"
    )


_ORDER = ", ".join(testmap.LEDGER_ORDER)


_DATE = _unless(testmap.NULL_DATE, "strftime(o.o_orderdate, '%Y-%m-%d')")
_DATED = (
    f"CASE WHEN {_DATE} IS NULL THEN NULL ELSE CASE l.l_orderkey % 13 WHEN 1 THEN strftime(o.o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN '2024-13-45' "
    f"WHEN 3 THEN 'on order ' || l.l_orderkey ELSE {_DATE} END END"
)
_READ_DATE = 'CAST("Date" AS DATE)'
_READ_DATED = """coalesce(TRY_CAST("Date" AS DATE), TRY_CAST(try_strptime("Date", '%m/%d/%Y') AS DATE))"""


def pipeline_ctes(dated: bool = False) -> str:
    """``dated``: over the ledger of the second landing, whose unreadable dates are null dates."""
    return f"""
bz_customers_once AS (
  SELECT c.c_custkey::BIGINT AS customer_id, '  ' || c.c_name || ' ' AS customer_name,
         upper(c.c_name) || '@X.COM' AS email,
         CASE WHEN c.c_nationkey < {testmap.CUSTOMER_NATIONS_BELOW} THEN n.n_name
              ELSE n.n_name || {q(testmap.CLOSED_SUFFIX)} END AS country,
         {_tier_case('c.c_mktsegment')} AS membership_tier
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
bz_customers AS ({_twice('bz_customers_once', 'customer_id', testmap.TWICE_CUSTOMER, f"customer_name || {q(testmap.COPY_SUFFIX)} AS customer_name")}),
bz_stores AS (
  SELECT (s.s_suppkey + 1)::BIGINT AS store_id, s.s_name AS store_name, n.n_name AS city,
         r.r_name AS state,
         CASE WHEN s.s_nationkey < {testmap.STORE_NATIONS_BELOW} OR s.s_suppkey = {testmap.DEFAULT_STORE_SUPPLIER}
              THEN {TITLE('n.n_name')} ELSE lower(n.n_name) END AS country
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
bz_products_once AS (
  SELECT (p_partkey + 1)::BIGINT AS id, p_name AS title, p_retailprice::DOUBLE AS price, p_type AS category FROM part),
bz_products AS ({_twice('bz_products_once', 'id', testmap.TWICE_PRODUCT, f"title || {q(testmap.COPY_SUFFIX)} AS title, price + 1 AS price")}),
bz_sales AS (
  SELECT {_DATED if dated else _DATE} AS "Date", {_unless(testmap.NULL_COUNTRY, 'n.n_name')} AS "Country",
         {_unless(testmap.NULL_PRODUCT, 'p.p_name')} AS "Product",
         CASE WHEN l.l_quantity <> {testmap.NULL_QUANTITY} THEN l.l_quantity END AS "Order_Quantity",
         {_unless(testmap.NULL_PRICE, HE2('l.l_extendedprice / l.l_quantity'))} AS "Unit_Price",
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey),
g_dim_customers AS (
  SELECT customer_id AS customer_key, {TITLE(STRIP('customer_name'))} AS customer_name,
         lower({STRIP('email')}) AS email, {TITLE(STRIP('country'))} AS country, membership_tier
  FROM bz_customers
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_no) = 1),
g_dim_products AS (
  SELECT id AS product_key, {STRIP('title')} AS product_name, {TITLE(STRIP('category'))} AS category,
         price AS unit_price, {HE2(f'price * {silver.UNIT_COST_RATIO}::DOUBLE')} AS unit_cost
  FROM bz_products
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_no) = 1),
g_dim_stores AS (
  SELECT store_id AS store_key, store_name, city, state, country FROM bz_stores),
g_ledger AS (
  SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS seq, {_READ_DATED if dated else _READ_DATE} AS d,
         {TITLE(STRIP('"Country"'))} AS ctry
  FROM bz_sales),
g_dim_time AS (
  SELECT strftime(d, '%Y-%m-%d') AS time_key, day(d)::INTEGER AS day, month(d)::INTEGER AS month,
         year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, dayname(d) AS day_of_week,
         isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT d FROM g_ledger WHERE d IS NOT NULL)),
g_cust_lookup AS (SELECT country, min(customer_key) AS customer_key FROM g_dim_customers GROUP BY country),
g_store_lookup AS (SELECT country, min(store_key) AS store_key FROM g_dim_stores GROUP BY country),
g_conformed AS (
  SELECT l.seq, cl.customer_key,
         {STABLE_KEY(f"coalesce(l.\"Product\", {q(silver.NULL_PRODUCT_TEXT)})", '(SELECT greatest(count(*), 1) FROM g_dim_products)')} AS product_key,
         coalesce(sl.store_key, {silver.DEFAULT_STORE_KEY})::BIGINT AS store_key,
         strftime(l.d, '%Y-%m-%d') AS time_key,
         CAST(trunc(coalesce(l."Order_Quantity", {silver.DEFAULT_QUANTITY}::DOUBLE)) AS BIGINT) AS quantity,
         coalesce(l."Unit_Price", {silver.DEFAULT_UNIT_PRICE}::DOUBLE) AS unit_price,
         l."Order_Quantity" IS NULL AS filled_quantity, l."Unit_Price" IS NULL AS filled_price,
         sl.store_key IS NULL AS default_store
  FROM g_ledger l LEFT JOIN g_cust_lookup cl ON l.ctry = cl.country
  LEFT JOIN g_store_lookup sl ON l.ctry = sl.country),
g_measured AS (
  SELECT *, {HE2('quantity * unit_price')} AS total_revenue FROM g_conformed),
g_all AS (
  SELECT *, {HE2(f'total_revenue * {silver.PROFIT_RATIO}::DOUBLE')} AS total_profit,
         printf('TXN%06d', seq) AS transaction_id FROM g_measured),
g_fact AS (
  SELECT row_number() OVER (ORDER BY seq) AS sales_key, transaction_id, customer_key, product_key, store_key,
         time_key, quantity, unit_price, total_revenue, total_profit
  FROM g_all WHERE customer_key IS NOT NULL AND time_key IS NOT NULL)"""


def with_pipeline(select: str, extra_ctes: str = "", dated: bool = False) -> str:
    """The pipeline CTEs (plus ``extra_ctes``, comma-separated CTE text)
    followed by ``select``."""
    extra = f",\n{extra_ctes.strip()}" if extra_ctes.strip() else ""
    return f"WITH {pipeline_ctes(dated)}{extra}\n{select}"
