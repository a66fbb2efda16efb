"""Mapping of the driver's TPC-H-like tables onto the retail inputs.

The test tables have no nulls, orphans or unmatched countries, so those paths
are derived on purpose, without dropping any row:

* customers of nations 20..24 carry a country suffixed "-CLOSED": no ledger
  country matches it, so their nations' ledger rows find no customer and are
  pruned (the orphan path);
* stores outside nations 0..14 (except supplier 0, store 1, the default store)
  carry their country in lower case: store countries are not cleaned, so it
  never matches the title-cased ledger country and those sales fall back to
  store 1;
* a quantity of exactly 7 becomes NULL in the ledger (the fill-default path),
  and so do the dates, prices, products and countries of some orders;
* some customers and products appear twice, with the copy before or after the
  original in source order (the keep-first path);
* the orders extract repeats names and e-mail bases on purpose.

Every customer, supplier, part, order and lineitem row flows into the inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.functions.numeric import half_even_round
from lakestar.functions.text import title_case
from lakestar.operators.lookup import broadcast_if_small
from lakestar.session import concurrently, shuffles_deleted

# ---------------------------------------------------------------------------
# Fixed values of the test mapping.
CUSTOMER_NATIONS_BELOW = 20
CLOSED_SUFFIX = "-CLOSED"
STORE_NATIONS_BELOW = 15
DEFAULT_STORE_SUPPLIER = 0
NULL_QUANTITY = 7.0
SEGMENT_TIERS = {
    "AUTOMOBILE": "Platinum",
    "BUILDING": "Gold",
    "FURNITURE": "Silver",
    "HOUSEHOLD": "Bronze",
    "MACHINERY": "Gold",
}
EXTRACT_SEGMENTS = ["Corporate", "Consumer", "Home Office", "Other"]
# Columns giving the ledger its row order (unique at every scale factor).
LEDGER_ORDER = {
    "l_orderkey": "long",
    "l_linenumber": "int",
    "l_partkey": "long",
    "l_suppkey": "long",
    "l_extendedprice": "double",
}
EXTRACT_POSITION = "Row ID"
# Row order of the registry and the catalogue; keys that appear twice.
SOURCE_ORDER = {"row_no": "long"}
TWICE_EVERY, TWICE_CUSTOMER, TWICE_PRODUCT = 25, 3, 7
COPY_SUFFIX = " (copy)"
# Orders whose ledger rows lack a field: (modulus, remainder) of the order key.
NULL_DATE = (97, 5)
NULL_PRICE = (89, 7)
NULL_PRODUCT = (83, 11)
NULL_COUNTRY = (79, 13)
# Ledger rows of the second landing whose date is written otherwise, or can't be read: order key modulo the first.
DATE_FORMS = 13
DATE_SLASHED, DATE_NO_SUCH_DAY, DATE_TEXT = 1, 2, 3
NO_SUCH_DAY = "2024-13-45"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a reference table (nation, region) after checking its size."""
    return broadcast_if_small(df, 100_000)[0]


def _tier(segment):
    m = F.create_map(*[F.lit(x) for kv in SEGMENT_TIERS.items() for x in kv])
    return F.element_at(m, segment)


def _twice(df: DataFrame, key: str, remainder: int, copied: dict) -> DataFrame:
    """The rows with ``row_no``, and a changed copy of some: after the original
    for even keys, before it for odd ones."""
    k = F.col(key)
    copies = df.where(k % TWICE_EVERY == remainder).withColumns(copied)
    return df.withColumn("row_no", 2 * k + 1).unionByName(copies.withColumn("row_no", F.when(k % 2 == 0, 2 * k + 2).otherwise(2 * k)))


def _unless(rule: tuple[int, int], value):
    return F.when(F.col("l_orderkey") % rule[0] != rule[1], value)


def registry_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    open_nation = F.col("c_nationkey") < CUSTOMER_NATIONS_BELOW
    return c.join(_small(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").cast("long").alias("customer_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("customer_name"),
        F.concat(F.upper(F.col("c_name")), F.lit("@X.COM")).alias("email"),
        F.when(open_nation, F.col("n_name")).otherwise(F.concat(F.col("n_name"), F.lit(CLOSED_SUFFIX))).alias("country"),
        _tier(F.col("c_mktsegment")).alias("membership_tier"),
    ).transform(lambda df: _twice(df, "customer_id", TWICE_CUSTOMER, {"customer_name": F.concat("customer_name", F.lit(COPY_SUFFIX))}))


def registry_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(_small(r), n.n_regionkey == r.r_regionkey)
    matched = (F.col("s_nationkey") < STORE_NATIONS_BELOW) | (F.col("s_suppkey") == DEFAULT_STORE_SUPPLIER)
    return s.join(_small(geo), s.s_nationkey == geo.n_nationkey).select(
        (F.col("s_suppkey") + 1).cast("long").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.when(matched, title_case(F.col("n_name"))).otherwise(F.lower(F.col("n_name"))).alias("country"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        (F.col("p_partkey") + 1).cast("long").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("p_type").alias("category"),
    ).transform(lambda df: _twice(df, "id", TWICE_PRODUCT, {"title": F.concat("title", F.lit(COPY_SUFFIX)), "price": F.col("price") + 1}))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per lineitem row (shuffle joins on the order and part
    keys; nation is broadcast after a size check)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    order_country = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(_small(n), F.col("c_nationkey") == n.n_nationkey)
        .select("o_orderkey", "o_orderdate", "n_name")
    )
    rows = li.join(order_country, li.l_orderkey == order_country.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return rows.select(
        _unless(NULL_DATE, F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")).alias("Date"),
        _unless(NULL_COUNTRY, F.col("n_name")).alias("Country"),
        _unless(NULL_PRODUCT, F.col("p_name")).alias("Product"),
        F.when(F.col("l_quantity") != F.lit(NULL_QUANTITY), F.col("l_quantity")).alias("Order_Quantity"),
        _unless(NULL_PRICE, half_even_round(F.col("l_extendedprice") / F.col("l_quantity"))).alias("Unit_Price"),
        *[F.col(k).cast(t).alias(k) for k, t in LEDGER_ORDER.items()],
    )


def dated_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with some dates in another form and some that no calendar has."""
    day, k = F.to_date("Date"), F.col("l_orderkey") % DATE_FORMS
    written = (
        F.when(F.col("Date").isNull(), F.lit(None).cast("string"))
        .when(k == DATE_SLASHED, F.date_format(day, "M/d/yyyy"))
        .when(k == DATE_NO_SUCH_DAY, F.lit(NO_SUCH_DAY))
        .when(k == DATE_TEXT, F.concat(F.lit("on order "), F.col("l_orderkey")))
        .otherwise(F.col("Date"))
    )
    return ledger(spark, sf_dir).withColumn("Date", written)


#: Objects of one array of the catalogue's payload.
ARRAY_OBJECTS = 1000


def write_catalogue_arrays(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The catalogue as files that each hold one array of objects, with further fields, as an API pages it."""
    items = catalogue(spark, sf_dir).withColumn("rating", F.struct(F.lit(4.5).alias("rate"), F.col("id").alias("count")))
    page = F.floor(F.col("id") / ARRAY_OBJECTS).cast("int")
    arrays = items.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(F.struct(*items.columns))).alias("value"))
    pages = (items.agg(F.max(page)).first()[0] or 0) + 1
    arrays.repartitionById(pages, "page").select("value").write.mode("overwrite").text(path)


def write_second_landing(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Ledger and catalogue in other forms than in the landing zone; text as the sources write it."""
    paths = {"ledger": f"{root}/ledger_dated", "catalogue": f"{root}/catalogue_arrays"}
    columns = ["Product", "Unit_Price", "Date", *LEDGER_ORDER, "Country", "Order_Quantity"]
    with shuffles_deleted(spark):
        dated_ledger(spark, sf_dir).select(*columns).write.mode("overwrite").option("header", True).csv(paths["ledger"])
        write_catalogue_arrays(spark, sf_dir, paths["catalogue"])
    return paths


def orders_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(_small(r), n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    segments = F.array(*[F.lit(s) for s in EXTRACT_SEGMENTS])
    return c.join(_small(geo), c.c_nationkey == geo.n_nationkey).select(
        k.cast("long").alias(EXTRACT_POSITION),
        F.concat(F.lit("Ab "), (k % 7).cast("string"), F.lit(" Cd"), (k % 100).cast("string")).alias("Customer Name"),
        F.element_at(segments, (k % len(EXTRACT_SEGMENTS) + 1).cast("int")).alias("Customer Segment"),
        F.concat(F.col("n_name"), F.lit("-"), (k % 5).cast("string")).alias("City"),
        F.col("r_name").alias("State"),
    )


# ---------------------------------------------------------------------------
# Product texts that a CSV has to quote, texts of numbers that
# stand for a missing one.
QUOTED_PRODUCTS = ['Bolt 1/4" wide {k}', 'Say "hi, you" {k}', "a,b {k}", '"{k}"', "NA", "two\nlines {k}", "O'Neil; {k}", "n/a", "plain {k}"]
MISSING_NUMBERS = ["NA", "N/A", "null", "nan", "1.5", "2"]
# ---------------------------------------------------------------------------


def quoted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of text fields, one row for each part, as people export it."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    number = F.element_at(F.array(*[F.lit(x) for x in MISSING_NUMBERS]), (k % len(MISSING_NUMBERS) + 1).cast("int"))
    product = F.element_at(F.array(*[F.lit(x) for x in QUOTED_PRODUCTS]), (k % len(QUOTED_PRODUCTS) + 1).cast("int"))
    return p.select(
        k.cast("string").alias("p_partkey"),
        F.when(k % 4 == 0, "NaN").otherwise("2024-02-03").alias("Date"),
        F.col("p_type").alias("Country"),
        F.replace(product, F.lit("{k}"), k.cast("string")).alias("Product"),
        number.alias("Order_Quantity"),
        F.when(k % 3 == 0, number).alias("Unit_Price"),
    )


def chained_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract in groups of five customers: the second has the address of
    the first, the third that which the second gets, the fourth that which the
    third gets; the fifth has its own."""
    k = F.col("c_custkey").cast("long")
    g, p1, p2 = F.floor(k / 5).cast("long"), F.floor(k / 5).cast("long") * 5 + 1, F.floor(k / 5).cast("long") * 5 + 2
    name = (
        F.when(k % 5 == 0, F.concat(F.lit("G"), g, F.lit(" Lee")))
        .when(k % 5 == 1, F.concat(F.lit("G"), g, F.lit("  Lee")))
        .when(k % 5 == 2, F.concat(F.lit("G"), g, F.lit(" Lee"), p1))
        .when(k % 5 == 3, F.concat(F.lit("G"), g, F.lit(" Lee"), p1, p2))
        .otherwise(F.concat(F.lit("G"), g, F.lit(" Other")))
    )
    return table(spark, sf_dir, "customer").select(k.alias("pos"), name.alias("Customer Name"), F.lit(None).cast("string").alias("Customer Segment"))


# ---------------------------------------------------------------------------
# Question, statement and reply templates for the text
# operators. "{k}" is replaced by the order key.
QUESTION_TEMPLATES = [
    "Sales for each category next to order {k}",
    "Which customer stands behind order {k}?",
    "Sales per month up to order {k}",
    "Compare all countries by turnover, order {k}",
    "Is the margin of order {k} above its category?",
    "Totals by customer and category for {k}",
    "What was the profit margin on order {k}?",
    "Revenue by REGION for order {k}",
    "How much did the top spender buy in {k}?",
    "List the CATEGORIES of order {k}",
    "yearly totals up to {k}",
    "Where is location {k}?",
    "order {k} details",
]
STATEMENT_TEMPLATES = [
    "SELECT * FROM Fact_Sales WHERE sales_key = {k}",
    "  select transaction_id from fact_sales where sales_key = {k}  ",
    "DELETE FROM Fact_Sales WHERE sales_key = {k}",
    "drop table dim_time",
    "UPDATE Dim_Products SET unit_price = {k}",
    "WITH t AS (SELECT {k} AS x) SELECT x FROM t",
    "SELECT updated_at FROM audit WHERE id = {k}",
    "SELECT replace(product_name, 'a', 'b') FROM dim_products",
    "SELECT 'DROP' AS word, {k} AS n",
    "-- report {k}\nSELECT 1",
    "SELECTED {k}",
    "SELECT 1; SELECT {k}",
    "\tSELECT java_method('java.lang.Math', 'abs', -{k})",
    "SELECT TRANSFORM(sales_key) USING 'cat' FROM fact_sales",
    "SELECT * FROM parquet.`/data/x{k}`",
    "INSERT INTO dim_time VALUES ({k})",
    "pragma table_info(fact_sales)",
    "GRANT ALL ON fact_sales TO u{k}",
    "ALTER TABLE t ADD c{k} INT",
    "\u00a0SELECT {k}",
    "CREATE TABLE t{k} AS SELECT 1",
    "select count(*) from dim_customers_{k}_truncate",
]
REPLY_TEMPLATES = [
    "Here is the query:\n```sql\nSELECT category FROM dim_products -- {k}\n```\nDone.",
    "```sql SELECT {k} ```",
    "SELECT {k}",
    "```SQL\nSELECT {k}\n```",
    "```sql\n```",
    "Two: ```sql\nSELECT 1\n``` and ```sql\nSELECT {k}\n```",
    "  \n```sql\n  SELECT {k}  \n```  ",
    "```\nSELECT {k}\n```",
]
# ---------------------------------------------------------------------------


def _from_orders(spark: SparkSession, sf_dir: str, templates: list[str]) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    arr = F.array(*[F.lit(t) for t in templates])
    k = F.col("o_orderkey")
    text = F.replace(F.element_at(arr, (F.pmod(k, F.lit(len(templates))) + 1).cast("int")), F.lit("{k}"), k.cast("string"))
    return o.select(F.lit("orders").alias("src"), k.cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), text.alias("text"))


def _from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.lit("conversations").alias("src"), F.col("conv_id").cast("long").alias("k1"),
        F.col("turn").cast("long").alias("k2"), F.col("text"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_orders(spark, sf_dir, QUESTION_TEMPLATES).unionByName(_from_conversations(spark, sf_dir))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_orders(spark, sf_dir, STATEMENT_TEMPLATES).unionByName(_from_conversations(spark, sf_dir))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_orders(spark, sf_dir, REPLY_TEMPLATES).unionByName(_from_conversations(spark, sf_dir))


# Landing zone: the files the build reads, in the formats of the sources.
LANDING_PARTS = ("registry/customers", "registry/stores", "catalogue", "ledger", "ledger_quoted", "orders_extract")


def write_landing(spark: SparkSession, sf_dir: str, root: str, parts: Sequence[str] = LANDING_PARTS) -> dict[str, str]:
    """Write landing datasets (independent jobs, run concurrently)."""
    paths = {part: f"{root}/{part}" for part in parts}
    writers = {
        "registry/customers": lambda to: registry_customers(spark, sf_dir).write.mode("overwrite").parquet(to),
        "registry/stores": lambda to: registry_stores(spark, sf_dir).write.mode("overwrite").parquet(to),
        "catalogue": lambda to: catalogue(spark, sf_dir).write.mode("overwrite").json(to),
        # header order differs from the reader's column order on purpose
        "ledger": lambda to: ledger(spark, sf_dir).select("Product", "Unit_Price", "Date", *LEDGER_ORDER, "Country", "Order_Quantity")
        .write.mode("overwrite").option("header", True).csv(to),
        "ledger_quoted": lambda to: quoted_ledger(spark, sf_dir).write.mode("overwrite").option("header", True).option("escape", '"').csv(to),
        # in the order of its position, as an export would be
        "orders_extract": lambda to: orders_extract(spark, sf_dir).repartitionByRange(EXTRACT_POSITION).sortWithinPartitions(EXTRACT_POSITION)
        .write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(to),
    }
    with shuffles_deleted(spark):
        concurrently([lambda part=part, to=to: writers[part](to) for part, to in paths.items()])
    return paths
