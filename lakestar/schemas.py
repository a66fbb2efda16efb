"""Fixed schemas of the bronze inputs and gold tables (no schema inference)."""

from pyspark.sql import types as T

REGISTRY_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("membership_tier", T.StringType()),
])

REGISTRY_STORES = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
])

CATALOGUE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("category", T.StringType()),
])

# ledger columns and the types they are cast to after a by-name CSV read
LEDGER_COLUMNS = {
    "Date": "string",
    "Country": "string",
    "Product": "string",
    "Order_Quantity": "double",
    "Unit_Price": "double",
}

ORDERS_EXTRACT_COLUMNS = {
    "Customer Name": "string",
    "Customer Segment": "string",
    "City": "string",
    "State": "string",
}

# extract columns that may be absent
OPTIONAL_EXTRACT_COLUMNS = ["Customer Segment"]

DIM_CUSTOMERS = ["customer_key", "customer_name", "email", "country", "membership_tier"]
DIM_PRODUCTS = ["product_key", "product_name", "category", "unit_price", "unit_cost"]
DIM_STORES = ["store_key", "store_name", "city", "state", "country"]
DIM_TIME = ["time_key", "day", "month", "year", "quarter", "day_of_week", "is_weekend"]
FACT_SALES = [
    "sales_key", "transaction_id", "customer_key", "product_key", "store_key", "time_key",
    "quantity", "unit_price", "total_revenue", "total_profit",
]

# gold tables: primary key and NOT NULL columns
GOLD_KEYS = {
    "dim_customers": "customer_key",
    "dim_products": "product_key",
    "dim_stores": "store_key",
    "dim_time": "time_key",
    "fact_sales": "sales_key",
}
GOLD_COLUMNS = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "dim_stores": DIM_STORES,
    "dim_time": DIM_TIME,
    "fact_sales": FACT_SALES,
}
FACT_FOREIGN_KEYS = [
    ("customer_key", "dim_customers"),
    ("product_key", "dim_products"),
    ("store_key", "dim_stores"),
    ("time_key", "dim_time"),
]


GOLD_SCHEMAS = {
    "dim_customers": T.StructType([
        T.StructField("customer_key", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("membership_tier", T.StringType()),
    ]),
    "dim_products": T.StructType([
        T.StructField("product_key", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("unit_cost", T.DoubleType()),
    ]),
    "dim_stores": T.StructType([
        T.StructField("store_key", T.LongType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
    ]),
    "dim_time": T.StructType([
        T.StructField("time_key", T.StringType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
    ]),
    "fact_sales": T.StructType([
        T.StructField("sales_key", T.LongType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_key", T.LongType()),
        T.StructField("product_key", T.LongType()),
        T.StructField("store_key", T.LongType()),
        T.StructField("time_key", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("total_profit", T.DoubleType()),
    ]),
}
