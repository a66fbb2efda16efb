"""Conformance edge cases on a hand-made ledger, through the whole build:
null/unmatched countries, null product, fractional and missing quantities,
missing prices, default store, time-of-day dates, malformed dates."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.errors import PySparkException

from lakestar import schemas
from lakestar.plans import gold
from lakestar.plans.gold import Bronze, build
from lakestar.plans.silver import DateRule

CUSTOMERS = [(1, " ann  lee ", "ANN@X.COM ", " canada", "Gold"), (2, "bob", "b@x.com", "Canada", "Silver"),
             (3, "cy", "c@x.com", "france ", "Bronze")]
STORES = [(1, "Hub - A", "A", "S", "Canada"), (2, "Hub - B", "B", "S", "germany")]
PRODUCTS = [(1, " Widget ", 10.0, "men's clothing"), (2, "Gadget", 20.5, "toys"), (3, "Thing", 3.335, "toys")]
# row_no, Date, Country, Product, Order_Quantity, Unit_Price
LEDGER = [
    (1, "2024-01-06", "Canada", "Widget", 2.7, 10.125),
    (2, "2024-01-07", None, "Gadget", 1.0, 20.5),        # no country -> pruned
    (3, "2024-02-29", "  FRANCE ", None, None, None),    # product 'nan', qty 1, price 25, default store
    (4, "2024-03-31 10:30:00", "Germany", "Thing", 3.0, 1.115),  # no customer -> pruned (after txn id)
    (5, "2024-03-31", "canada", "Thing", 4.0, 0.125),
]


def bronze(spark, ledger=LEDGER):
    sales = spark.createDataFrame(
        [(r, d, c, p, q, u) for r, d, c, p, q, u in ledger],
        "row_no long, Date string, Country string, Product string, Order_Quantity double, Unit_Price double",
    )
    return Bronze(
        customers=spark.createDataFrame(CUSTOMERS, schemas.REGISTRY_CUSTOMERS),
        stores=spark.createDataFrame(STORES, schemas.REGISTRY_STORES),
        products=spark.createDataFrame(PRODUCTS, schemas.CATALOGUE),
        sales=sales,
        order_cols=["row_no"],
    )


def expected_fact():
    cust = {}
    for cid, _n, _e, country, _t in sorted(CUSTOMERS):
        cust.setdefault(country.strip().title(), cid)
    store = {}
    for sid, _n, _c, _s, country in sorted(STORES):
        store.setdefault(country, sid)
    rows, key = [], 0
    for i, (_r, d, c, p, q, u) in enumerate(LEDGER, start=1):
        ck = cust.get(str(c).strip().title()) if c is not None else None
        if ck is None:
            continue
        key += 1
        qty = int(1 if q is None else q)
        price = 25.0 if u is None else u
        rev = float(np.round(qty * price, 2))
        prod = int(hashlib.md5(str("nan" if p is None else p).encode()).hexdigest(), 16) % 3 + 1
        rows.append((key, f"TXN{i:06d}", ck, prod, store.get(str(c).strip().title(), 1), d[:10], qty, price, rev,
                     float(np.round(rev * 0.35, 2))))
    return rows


def test_edge_ledger_through_build(spark, tmp_path):
    res = build(spark, bronze(spark), str(tmp_path / "wh"), num_partitions=2)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{res.version_path}/fact_sales").select(*schemas.FACT_SALES).collect())
    assert got == expected_fact()
    assert res.counts["bronze_ledger"] == 5 and res.counts["pruned_rows"] == 2 and res.counts["no_customer"] == 2
    assert res.counts["filled_quantity"] == 1 and res.counts["filled_price"] == 1
    dims = {r.customer_key: r for r in spark.read.parquet(f"{res.version_path}/dim_customers").collect()}
    assert dims[1].customer_name == "Ann  Lee" and dims[1].email == "ann@x.com" and dims[1].country == "Canada"
    cats = {r.product_key: (r.product_name, r.category, r.unit_cost)
            for r in spark.read.parquet(f"{res.version_path}/dim_products").collect()}
    assert cats[1] == ("Widget", "Men'S Clothing", float(np.round(10.0 * 0.65, 2)))
    assert cats[3][2] == float(np.round(3.335 * 0.65, 2))
    cal = {r.time_key: r for r in spark.read.parquet(f"{res.version_path}/dim_time").collect()}
    # the calendar holds every ledger date, pruned rows included
    assert sorted(cal) == ["2024-01-06", "2024-01-07", "2024-02-29", "2024-03-31"]
    assert cal["2024-01-06"].is_weekend and cal["2024-01-06"].day_of_week == "Saturday"
    assert not cal["2024-02-29"].is_weekend and cal["2024-03-31"].quarter == 1


def test_malformed_date_fails_the_build(spark, tmp_path):
    bad = LEDGER + [(6, "31/12/2024", "Canada", "Widget", 1.0, 1.0)]
    with pytest.raises(PySparkException, match="31/12/2024"):
        build(spark, bronze(spark, bad), str(tmp_path / "wh"), num_partitions=2)


def test_month_first_dates_and_own_formats(spark, tmp_path):
    rows = [(1, "01/05/2024", "Canada", "Widget", 1.0, 1.0), (2, "2024-02-01", "Canada", "Widget", 1.0, 1.0), (3, None, "Canada", "Widget", 1.0, 1.0)]
    res = build(spark, bronze(spark, rows), str(tmp_path / "wh"), num_partitions=1)
    got = [r.time_key for r in gold.open_tables(spark, res.version_path)["fact_sales"].orderBy("sales_key").collect()]
    assert got == ["2024-01-05", "2024-02-01"] and res.counts["no_date"] == 1
    german = replace(bronze(spark, [(1, "31.12.2024", "Canada", "Widget", 1.0, 1.0)]), dates=DateRule(("d.M.yyyy",)))
    res = build(spark, german, str(tmp_path / "wh2"), num_partitions=1)
    assert gold.open_tables(spark, res.version_path)["fact_sales"].first().time_key == "2024-12-31"


def test_quarantine_sets_rows_aside_and_counts_them(spark, tmp_path):
    rows = LEDGER + [(6, "31/12/2024", "Canada", "Widget", 1.0, 1.0), (7, "soon", "Canada", "Widget", 2.0, 1.0), (8, None, "Canada", "Widget", 2.0, 1.0)]
    res = build(spark, replace(bronze(spark, rows), dates=DateRule(quarantine=True)), str(tmp_path / "wh"), num_partitions=2)
    aside = spark.read.parquet(f"{res.version_path}/_quarantine").orderBy("ledger_row").collect()
    assert [(r.ledger_row, r.date_text, r.quantity) for r in aside] == [(6, "31/12/2024", 1), (7, "soon", 2)]
    assert res.counts["quarantined"] == 2 and res.counts["no_date"] == 3 and res.counts["bronze_ledger"] == 8
    assert sorted(tuple(r) for r in gold.open_tables(spark, res.version_path)["fact_sales"].collect()) == expected_fact()


def test_first_row_of_a_key_by_source_order(spark, tmp_path):
    twice = spark.createDataFrame([(2, 1, "Alpha", "a@x", "Canada", "Gold"), (1, 1, "Zeta", "z@x", "France", "Gold")],
                                  "row_no long, customer_id long, customer_name string, email string, country string, membership_tier string")
    prices = spark.createDataFrame([(5, 1, "B", 2.0, "c"), (4, 1, "C", 9.0, "c")], "row_no long, id long, title string, price double, category string")
    b = replace(bronze(spark, LEDGER[:1]), customers=twice, products=prices, customer_order=["row_no"], product_order=["row_no"])
    res = build(spark, b, str(tmp_path / "wh"), num_partitions=1)
    t = gold.open_tables(spark, res.version_path)
    assert t["dim_customers"].first().customer_name == "Zeta" and t["dim_products"].first().unit_price == 9.0
