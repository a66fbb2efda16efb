"""A warehouse version as catalog tables: listing, statistics, pruning, switching."""

import re
import shutil
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.plans import assistant, gold as gold_plan, intents, marts, published


@pytest.fixture(scope="module")
def database(spark, gold):
    published.publish(spark, gold.version_path, "shown")
    yield "shown"
    spark.sql("DROP DATABASE IF EXISTS shown CASCADE")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def _cost_based(spark):
    on = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")
    before = {k: spark.conf.get(k, "false") for k in on}
    try:
        for k in on:
            spark.conf.set(k, "true")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_another_session_sees_the_tables(spark, gold, database):
    other = spark.newSession()
    names = {t.name for t in other.catalog.listTables(database) if not t.name.startswith("_")}
    assert names == set(schemas.GOLD_COLUMNS)
    assert other.table(f"{database}.fact_sales").columns == schemas.FACT_SALES
    counts = {r.table_name: r.rows for r in published.list_tables(other, database).collect()}
    assert counts == {t: gold.counts[t] for t in schemas.GOLD_COLUMNS}


def test_temporary_views_are_not_listed(spark, gold, database):
    """The sandbox leaves views of the tables' names in its session."""
    gold.tables(spark)["dim_stores"].createOrReplaceTempView("dim_stores")
    spark.range(1).createOrReplaceTempView("not_of_the_warehouse")
    try:
        rows = published.list_tables(spark, database).collect()
    finally:
        spark.catalog.dropTempView("dim_stores")
        spark.catalog.dropTempView("not_of_the_warehouse")
    assert sorted(r.table_name for r in rows) == sorted(schemas.GOLD_COLUMNS)
    assert {r.table_name: r.rows for r in rows} == {t: gold.counts[t] for t in schemas.GOLD_COLUMNS}


def test_statistics_reach_the_optimizer(spark, gold, database):
    with _cost_based(spark):
        explained = spark.sql(f"EXPLAIN COST SELECT * FROM {database}.dim_customers").first()[0]
    rows = re.search(r"rowCount=([0-9.E+]+)", explained.split("== Physical Plan ==")[0])
    assert abs(float(rows[1]) - gold.counts["dim_customers"]) <= 0.01 * gold.counts["dim_customers"]
    version = gold.version_path.rsplit("/", 1)[-1].replace("-", "_")
    rows = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {database}._fact_sales__{version} customer_key").collect()}
    assert int(rows["distinct_count"]) > 1 and rows["num_nulls"] == "0"


def test_cost_based_join_order(spark, gold, database):
    """Written fact first and the selective dimension last; the optimizer joins the selective one first."""
    sql = f"""SELECT count(*) FROM {database}._fact_by_month f
              JOIN {database}.dim_customers c ON f.customer_key = c.customer_key
              JOIN {database}.dim_time t ON f.time_key = t.time_key WHERE t.year = 1996 AND t.month = 3 AND t.day = 4"""
    with _cost_based(spark):
        lines = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {t: next(len(line) - len(line.lstrip(" :+-|")) for line in lines if "Relation" in line and f"{t}__" in line) for t in ("_dim_time", "_dim_customers", "_fact_sales")}
    assert depth["_dim_customers"] < min(depth["_dim_time"], depth["_fact_sales"]), "\n".join(lines)


def test_partitions_are_pruned(spark, gold, database):
    one_year = spark.sql(f"SELECT sum(f.quantity) FROM {database}._fact_by_month f JOIN {database}.dim_time t ON f.time_key = t.time_key AND f.year = t.year AND f.month = t.month WHERE t.year = 1997")
    assert "(year#" in _plan(one_year).split("PartitionFilters: [")[1].split("]")[0]
    quarter = published.trend_of_quarter(spark, 2, database)
    assert "dynamicpruning" in _plan(quarter)
    want = marts.monthly_sales_trend(gold.tables(spark)).where("Month in (4, 5, 6)")
    assert quarter.collect() == want.collect()


def test_marts_and_sandbox_read_the_views(spark, gold, database):
    t = published.tables(spark, database)
    own = gold.tables(spark)
    assert marts.sales_by_category(t).collect() == marts.sales_by_category(own).collect()
    assert intents.mart("customer", t).collect() == intents.mart("customer", own).collect()
    assert assistant.run_sandbox(spark, t, "SELECT count(*) AS n FROM fact_sales").data.first().n == gold.counts["fact_sales"]


def test_the_views_follow_the_version(spark, gold, tmp_path):
    def version(name, share):
        out = str(tmp_path / "wh" / name)
        t = gold.tables(spark)
        for table in schemas.GOLD_COLUMNS:
            if table == "fact_sales":
                t["_fact_by_month"].where(f"sales_key % {share} = 0").write.partitionBy("year", "month").parquet(f"{out}/{table}")
            else:
                t[table].write.parquet(f"{out}/{table}")
        return out

    first, second = version("v1-aaaaaaaa", 2), version("v2-bbbbbbbb", 3)
    try:
        published.publish(spark, first, "moving", fact_columns=False)
        planned = spark.table("moving.fact_sales").agg(F.count("*").alias("n"))
        n = spark.table("moving.fact_sales").count()
        published.publish(spark, second, "moving")
        assert spark.table("moving.fact_sales").count() < n == planned.first().n
        tables = {t.name for t in spark.catalog.listTables("moving")}
        assert any("v1_aaaaaaaa" in t for t in tables) and any("v2_bbbbbbbb" in t for t in tables)
        shutil.rmtree(first)
        published.publish(spark, second, "moving")  # again: nothing changes but for the entries of what is gone
        tables = {t.name for t in spark.catalog.listTables("moving")}
        assert not any("v1_aaaaaaaa" in t for t in tables)
        assert {r.table_name for r in published.list_tables(spark, "moving").collect()} == set(schemas.GOLD_COLUMNS)
    finally:
        spark.sql("DROP DATABASE IF EXISTS moving CASCADE")


def test_a_build_keeps_its_sources(spark, gold, sf_small):
    from lakestar.plans.warehouse import second_warehouse

    second = second_warehouse(spark, sf_small)
    uses = {(r.table_name, r.source): r for r in gold_plan.read_sources(spark, second.version_path).collect()}
    assert uses["products", "local"].used and not uses["products", "mirror"].used and "PATH_NOT_FOUND" in uses["products", "mirror"].error
    counts = {r.stage: r.rows for r in gold_plan.read_stage_counts(spark, second.version_path).collect()}
    assert counts["quarantined"] > 0 and counts["quarantined"] == gold_plan.read_quarantine(spark, second.version_path).count()
    assert counts["source_products_local"] == counts["bronze_products"] and counts["failed_products_mirror"] == 0
    assert [c[1:3] for c in second.calls] == [(False, True), (True, True)]
