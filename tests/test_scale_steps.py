"""Steps that every build runs over the whole ledger, and what runs without a build."""

import hashlib
import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestar.catalog import QUERIES
from lakestar.functions.text import py_strip, title_case
from lakestar.operators import numbering
from lakestar.plans import gold, silver, warehouse
from lakestar.session import shuffles_deleted
from lakestar.sources import testmap

SF = "/root/testdata/sf0.001"


def test_sources_alone_need_no_build(spark, tmp_path):
    sf_dir = str(tmp_path / "tables")
    shutil.copytree(SF, sf_dir)
    keys = {r["product_key"] for r in QUERIES["stable_product_key"](spark, sf_dir).collect()}
    second = warehouse.second_warehouse(spark, sf_dir)
    assert warehouse._key(spark, sf_dir) not in warehouse._CACHE
    assert [c[1] for c in second.calls] == [False, True]
    built = warehouse.testdata_warehouse(spark, sf_dir)
    assert warehouse.landing_for(spark, sf_dir) is built.landing
    assert warehouse.product_count(spark, sf_dir) == built.counts["dim_products"]
    assert keys == {r["product_key"] for r in QUERIES["stable_product_key"](spark, sf_dir).collect()}


def test_second_warehouse_writes_the_landing_parts_that_it_reads(spark, tmp_path):
    sf_dir = str(tmp_path / "tables")
    shutil.copytree(SF, sf_dir)
    second = warehouse.second_warehouse(spark, sf_dir)
    root = f"{warehouse._base(spark, sf_dir)}/landing"
    assert [part for part in testmap.LANDING_PARTS if gold.path_exists(spark, f"{root}/{part}")] == ["registry/customers", "registry/stores"]
    assert len(gold.read_sources(spark, second.version_path).collect()) == 8
    # a place is prepared when the places before it have failed
    landing = warehouse.landing_for(spark, sf_dir, ["catalogue"])
    places = {
        "customers": [("local", landing["registry/customers"])], "stores": [("local", landing["registry/stores"])], "products": [("local", landing["catalogue"])],
        "ledger": [("remote", f"{tmp_path}/none"), ("local", lambda: warehouse.landing_for(spark, sf_dir, ["ledger"])["ledger"])],
    }
    bronze = warehouse.chosen_bronze(spark, places)
    assert [(u.source, u.error is None) for u in bronze.sources if u.table == "ledger"] == [("remote", False), ("local", True)]
    assert bronze.sales.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    # what comes later needs every part
    assert sorted(warehouse.landing_for(spark, sf_dir)) == sorted(testmap.LANDING_PARTS)


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for d in folders for p in Path(d.getPath()).rglob("shuffle_*") if not p.name.endswith(".checksum")}


def _bytes_left(spark, before):
    """Of shuffle files that came since and still are there after the time that their deletion may take."""
    for _ in range(50):
        left = sum(Path(f).stat().st_size for f in _shuffle_files(spark) - before)
        if left < 1000:
            break
        time.sleep(0.2)
    return left


def test_landing_and_build_leave_no_shuffle_files(spark, tmp_path):
    sf_dir = str(tmp_path / "tables")
    shutil.copytree(SF, sf_dir)
    before = _shuffle_files(spark)
    second = warehouse.second_warehouse(spark, sf_dir)
    own = testmap.write_second_landing(spark, sf_dir, str(tmp_path / "landing"))
    result = gold.build(spark, warehouse.bronze_from_landing(spark, warehouse.landing_for(spark, sf_dir)), str(tmp_path / "wh"), num_partitions=3)
    # the fact's counts in ``second.calls`` are the only queries outside, of a few bytes
    assert _bytes_left(spark, before) < 1000
    assert result.counts["fact_sales"] > second.calls[0][3] > 0 and spark.read.option("header", True).csv(own["ledger"]).count() == result.counts["bronze_ledger"]


def test_deletion_of_shuffles_ends_with_its_block(spark, tmp_path):
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with pytest.raises(ValueError), shuffles_deleted(spark):
        # the same frame again: its rows are shuffled anew
        assert sorted(rows.collect()) == sorted(rows.collect()) and rows.count() == 7
        raise ValueError
    assert spark.conf.get(key, None) == was


def test_first_build_of_ensure_warehouse_leaves_no_staged_ledger(spark, tmp_path, monkeypatch):
    built = warehouse.testdata_warehouse(spark, SF)
    staging = f"{tmp_path}/staging"
    monkeypatch.setattr(silver, "staging_path", lambda spark: staging)
    version = gold.ensure_warehouse(spark, f"{tmp_path}/wh", lambda: warehouse.bronze_from_landing(spark, built.landing))
    assert not gold.path_exists(spark, staging)
    assert gold.open_tables(spark, version)["fact_sales"].count() == built.counts["fact_sales"]


def test_row_work_is_done_before_the_lookups(spark):
    sales = spark.createDataFrame(
        [(1, "2024-01-02", "NATION_3", "bolt", 2.0, 1.5)], "l int, Date string, Country string, Product string, Order_Quantity double, Unit_Price double"
    )
    dim = spark.createDataFrame([("Nation_3", 5)], "country string, key long")
    lookups = silver.country_lookups(dim.withColumnRenamed("key", "customer_key"), dim.withColumnRenamed("key", "store_key"))
    out = silver.conform_sales(sales, lookups, 20, ["l"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan[: plan.index("Join")]
    row = out.first()
    assert (row.customer_key, row.store_key, row.total_revenue, row.total_profit) == (5, 5, 3.0, 1.05)


def test_short_ways_give_what_the_general_rules_give(spark):
    parts = ["a", "B", "ab", "CD", "3", "_", "-", "'", " ", "  ", "\t", "\n", "é", "ß", " ", ".", "~", "\x00"]
    texts = ["", *parts, *[x + y for x in parts for y in parts], *[x + y + z for x in parts for y in parts for z in parts]]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", title_case(F.col("t")).alias("title"), py_strip(F.col("t")).alias("strip"))
    for r in df.collect():
        assert (r.title, r.strip) == ((r.t.title(), r.t.strip()) if r.t is not None else (None, None)), repr(r.t)
    # words of ASCII take the short way
    assert "initcap" in title_case(F.col("t"))._jc.toString().lower() or "initcap" in df._jdf.queryExecution().analyzed().toString().lower()


def test_ledger_fields_that_are_numbers_are_not_looked_up(spark):
    from lakestar.sources import readers

    texts = [*readers.MISSING_TOKENS, " 7", "7 ", "+7", "-0", "1e3", "2.50", ".5", "Infinity", "-inf", "+NaN", "NAN", "7d", "a text beyond eight bytes", "éééé", "NaN ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.when(~F.col("t").isin(readers.MISSING_TOKENS), F.col("t"))
    whole = [t if t is None or t in readers.MISSING_TOKENS else t.strip() for t in texts]
    for type_, fits in (("string", lambda t: True), ("double", lambda t: not t or t[0] not in "aé"), ("long", lambda t: not t or t.lstrip("+-").isdigit())):
        own = rows.where(F.col("t").isNull() | F.col("t").isin([t for t, w in zip(texts, whole) if t in readers.MISSING_TOKENS or w is not None and fits(w)]))
        got = own.select("t", readers._typed("t", type_).alias("got"), plain.cast(type_).alias("want"))
        assert own.count() >= len(readers.MISSING_TOKENS) and got.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    # the look-up comes last in the plan of a number
    assert "coalesce" in readers._typed("t", "long")._jc.toString() and "coalesce" in readers._typed("t", "double")._jc.toString()


def test_transaction_ids_and_product_keys_in_few_steps(spark):
    from lakestar.functions.keys import stable_key
    from lakestar.functions.text import txn_id

    numbers = [1, 99_999, 100_000, 999_999, 1_000_000, 2**62, 0, -7, None]
    got = spark.createDataFrame([(n,) for n in numbers], "n long").select(txn_id(F.col("n")).alias("t"), F.format_string("TXN%06d", "n").alias("w")).collect()
    assert [r.t for r in got] == [r.w for r in got]
    texts = [f"part {i}" for i in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 7, 2**20, 2**31 - 1):
        want = [int(hashlib.md5(t.encode()).hexdigest(), 16) % n + 1 for t in texts]
        assert [r.k for r in rows.select(stable_key(F.col("t"), n).alias("k")).collect()] == want
    # a digest is read in two halves, each once
    assert rows.select(stable_key(F.col("t"), 7).alias("k"))._jdf.queryExecution().analyzed().toString().count("conv(") <= 4


def test_key_ranges_part_rows_in_order_and_evenly(spark):
    even = spark.range(20_000).select((F.col("id") * 7919 % 20_011 - 9000).alias("k"))
    for df in (even, even.union(spark.createDataFrame([(None,)] * 50, "k long")), even.select(F.col("k").cast("int")), even.union(even)):
        for n in (2, 7, 33):
            rows = df.select("k", numbering.key_ranges(df, "k", n).alias("r")).groupBy("r").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count_if(F.col("k").isNull()).alias("none"), F.count(F.lit(1)).alias("n")).orderBy("r").collect()
            assert [r.r for r in rows] == list(range(n))
            assert all(a.high < b.low for a, b in zip(rows, rows[1:])) and not any(r.none for r in rows[1:])
            assert max(r.n for r in rows) < 1.5 * df.count() / n
    long = even.select((F.col("k") * 2**47).alias("k"))  # far apart, on both sides of zero
    assert long.select(numbering.key_ranges(long, "k", 5).alias("r")).distinct().count() == 5


def test_no_key_ranges_where_a_key_fills_one(spark):
    even = spark.range(2000).select(F.col("id").alias("k"))
    null = F.lit(None).cast("long")
    for df in (
        even.withColumn("k", F.lit(5).cast("long")),
        even.withColumn("k", F.when(F.col("k") < 1200, 3).otherwise(F.col("k")).cast("long")),
        even.withColumn("k", F.when(F.col("k") < 1200, null).otherwise(F.col("k"))),
        even.withColumn("k", null),
        even.where("k < 0"),
        even.union(spark.createDataFrame([(2**60,)], "k long")),
        even.union(spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "k long")),
        even.withColumn("k", F.col("k").cast("string")),
    ):
        assert numbering.key_ranges(df, "k", 8) is None
    assert numbering.key_ranges(even, "k", 1) is None


def test_large_ledgers_are_staged_in_the_same_order_without_sampling_whole_rows(spark, monkeypatch):
    wh = warehouse.testdata_warehouse(spark, SF)
    bronze = warehouse.bronze_from_landing(spark, wh.landing)
    tables = wh.tables(spark)
    lookups = silver.country_lookups(tables["dim_customers"], tables["dim_stores"])
    got = []
    for least, how in ((1 << 60, "rangepartitioning"), (0, None)):
        monkeypatch.setattr(silver, "KEY_RANGES_BYTES", least)
        plan = silver.staging_plan(bronze.sales, lookups, 20, bronze.order_cols, 6)
        assert ("rangepartitioning" in plan._jdf.queryExecution().toString()) == (how is not None)
        got.append((plan.collect(), plan.rdd.getNumPartitions()))
    assert got[0] == got[1] and len(got[0][0]) == wh.counts["bronze_ledger"]
