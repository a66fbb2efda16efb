"""Build invariants on sf0.001, fault handling, and plan shapes."""

import pytest
from pyspark.sql import functions as F

from lakestar.plans import intents, lease, marts
from lakestar.plans import gold as gold_plan
from lakestar.plans.gold import build, current_version_path, open_tables
from lakestar.plans.warehouse import bronze_from_landing


def test_row_accounting(gold):
    c = gold.counts
    assert c["bronze_ledger"] == c["fact_sales"] + c["pruned_rows"]
    assert c["pruned_rows"] > 0 and c["default_store"] > 0 and c["filled_quantity"] > 0


def test_keys_are_dense_and_unique(spark, gold):
    f = gold.tables(spark)["fact_sales"]
    agg = f.agg(F.count("*").alias("n"), F.countDistinct("sales_key").alias("d"), F.min("sales_key").alias("lo"),
                F.max("sales_key").alias("hi")).first()
    assert agg.n == agg.d == agg.hi and agg.lo == 1


def test_totals_agree_across_marts(spark, gold):
    t = gold.tables(spark)
    cat = sum(r["Total Revenue ($)"] for r in marts.sales_by_category(t).collect())
    trend = sum(r["Monthly Revenue ($)"] for r in marts.monthly_sales_trend(t).collect())
    country = sum(r["Total Revenue ($)"] for r in marts.revenue_by_country(t).collect())
    kpi = marts.kpi_totals(t).first().total_revenue
    assert round(cat, 2) == round(trend, 2) == round(country, 2) == round(kpi, 2)


def test_margin_is_35_percent(spark, gold):
    for r in marts.sales_by_category(gold.tables(spark)).collect():
        assert abs(r["Profit Margin (%)"] - 35.0) < 0.05


def test_missing_default_store_fails_fk_check(spark, gold, tmp_path):
    b = bronze_from_landing(spark, gold.landing)
    b.stores = b.stores.where(F.col("store_id") != 1)
    with pytest.raises(ValueError, match="foreign key"):
        build(spark, b, str(tmp_path / "wh"))


def test_failed_build_keeps_current_version(spark, gold, tmp_path):
    root = str(tmp_path / "wh2")
    first = build(spark, bronze_from_landing(spark, gold.landing), root)
    b = bronze_from_landing(spark, gold.landing)
    b.stores = b.stores.where(F.col("store_id") != 1)
    with pytest.raises(ValueError):
        build(spark, b, root)
    assert current_version_path(spark, root) == first.version_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_use_no_python_and_no_global_window(spark, gold):
    t = gold.tables(spark)
    for fn in (marts.sales_by_category, marts.top_customers, marts.monthly_sales_trend, marts.revenue_by_country,
               marts.product_units_sold, *[x.mart for x in intents.TEMPLATES.values()]):
        plan = _plan(fn(t))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "Window" not in plan


def test_scan_is_pruned(spark, gold):
    plan = _plan(marts.sales_by_category(gold.tables(spark)))
    assert "ReadSchema: struct<sales_key:bigint,product_key:bigint,quantity:bigint,total_revenue:double,total_profit:double>" in plan


def _ancestors(lines, idx):
    """Lines above ``idx`` with smaller indentation: its ancestors in a plan tree."""
    def depth(line):
        return len(line) - len(line.lstrip(" :|+-"))

    out, level = [], depth(lines[idx])
    for line in reversed(lines[:idx]):
        if depth(line) < level:
            out.append(line)
            level = depth(line)
    return out


def test_fact_numbering_has_no_window_over_the_fact(spark, gold):
    from lakestar.plans import silver

    fact = silver.number_sales(gold.staged, gold.summary)
    lines = fact._jdf.queryExecution().executedPlan().toString().splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    assert windows, "expected the offsets window"
    for i in windows:
        assert any("BroadcastExchange" in a for a in _ancestors(lines, i)), lines[i]
    assert "BatchEvalPython" not in "\n".join(lines) and "ArrowEvalPython" not in "\n".join(lines)


def test_many_small_partitions_give_the_same_fact(spark, gold, tmp_path):
    from lakestar.plans.warehouse import bronze_from_landing

    res = build(spark, bronze_from_landing(spark, gold.landing), str(tmp_path / "wh64"), num_partitions=64)
    a = gold.tables(spark)["fact_sales"]
    b = open_tables(spark, res.version_path)["fact_sales"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ledger_is_conformed_after_the_exchange(spark, gold):
    from lakestar.plans import silver

    b = bronze_from_landing(spark, gold.landing)
    t = gold.tables(spark)
    lookups = silver.country_lookups(t["dim_customers"], t["dim_stores"])
    assert lookups.small
    lines = _plan(silver.staging_plan(b.sales, lookups, 5, b.order_cols, 3)).splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange rangepartitioning" in line)
    above, below = "\n".join(_ancestors(lines, at)), "\n".join(lines[at + 1 :])
    assert "BroadcastHashJoin" in above and "Sort [" in above
    assert "md5" not in below and "regexp_extract_all" not in below


def test_file_order_needs_no_exchange_of_the_ledger(spark, gold):
    from lakestar.plans import silver
    from lakestar.sources import readers

    t = gold.tables(spark)
    sales = readers.read_ledger_in_file_order(spark, gold.landing["ledger"])
    plan = _plan(silver.staging_plan(sales, silver.country_lookups(t["dim_customers"], t["dim_stores"]), 5, list(readers.FILE_POSITION)))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan csv" in line or "Scan csv" in line)
    assert not any("Exchange" in a for a in _ancestors(lines, scan))


def test_file_order_numbers_rows_across_splits(spark, gold, tmp_path):
    """Small splits, packed into partitions in any order, still give the files' order."""
    from dataclasses import replace

    from lakestar.sources import readers

    folder = tmp_path / "ledger"
    folder.mkdir()
    n = 0
    for name in ("c", "a", "b"):
        lines = []
        for _ in range({"a": 900, "b": 20, "c": 400}[name]):
            lines.append(f"2024-01-{n % 27 + 1:02d},{'Nation_1' if n % 3 else 'Nowhere'},P{name}{n},1,{n}.5")
            n += 1
        (folder / f"{name}.csv").write_text("Date,Country,Product,Order_Quantity,Unit_Price\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        sales = readers.read_ledger_in_file_order(spark, str(folder))
        b = replace(bronze_from_landing(spark, gold.landing), sales=sales, order_cols=list(readers.FILE_POSITION))
        res = build(spark, b, str(tmp_path / "wh"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = open_tables(spark, res.version_path)["fact_sales"].orderBy("sales_key").collect()
    order = [*range(400, 1300), *range(1300, 1320), *range(0, 400)]  # files by name
    kept = [(place, i) for place, i in enumerate(order, 1) if i % 3]
    assert [(r.sales_key, r.transaction_id, r.unit_price) for r in rows] == [(k, f"TXN{place:06d}", i + 0.5) for k, (place, i) in enumerate(kept, 1)]


def test_reads_are_pruned(spark, gold):
    t = gold.tables(spark)
    for df in (marts.table_preview(t, "fact_sales", 7), intents.mart("default", t)):
        files = df.inputFiles()
        assert any("/_head/" in f for f in files) and not any("/fact_sales/" in f for f in files)
    assert [r.sales_key for r in marts.table_preview(t, "fact_sales", 7).collect()] == [1, 2, 3, 4, 5, 6, 7]
    beyond = marts.head_of_fact(t, marts.HEAD_ROWS + 1)
    assert "LessThanOrEqual(sales_key," in _plan(beyond) and beyond.count() == marts.HEAD_ROWS + 1
    months = t["_months"].count()
    for n, df in ((3, marts.recent_months(t, 3)), (12, intents.mart("trend", t))):
        assert "PartitionFilters: [" in _plan(df) and "(year#" in _plan(df).split("PartitionFilters: [")[1]
        assert df.count() == min(n, months)


def test_fact_files_are_grouped_by_month(spark, gold):
    by_month = gold.tables(spark)["_fact_by_month"]
    assert by_month.where("substr(time_key, 1, 7) <> format_string('%04d-%02d', year, month)").count() == 0
    assert {tuple(r) for r in by_month.select("year", "month").distinct().collect()} == {tuple(r) for r in gold.tables(spark)["_months"].collect()}


def test_repeated_fact_key_fails_the_check(spark, gold):
    f = gold.tables(spark)["fact_sales"]
    surplus = gold_plan.quality.dense_key_surplus
    assert tuple(surplus(f, "sales_key").first())[1:] == (0, 0)
    broken = f.withColumn("sales_key", F.when(F.col("sales_key") == 5, 6).otherwise(F.col("sales_key")))
    assert tuple(surplus(broken, "sales_key").first())[1:] == (1, 1)
    with pytest.raises(ValueError, match="primary key"):
        gold_plan.quality.assert_clean(surplus(broken, "sales_key"), ["surplus_rows", "missing_keys"], "primary key")
    plan = _plan(surplus(f, "sales_key"))
    assert "bitmap_construct_agg" in plan


def test_pointer_is_replaced_in_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "_CURRENT")
    gold_plan.write_small_file(spark, path, "v1\n")
    gold_plan.write_small_file(spark, path, "v2\n")
    assert gold_plan.read_small_file(spark, path) == "v2"

    class Broken(Exception):
        pass

    def stop(*_):
        raise Broken

    # killed after the new content was written, before it is moved
    monkeypatch.setattr(spark.sparkContext._gateway, "new_array", stop)
    with pytest.raises(Broken):
        gold_plan.write_small_file(spark, path, "v3\n")
    assert gold_plan.read_small_file(spark, path) == "v2"


def test_a_killed_build_leaves_the_current_version(spark, gold, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    first = build(spark, bronze_from_landing(spark, gold.landing), root)
    for step in ("_check_version", "write_small_file"):
        with monkeypatch.context() as m:
            m.setattr(gold_plan, step, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                build(spark, bronze_from_landing(spark, gold.landing), root)
        assert current_version_path(spark, root) == first.version_path
    assert open_tables(spark, current_version_path(spark, root))["fact_sales"].count() == gold.counts["fact_sales"]


def _versions(root):
    return {p.name for p in root.iterdir() if p.is_dir()}


def test_one_build_at_a_time_and_old_versions_go(spark, gold, tmp_path):
    root = str(tmp_path / "wh")
    with lease.held(spark, f"{root}/{gold_plan.LOCK}"):
        with pytest.raises(RuntimeError, match="another build"):
            build(spark, bronze_from_landing(spark, gold.landing), root)
    for i in range(5):
        (tmp_path / "wh" / f"v{i}-abcdef01").mkdir()
        if i != 3:
            (tmp_path / "wh" / f"v{i}-abcdef01" / gold_plan.PUBLISHED).touch()
    result = build(spark, bronze_from_landing(spark, gold.landing), root, keep_versions=3)
    # v3 is what a build that died left: it takes no place
    assert _versions(tmp_path / "wh") == {"v2-abcdef01", "v4-abcdef01", result.version_path.rsplit("/", 1)[-1]}
    assert [p.name for p in (tmp_path / "wh").iterdir() if p.name.startswith(gold_plan.LOCK)] == []


def test_failed_builds_leave_nothing_and_spare_good_versions(spark, gold, tmp_path, monkeypatch):
    root = tmp_path / "wh"
    good = [build(spark, bronze_from_landing(spark, gold.landing), str(root), keep_versions=2).version_path for _ in range(2)]
    with monkeypatch.context() as m:
        m.setattr(gold_plan, "_check_version", lambda *a, **k: (_ for _ in ()).throw(ValueError("orphans")))
        for _ in range(2):
            with pytest.raises(ValueError, match="orphans"):
                build(spark, bronze_from_landing(spark, gold.landing), str(root), keep_versions=2)
            assert _versions(root) == {p.rsplit("/", 1)[-1] for p in good}
    last = build(spark, bronze_from_landing(spark, gold.landing), str(root), keep_versions=2).version_path
    assert _versions(root) == {p.rsplit("/", 1)[-1] for p in (good[1], last)}


def test_a_build_that_lost_its_lock_does_not_publish(spark, gold, tmp_path, monkeypatch):
    root = tmp_path / "wh"
    first = build(spark, bronze_from_landing(spark, gold.landing), str(root))
    with monkeypatch.context() as m:
        m.setattr(gold_plan, "_check_version", lambda *a, **k: (root / gold_plan.LOCK).write_text("someone else"))
        with pytest.raises(lease.LockHeld, match="lost"):
            build(spark, bronze_from_landing(spark, gold.landing), str(root))
    assert current_version_path(spark, str(root)) == first.version_path
    assert (root / gold_plan.LOCK).read_text() == "someone else"


def test_reports_read_the_fact_once(spark, gold):
    from lakestar.plans.warehouse import run_all_reports

    t = gold.tables(spark)
    for name, df in run_all_reports(t).items():
        assert "fact_sales" not in _plan(df)
        alone = {"sales_by_category": marts.sales_by_category(t), "top_customers": marts.top_customers(t, 5),
                 "recent_months": marts.recent_months(t, 10), "revenue_by_country": marts.revenue_by_country(t)}[name]
        assert df.collect() == alone.collect()
