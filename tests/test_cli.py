"""Command line entry points, run in-process on the test landing files."""

from lakestar.__main__ import _print, main
from lakestar.sources import testmap


def test_cli_build_report_ask_sql(spark, gold, tmp_path, capsys):
    land = gold.landing
    wh = str(tmp_path / "wh")
    order = ",".join(f"{k}:{v}" for k, v in testmap.LEDGER_ORDER.items())
    assert main(["build", "--customers", land["registry/customers"], "--stores", land["registry/stores"],
                 "--catalogue", land["catalogue"], "--ledger", land["ledger"], "--warehouse", wh,
                 "--order-columns", order], spark) == 0
    out = capsys.readouterr().out
    assert "fact_sales" in out and str(gold.counts["fact_sales"]) in out
    assert main(["report", "--warehouse", wh], spark) == 0
    assert "Total Revenue ($)" in capsys.readouterr().out
    assert main(["ask", "--warehouse", wh, "sales per month"], spark) == 0
    assert "intent: trend" in capsys.readouterr().out
    assert main(["sql", "--warehouse", wh, "DROP TABLE fact_sales"], spark) == 2
    assert main(["sql", "--warehouse", wh, "SELECT count(*) AS n FROM fact_sales"], spark) == 0
    capsys.readouterr()
    # all rows, not the first twenty or hundred
    assert main(["sql", "--warehouse", wh, "SELECT sales_key FROM fact_sales WHERE sales_key <= 250"], spark) == 0
    assert len(capsys.readouterr().out.splitlines()) == 251
    assert main(["sql", "--warehouse", wh, "--rows", "30", "SELECT sales_key FROM fact_sales WHERE sales_key <= 250"], spark) == 0
    assert len(capsys.readouterr().out.splitlines()) == 31
    assert main(["sql", "--warehouse", wh, "--out", str(tmp_path / "result"), "SELECT sales_key FROM fact_sales"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "result")).count() == gold.counts["fact_sales"]
    assert main(["report", "--warehouse", wh, "--out", str(tmp_path / "reports")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "reports/top_customers")).count() == 5
    assert main(["registry", "--extract", land["orders_extract"], "--out", str(tmp_path / "reg")], spark) == 0


def test_printing_is_whole(spark, capsys):
    _print(spark.range(30).selectExpr("concat('group ', id) g", "id n"))
    assert len(capsys.readouterr().out.splitlines()) == 31


def test_cli_in_file_order_builds_what_is_missing_from_the_first_source_that_opens(spark, gold, tmp_path, capsys):
    land = gold.landing
    wh = str(tmp_path / "wh")
    sources = ["--customers", str(tmp_path / "gone"), "--customers", land["registry/customers"], "--stores", land["registry/stores"],
               "--catalogue", land["catalogue"], "--ledger", land["ledger"]]
    assert main(["ask", "--warehouse", wh, *sources, "nothing special"], spark) == 0
    said = capsys.readouterr()
    assert "gone not read" in said.err and "intent: default" in said.out and "sql: SELECT" in said.out
    assert main(["sql", "--warehouse", wh, *sources, "SELECT max(sales_key) FROM fact_sales"], spark) == 0
    assert capsys.readouterr().out.splitlines()[-1] == str(gold.counts["fact_sales"])
