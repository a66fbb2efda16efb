"""Readers: CSV bound by header name, windows-1252 bytes, JSON payloads,
source fallback."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lakestar.sources import readers


def test_ledger_csv_binds_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="lakestar-csv-")
    with open(os.path.join(d, "ledger.csv"), "w") as f:
        f.write("idx,Country,Extra,Unit_Price,Product,Date,Order_Quantity\n")
        f.write('0,Canada,"a, quoted",10.5,"Widget, large",2024-01-06,3\n')
        f.write("1,,x,,Gadget,2024-02-29,\n")
    df = readers.read_ledger(spark, d)
    assert df.columns == ["Date", "Country", "Product", "Order_Quantity", "Unit_Price"]
    rows = sorted(df.collect(), key=lambda r: r.Date)
    assert rows[0].Product == "Widget, large" and rows[0].Unit_Price == 10.5 and rows[0].Order_Quantity == 3.0
    assert rows[1].Country is None and rows[1].Unit_Price is None and rows[1].Order_Quantity is None


def test_ledger_csv_missing_column_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="lakestar-csv-")
    with open(os.path.join(d, "ledger.csv"), "w") as f:
        f.write("Date,Country\n2024-01-01,Canada\n")
    with pytest.raises(ValueError):
        readers.read_ledger(spark, d)


def test_orders_extract_windows_1252(spark):
    d = tempfile.mkdtemp(prefix="lakestar-cp1252-")
    text = "Row ID,Customer Name,Customer Segment,City,State\n0,“Quoted” Name,Consumer,Köln – Mitte,€ State\n"
    with open(os.path.join(d, "extract.csv"), "wb") as f:
        f.write(text.encode("cp1252"))
    row = readers.read_orders_extract(spark, d, "Row ID").first()
    assert row["Customer Name"] == "“Quoted” Name"
    assert row["City"] == "Köln – Mitte" and row["State"] == "€ State"


def test_catalogue_json_array_and_lines(spark):
    d = tempfile.mkdtemp(prefix="lakestar-json-")
    payload = [{"id": i, "title": f"Product Item {i}", "price": round(19.99 + i * 5.5, 2), "category": "Clothing",
                "rating": {"rate": 4.1}} for i in range(1, 4)]
    with open(os.path.join(d, "payload.json"), "w") as f:
        json.dump(payload, f)
    arr = readers.read_catalogue(spark, d, multi_line=True)
    assert arr.columns == ["id", "title", "price", "category"] and arr.count() == 3
    d2 = tempfile.mkdtemp(prefix="lakestar-jsonl-")
    with open(os.path.join(d2, "p.json"), "w") as f:
        f.write("\n".join(json.dumps(p) for p in payload))
    assert sorted(r.id for r in readers.read_catalogue(spark, d2).collect()) == [1, 2, 3]


def test_choose_source_falls_back_and_reports(spark):
    d = tempfile.mkdtemp(prefix="lakestar-reg-")
    spark.createDataFrame([(1, "a", "b", "c", "Gold")], readers.schemas.REGISTRY_CUSTOMERS).write.mode("overwrite").parquet(d)
    choice = readers.choose_source([
        ("primary", lambda: spark.read.parquet(d + "-missing")),
        ("unset", None),
        ("local", lambda: readers.read_registry(spark, d, "customers")),
    ])
    assert choice.source == "local" and "primary" in choice.errors and choice.df.count() == 1
    with pytest.raises(RuntimeError):
        readers.choose_source([("only", lambda: spark.read.parquet(d + "-missing"))])


def test_ledger_in_file_order(spark):
    d = tempfile.mkdtemp(prefix="lakestar-order-")
    for name, rows in (("part-b.csv", range(5, 10)), ("part-a.csv", range(0, 5))):
        with open(os.path.join(d, name), "w") as f:
            f.write("Date,Country,Product,Order_Quantity,Unit_Price\n")
            for i in rows:
                f.write(f"2024-01-{i + 1:02d},Canada,P{i},1,{i}.5\n")
    df = readers.read_ledger_in_file_order(spark, d)
    ordered = df.orderBy(*readers.FILE_POSITION).select("Product").collect()
    assert [r.Product for r in ordered] == [f"P{i}" for i in range(10)]


def test_ledger_in_file_order_across_splits(spark):
    d = tempfile.mkdtemp(prefix="lakestar-split-")
    with open(os.path.join(d, "ledger.csv"), "w") as f:
        f.write("Date,Country,Product,Order_Quantity,Unit_Price\n")
        for i in range(3000):
            f.write(f"2024-01-01,Canada,P{i:05d},1,1.5\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = readers.read_ledger_in_file_order(spark, d)
        assert df.select(F.spark_partition_id()).distinct().count() > 5
        got = [r.Product for r in df.orderBy(*readers.FILE_POSITION).select("Product").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"P{i:05d}" for i in range(3000)]


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8", newline="")


HEADER = "Date,Country,Product,Order_Quantity,Unit_Price\n"


def test_quotes_commas_and_missing_tokens(spark, tmp_path):
    write(tmp_path, a=HEADER + '2024-01-01,NA,"Bolt 1/4"" wide",N/A,null\n2024-01-02,None ,"Say ""hi, you""",2,"3.5"\nNaN,"","NULL",,nan\n')
    rows = {r.Date: r for r in readers.read_ledger(spark, str(tmp_path)).collect()}
    assert rows["2024-01-01"].Product == 'Bolt 1/4" wide' and rows["2024-01-02"].Product == 'Say "hi, you"'
    assert rows["2024-01-01"].Country is None and rows["2024-01-01"].Order_Quantity is None and rows["2024-01-01"].Unit_Price is None
    assert rows["2024-01-02"].Country == "None " and rows["2024-01-02"].Unit_Price == 3.5
    assert tuple(rows[None])[1:] == (None, None, None, None)


def test_line_breaks_in_fields(spark, tmp_path):
    write(tmp_path, a=HEADER + '2024-01-01,C,"two\nlines",1,2\n2024-01-02,C,one,1,2\n')
    rows = readers.read_ledger_in_file_order(spark, str(tmp_path), multi_line=True).orderBy("_src_row").collect()
    assert [r.Product for r in rows] == ["two\nlines", "one"]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    write(tmp_path, a=HEADER + "2024-01-01,C,P,1,2\n", b="Product,Date,Country,Unit_Price,Order_Quantity\nQ,2024-02-02,C,1,2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_ledger(spark, str(tmp_path)).collect()
