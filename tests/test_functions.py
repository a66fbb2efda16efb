"""Golden tests: column expressions against Python / numpy / hashlib / SQLite."""

import hashlib
import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestar.functions import half_even_round, py_strip, sqlite_round, stable_key, title_case, txn_id, period_label
from lakestar.functions.text import first_token, last_token

TITLE_CASES = [
    "men's clothing", "o'brien mary-jane", "UNITED states", "île-de-france", "abc1def x2y", "a.b_c", "",
    "straße ßtart", "ǆemal", "NATION_7", "Customer#000000001", "  spaced   out ", "élan vital", "x", "123abc",
]
STRIP_CASES = ["\t a \n", " b　", "\x1cc\x1f", "  ", "", "d", " e f ", " g ", "\x0bh\x0c\r"]


def test_title_case_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in TITLE_CASES] + [(None,)], "s string")
    got = df.select("s", title_case(F.col("s")).alias("t")).collect()
    for row in got:
        assert row.t == (None if row.s is None else row.s.title()), row.s


def test_strip_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in STRIP_CASES], "s string")
    for row in df.select("s", py_strip(F.col("s")).alias("t")).collect():
        assert row.t == row.s.strip(), repr(row.s)


@pytest.mark.parametrize("n", [1, 7, 20, 1999, 2147483647])
def test_stable_key_matches_hashlib(spark, n):
    names = [f"Product Item {i}" for i in range(1, 200)] + ["é", "", "a" * 50, "nan"]
    df = spark.createDataFrame([(s,) for s in names], "s string")
    got = {r.s: r.k for r in df.select("s", stable_key(F.col("s"), n).alias("k")).collect()}
    for s in names:
        assert got[s] == int(hashlib.md5(s.encode("utf-8")).hexdigest(), 16) % n + 1, s


def test_stable_key_degenerate_sizes(spark):
    df = spark.createDataFrame([("x",)], "s string")
    assert df.select(stable_key(F.col("s"), 0).alias("k")).first().k == 1
    with pytest.raises(ValueError):
        stable_key(F.col("s"), 2**31)


def test_half_even_round_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = list(rng.integers(1, 10**6, 3000) / 100.0 * 0.35) + [0.125, 1.005, 2.675, 0.5, 1.5, 2.5, -2.675]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = [r.r for r in df.select(half_even_round(F.col("v")).alias("r")).collect()]
    assert got == [float(x) for x in np.round(np.array(vals), 2)]


def test_sqlite_round_matches_sqlite(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.integers(1, 10**7, 3000) / rng.integers(1, 9, 3000) / 100.0) + [341.915, 2.675, 1.005, 0.125, -2.675]
    con = sqlite3.connect(":memory:")
    want = [con.execute("select round(?, 2)", (float(v),)).fetchone()[0] for v in vals]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = [r.r for r in df.select(sqlite_round(F.col("v")).alias("r")).collect()]
    assert got == want


def test_txn_id_and_period(spark):
    df = spark.createDataFrame([(7, 2024, 3), (999999, 1999, 12), (1234567, 2001, 1)], "n long, y int, m int")
    rows = df.select(txn_id(F.col("n")).alias("t"), period_label(F.col("y"), F.col("m")).alias("p")).collect()
    assert [r.t for r in rows] == [f"TXN{n:06d}" for n in (7, 999999, 1234567)]
    assert [r.p for r in rows] == ["2024-03", "1999-12", "2001-01"]


def test_name_tokens(spark):
    names = ["Claire Gute", "  Madonna ", "", "Jean  Claude\tVan Damme", "a b"]
    df = spark.createDataFrame([(s,) for s in names], "s string")
    rows = df.select("s", first_token(F.col("s"), "user").alias("f"), last_token(F.col("s"), "cust").alias("l")).collect()
    for r in rows:
        parts = r.s.strip().split()
        assert r.f == (parts[0].lower() if parts else "user")
        assert r.l == (parts[-1].lower() if len(parts) > 1 else "cust")
