"""Numbering, keep-first and constraint checks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestar.operators import quality
from lakestar.operators.dedup import keep_first
from lakestar.operators.numbering import number_rows, stage_ordered


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_number_rows_is_global_row_number(spark, parts):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b"))
    staged = stage_ordered(df, ["a", "b"], parts)
    got = number_rows(staged, "n").select("a", "b", "n")
    want = df.select("a", "b", F.row_number().over(Window.orderBy("a", "b")).alias("n"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    kept = number_rows(staged, "m", where=F.col("b") != 1).select("a", "b", "m")
    want2 = df.where("b != 1").select("a", "b", F.row_number().over(Window.orderBy("a", "b")).alias("m"))
    assert kept.exceptAll(want2).count() == 0 and want2.exceptAll(kept).count() == 0


def test_keep_first_uses_order(spark):
    rows = [(1, "late", 5), (1, "early", 2), (2, "only", 9), (3, "x", 1), (3, "y", 0)]
    df = spark.createDataFrame(rows, "k int, v string, o int")
    got = {r.k: r.v for r in keep_first(df, ["k"], ["o"]).collect()}
    assert got == {1: "early", 2: "only", 3: "y"}


def test_constraint_reports_count_injected_faults(spark):
    dim = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (None, "c")], "k long, s string")
    rep = quality.key_violations([("dim", dim, "k")]).first()
    assert (rep.duplicate_keys, rep.surplus_rows) == (2, 1)
    nulls = {r.column_name: r.null_rows for r in quality.null_violations([("dim", dim, ["k", "s"])]).collect()}
    assert nulls == {"k": 1, "s": 1}
    fact = spark.createDataFrame([(1,), (5,), (5,), (7,)], "k long")
    fk = quality.fk_violations(fact, [("k", dim, "dim")]).first()
    assert (fk.orphan_keys, fk.orphan_rows) == (2, 3)
    text = spark.createDataFrame([("x" * 51,), ("ok",)], "country string")
    ln = quality.length_violations([("stores", text, {"country": 50})]).first()
    assert ln.violations == 1
    with pytest.raises(ValueError):
        quality.assert_clean(quality.key_violations([("dim", dim, "k")]), ["duplicate_keys"], "pk")


def test_lookup_join_salted_path_matches_broadcast(spark):
    from lakestar.operators.lookup import lookup_join

    left = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"), "id"
    )
    right = spark.createDataFrame([("hot", 1)] + [(str(i), i + 10) for i in range(40)], "k string, v int")
    small = lookup_join(left, right, "k")
    salted = lookup_join(left, right, "k", max_rows=5, salts=7, hot_rows=500)
    assert salted.count() == small.count() == 3000
    assert salted.exceptAll(small).count() == 0 and small.exceptAll(salted).count() == 0
    from lakestar.operators.lookup import hot_keys, salted_join

    assert [r.k for r in hot_keys(left, ["k"], 500).collect()] == ["hot"]
    every = salted_join(left, right, ["k"], "left", salts=5, hot_rows=500, max_hot_keys=0)
    assert every.exceptAll(small).count() == 0 and small.exceptAll(every).count() == 0


def test_measuring_sends_no_rows_to_one_task(spark):
    from lakestar.operators import lookup

    df = spark.range(1000).selectExpr("id", "cast(id as string) s")
    n, size = lookup.measured(df)
    assert n == 1000 and size == 1000 * (16 + 8) + sum(len(str(i)) for i in range(1000))
    assert lookup.broadcast_if_small(df, max_rows=1000)[1] and not lookup.broadcast_if_small(df, max_rows=999)[1]
    assert not lookup.broadcast_if_small(df, max_bytes=20_000)[1]


def test_null_keys_are_spread(spark):
    from pyspark.sql import functions as F

    from lakestar.operators.lookup import salted_join

    left = spark.range(9000).selectExpr("id", "case when id % 3 = 0 then null else cast(id % 50 as int) end k")
    right = spark.range(50).selectExpr("cast(id as int) k", "id * 10 v")
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(left, right, ["k"], "left", salts=16, hot_rows=10**9)
        parts = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 9000 and joined.where("k is null and v is null").count() == 3000
        assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])


def _fk(report):
    return {r.fk_column: (r.orphan_keys, r.orphan_rows) for r in report.collect()}


def test_foreign_keys_by_bitmap_equal_the_join(spark):
    import random

    rnd = random.Random(7)
    for low in (-500, 0, 3_000_000_000):
        dim = spark.createDataFrame([(low + k,) for k in range(400) if rnd.random() < 0.8], "k long")
        rows = [(low + rnd.randrange(-100, 500) if rnd.random() < 0.95 else None,) for _ in range(2000)] + [(2**63 - 1,), (-(2**63),)]
        fact = spark.createDataFrame(rows, "k long")
        keys = {r.k for r in dim.collect()}
        orphans = [k for (k,) in rows if k not in keys]
        want = {"k": (len(set(orphans)), len(orphans))}
        assert _fk(quality.fk_violations(fact, [("k", dim, "dim")])) == want
        assert _fk(quality.fk_violations(fact, [("k", dim, "dim")], max_bitmap_words=3)) == want


def test_foreign_keys_of_dense_dimensions_need_no_exchange(spark, monkeypatch):
    fact = spark.range(1000).selectExpr("id % 70 as a", "cast(id % 9 as int) as b", "cast(id % 5 as string) as c")
    refs = [("a", spark.range(64).toDF("a"), "da"), ("b", spark.range(9).selectExpr("cast(id as int) as b"), "db"), ("c", spark.range(4).selectExpr("cast(id as string) as c"), "dc")]
    assert quality.key_bitmap(refs[2][1], "c") is None  # text keys take the join
    assert quality.key_bitmap(refs[0][1], "a", rows_at_most=10**10) is None
    bitmap = quality.key_bitmap(refs[0][1], "a")
    assert bitmap.low == 0 and bitmap.words.tolist() == [-1]
    plan = fact.agg(F.count_if(bitmap.holds(F.col("a"), spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1  # one row for each task
    assert _fk(quality.fk_violations(fact, refs)) == {"a": (6, 84), "b": (0, 0), "c": (1, 200)}
    empty = spark.createDataFrame([], "a long")
    assert _fk(quality.fk_violations(fact.select("a"), [("a", empty, "none")])) == {"a": (70, 1000)}
    assert _fk(quality.fk_violations(empty, [("a", refs[0][1], "da")])) == {"a": (0, 0)}


def test_staged_columns_number_rows_as_they_come(spark, tmp_path):
    from lakestar.operators.numbering import KEPT, PID, POS, ROW, stage_columns

    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 5003).alias("a")).repartitionByRange(4, "a").sortWithinPartitions("a")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    staged = stage_columns(df, F.col("id") % 3 != 0, str(tmp_path / "staged"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == before
    rows = sorted(staged.collect(), key=lambda r: (r[PID], r[POS]))
    assert [r.a for r in rows] == sorted(r.a for r in rows) and len(rows) == 5000
    for pid in range(4):
        own = [r for r in rows if r[PID] == pid]
        assert [r[POS] for r in own] == list(range(len(own)))
        for kept in (True, False):
            assert [r[ROW] for r in own if r[KEPT] is kept] == list(range(sum(r[KEPT] is kept for r in own)))
            assert all((r.id % 3 != 0) is kept for r in own if r[KEPT] is kept)
    plan = staged.where(F.col(KEPT)).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint,_tmp_metadata_row_index:bigint>" in plan and "PartitionFilters: [" in plan
