"""Sandbox, batch question answering, registry derivation and load."""

import pytest
from pyspark.sql import functions as F

from lakestar.plans import assistant, gold as gold_mod, intents, registry
from lakestar.sources import readers


def test_sandbox_refuses_and_runs(spark, gold):
    t = gold.tables(spark)
    bad = assistant.run_sandbox(spark, t, "DELETE FROM fact_sales")
    assert not bad.success and "DELETE" in bad.error
    hole = assistant.run_sandbox(spark, t, "SELECT java_method('java.lang.Math', 'abs', -1)")
    assert not hole.success and "java_method" in hole.error
    ok = assistant.run_sandbox(spark, t, "SELECT count(*) AS n FROM Fact_Sales")
    assert ok.success and ok.data.first().n == gold.counts["fact_sales"]
    reply = assistant.run_sandbox(spark, t, "Sure:\n```sql\nSELECT 1 AS x\n```", from_reply=True)
    assert reply.success and reply.sql == "SELECT 1 AS x"
    broken = assistant.run_sandbox(spark, t, "SELECT * FROM no_such_table")
    assert not broken.success and broken.error


def test_answer_batch_computes_each_intent_once(spark, gold):
    qs = spark.createDataFrame(
        [(1, "sales by category"), (2, "category mix"), (3, "monthly trend"), (4, "hello")], "id int, q string"
    )
    ans = assistant.answer_batch(qs, "q", gold.tables(spark))
    assert sorted(ans.results) == ["category", "default", "trend"]
    assert ans.results["trend"].count() <= 12 and ans.results["default"].count() == 10


def test_registry_emails_suffix_repeats(spark, tmp_path):
    rows = [(0, "Ann Lee", "Corporate", "A", "X"), (1, "Bob Lee", "Consumer", "A", "X"), (2, "Ann  Lee", "Home Office", "B", "Y"),
            (3, "Ann Lee", "Other", "C", "Z"), (4, "Cher", None, "D", "W")]
    ext = spark.createDataFrame(rows, "`Row ID` long, `Customer Name` string, `Customer Segment` string, City string, State string")
    reg = registry.build_registry(ext, "Row ID")
    got = {r.customer_name: (r.customer_id, r.email, r.country, r.membership_tier) for r in reg.customers.collect()}
    assert got["Ann Lee"] == (1, "ann.lee@superstore.com", "United States", "Platinum")
    assert got["Bob Lee"] == (2, "bob.lee@superstore.com", "Canada", "Gold")
    assert got["Ann  Lee"] == (3, "ann.lee2@superstore.com", "United Kingdom", "Silver")
    assert got["Cher"] == (4, "cher.cust@superstore.com", "France", "Gold")
    stores = reg.stores.orderBy("store_id").collect()
    assert [s.city for s in stores] == ["A", "B", "C", "D"] and stores[0].store_name == "Superstore Hub - A"
    paths = registry.write_registry(reg, str(tmp_path / "registry"))
    assert readers.read_registry(spark, paths["customers"], "customers").count() == 4


def test_ensure_warehouse_builds_once(spark, gold, tmp_path):
    from lakestar.plans.warehouse import bronze_from_landing

    root = str(tmp_path / "wh")
    calls = []

    def factory():
        calls.append(1)
        return bronze_from_landing(spark, gold.landing)

    first = gold_mod.ensure_warehouse(spark, root, factory)
    second = gold_mod.ensure_warehouse(spark, root, factory)
    assert first == second and len(calls) == 1
    assert gold_mod.open_tables(spark, first)["fact_sales"].agg(F.max("sales_key")).first()[0] == gold.counts["fact_sales"]


def test_plan_check_finds_side_effects(spark, gold):
    t = gold.tables(spark)
    assistant.register_views(t)
    own = assistant.table_roots(t)
    check = lambda sql: assistant.plan_violation(spark, sql, own)
    assert check("SELECT reflect('java.lang.Math', 'abs', -1)") == "CallMethodViaReflection"
    assert check("SELECT 1 WHERE '1' = (SELECT reflect('java.lang.Math', 'abs', -1))") == "CallMethodViaReflection"
    assert check("SELECT TRANSFORM(sales_key) USING 'cat' FROM fact_sales") == "ScriptTransformation"
    assert check("CREATE TABLE t_never AS SELECT 1 AS x") and check("SET spark.sql.shuffle.partitions=1") and check("DROP VIEW fact_sales")
    assert not spark.catalog.tableExists("t_never") and spark.catalog.tableExists("fact_sales")
    assert check("SELECT 'InsertCommand reflect( ScriptTransformation' AS w") is None
    assert check("WITH a AS (SELECT 1 AS x) SELECT * FROM a JOIN range(3) ON x = id") is None
    assert check("SELECT count(*) FROM fact_sales f WHERE EXISTS (SELECT 1 FROM dim_stores s WHERE s.store_key = f.store_key)") is None


@pytest.mark.parametrize("kind", ["text", "csv", "json", "parquet", "orc", "binaryFile"])
def test_sandbox_reads_no_files(spark, gold, tmp_path, kind):
    t = gold.tables(spark)
    path = str(tmp_path / "x")
    df = spark.createDataFrame([("secret",)], "value string")
    (df.write.format(kind) if kind != "binaryFile" else df.write.format("text")).save(path)
    for sql in (f"SELECT * FROM `{kind}`.`{path}`", f"SELECT * FROM {kind}./* x */`{path}`", f"SELECT * FROM {kind} . `{path}`", f"SELECT (SELECT count(*) FROM `{kind}`.`{path}`)"):
        assert not assistant.run_sandbox(spark, t, sql).success, sql
    # a view over files outside the warehouse is a leaf that is not its own
    spark.read.format(kind).load(path).createOrReplaceTempView("foreign_files")
    for sql in ("SELECT * FROM foreign_files", "SELECT 1 WHERE EXISTS (SELECT 1 FROM foreign_files)", "WITH a AS (SELECT * FROM foreign_files) SELECT count(*) FROM a"):
        refused = assistant.run_sandbox(spark, t, sql)
        assert not refused.success and "outside the warehouse" in refused.error, sql
    spark.catalog.dropTempView("foreign_files")
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


def _values(row):
    """The row's values, doubles by their cents."""
    return [round(v, 2) if isinstance(v, float) else v for v in row]


@pytest.mark.parametrize("intent", list(intents.TEMPLATES))
def test_statement_and_mart_of_an_intent_agree(spark, gold, intent):
    t = gold.tables(spark)
    res = assistant.run_sandbox(spark, t, intents.statement(intent))
    assert res.success, res.error
    mart = intents.mart(intent, t)
    assert res.data.columns == mart.columns
    rows = [_values(r) for r in mart.collect()]
    assert [_values(r) for r in res.data.collect()] == rows and rows


def test_answer_records(spark, gold):
    t = gold.tables(spark)
    qs = spark.createDataFrame([("per category", 1), ("hello", 2), (None, 3), ("the trend", 4), ("per category", 5)], "q string, key long")
    records = assistant.answer_records(qs, "q", t)
    assert dict(records.dtypes)["data"] == "variant"
    rows = {r.key: r for r in records.collect()}
    assert len(rows) == 5 and all(r.success and r.error is None and r.stored is None for r in rows.values())
    assert rows[1].intent == rows[5].intent == "category" and rows[2].intent == rows[3].intent == "default"
    for r in rows.values():
        assert r.sql == intents.statement(r.intent)
        mart = intents.mart(r.intent, t)
        got = r.data.toPython()
        assert [[float(x[c]) if not isinstance(x[c], str) else x[c] for c in mart.columns] for x in got] == [[float(v) if not isinstance(v, str) else v for v in m] for m in mart.collect()]


def test_a_failing_intent_has_its_error_and_spares_the_others(spark, gold):
    t = gold.tables(spark)
    broken = {**t, "dim_time": t["dim_time"].drop("year")}
    qs = spark.createDataFrame([("trend",), ("customers",)], "q string")
    rows = {r.intent: r for r in assistant.answer_records(qs, "q", broken).collect()}
    assert not rows["trend"].success and rows["trend"].data is None and "UNRESOLVED_COLUMN" in rows["trend"].error
    assert rows["customer"].success and rows["customer"].error is None and len(rows["customer"].data.toPython()) <= 10
    missing = {k: v for k, v in t.items()} | {"dim_customers": spark.read.schema(t["dim_customers"].schema).parquet(gold.version_path + "/dim_customers").where(F.raise_error(F.lit("lost block")).isNull())}
    rows = {r.intent: r for r in assistant.answer_records(qs, "q", missing).collect()}
    assert rows["trend"].success and not rows["customer"].success and "lost block" in rows["customer"].error


def test_a_large_result_is_written(spark, gold, monkeypatch):
    t = gold.tables(spark)
    monkeypatch.setattr(assistant, "PACK_ROWS", 3)
    found = {r.intent: r for r in assistant.answers(spark, t, ["category", "trend"]).collect()}
    data, path = assistant.packed(intents.mart("category", t), 3)
    assert data is None and spark.read.parquet(path).count() == intents.mart("category", t).count() > 3
    data, path = assistant.packed(intents.mart("category", t).limit(3), 3)
    assert path is None and data.count("Category") == 3
    assert all(r.success and r.data is None and r.stored for r in found.values())


def test_no_questions(spark, gold):
    qs = spark.createDataFrame([], "q string")
    assert assistant.answer_records(qs, "q", gold.tables(spark)).collect() == []


EXTRACT = "pos_no long, `Customer Name` string, `Customer Segment` string, City string, State string"


def emails(spark, names):
    df = spark.createDataFrame([(p, n, None, "c", "s") for p, n in names], EXTRACT)
    return {r.pos: r.email.split("@")[0] for r in registry.build_registry(df, "pos_no").emails.collect()}


def test_email_chains(spark):
    assert emails(spark, [(0, "Ann Lee"), (2, "Ann  Lee"), (5, "Ann Lee2")]) == {0: "ann.lee", 2: "ann.lee2", 5: "ann.lee25"}
    # the appended address comes later than its own holder: both keep it, as the sequence gives it
    assert emails(spark, [(0, "Ann Lee"), (1, "Ann Lee7"), (7, "Ann  Lee")]) == {0: "ann.lee", 1: "ann.lee7", 7: "ann.lee7"}
    assert emails(spark, [(3, "X Y"), (4, "X  Y"), (5, "X Y4"), (6, "X  Y4"), (7, "X Y45"), (8, "X Y456")]) == {
        3: "x.y", 4: "x.y4", 5: "x.y45", 6: "x.y46", 7: "x.y457", 8: "x.y456"}
    assert emails(spark, [(0, "Cher"), (1, "Cher "), (2, "")]) == {0: "cher.cust", 1: "cher.cust1", 2: "user.cust"}


def _sequential(names):
    """Addresses as a loop over the customers gives them."""
    seen, out = set(), {}
    for p, n in names:
        parts = n.split()
        stem = f"{parts[0].lower() if parts else 'user'}.{parts[-1].lower() if len(parts) > 1 else 'cust'}"
        mail = stem if stem not in seen else f"{stem}{p}"
        seen.add(mail)
        out[p] = mail
    return out


def test_a_long_chain_and_random_chains(spark):
    import random

    chain, name = [(0, "A B"), (1, "A  B")], "A B1"
    for p in range(2, 14):
        chain.append((p, name))
        name += str(p)
    got = emails(spark, chain)
    assert got == _sequential(chain) and got[13] == "a." + name[2:].lower()
    rnd = random.Random(11)
    for _ in range(3):
        names = [(p, f"{rnd.choice('XY')}{' ' * rnd.randint(1, 9)}{rnd.choice('LM')}{rnd.choice(['', '', rnd.randrange(30), f'{rnd.randrange(9)}{rnd.randrange(30)}'])}") for p in range(60)]
        names = [(p, n) for k, (p, n) in enumerate(names) if n not in {m for _, m in names[:k]}]
        assert emails(spark, names) == _sequential(names)


def test_rounds_of_a_chain_leave_no_checkpoints(spark):
    rows = [(0, "A B"), (1, "A  B"), (2, "A B1"), (3, "A B12"), (4, "A B123")]
    from lakestar.plans import gold as gold_plan

    joined = spark.createDataFrame(
        [(p, f"a.b{s}@superstore.com", f"a.b{s}{p}@superstore.com", p == 1) for (p, _), s in zip(rows, ["", "", "1", "12", "123"])], "pos long, base_email string, appended string, _taken boolean"
    )
    before = gold_plan.staging_folders(spark)
    reached = registry.chained_heads(joined)
    assert sorted(r.pos for r in reached.collect()) == [2, 3, 4]
    assert len(gold_plan.staging_folders(spark) - before) == 1


def test_load_is_refused_if_an_address_is_twice(spark, tmp_path):
    rows = [(0, "Ann Lee", "Corporate", "A", "X"), (1, "Ann Lee7", None, "A", "X"), (7, "Ann  Lee", None, "B", "Y")]
    root = str(tmp_path / "registry")
    good = registry.build_registry(spark.createDataFrame(rows[:2], EXTRACT), "pos_no")
    registry.write_registry(good, root)
    current = gold_mod.current_version_path(spark, root)
    with pytest.raises(ValueError, match="registry key"):
        registry.write_registry(registry.build_registry(spark.createDataFrame(rows, EXTRACT), "pos_no"), root)
    with pytest.raises(ValueError, match="text length"):
        registry.write_registry(registry.build_registry(spark.createDataFrame([(0, "a" * 101, None, "A", "X")], EXTRACT), "pos_no"), root)
    assert gold_mod.current_version_path(spark, root) == current


def test_plain_extract_is_numbered_by_its_place(spark, tmp_path):
    for name, rows in (("b.csv", [("Dan", "E")]), ("a.csv", [("Bob Lee", "C"), ("Ann Lee", "D"), ("Bob  Lee", "C")])):
        (tmp_path / name).write_text("Row ID,Customer Name,City,State\n" + "".join(f"99,{n},{c},S\n" for n, c in rows))
    reg = registry.build_registry(readers.read_orders_extract(spark, str(tmp_path)))
    got = [(r.customer_id, r.customer_name, r.email.split("@")[0], r.country, r.membership_tier) for r in reg.customers.orderBy("customer_id").collect()]
    assert got == [(1, "Bob Lee", "bob.lee", "United States", "Gold"), (2, "Ann Lee", "ann.lee", "Canada", "Gold"),
                   (3, "Bob  Lee", "bob.lee2", "United Kingdom", "Gold"), (4, "Dan", "dan.cust", "Germany", "Gold")]
    assert [(r.city, r.country) for r in reg.stores.orderBy("store_id").collect()] == [("C", "United States"), ("D", "Canada"), ("E", "Germany")]


def test_all_outlets_unless_limited(spark):
    df = spark.createDataFrame([(i, "n", None, f"c{i}", "s") for i in range(130)], EXTRACT)
    assert registry.build_registry(df, "pos_no").stores.count() == 130
    assert [r.city for r in registry.build_registry(df, "pos_no", max_stores=3).stores.orderBy("store_id").collect()] == ["c0", "c1", "c2"]
