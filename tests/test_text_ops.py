"""Guard, router and fence extraction on literal tables, written out by hand."""

import pytest
from pyspark.sql import functions as F

from lakestar.functions.guard import FORBIDDEN_KEYWORDS, extract_sql_block, sandbox_violation, with_intent, with_sql_guard

NOT_READ_ONLY = "Security Guardrail Blocked: Only SELECT or WITH read-only queries are permitted."
# statement -> the keyword it is refused for, None when it passes, "" when it does not start as a query
STATEMENTS = {
    "DROP": "DROP",
    "delete x": "DELETE",
    "Update x": "UPDATE",
    "SELECT 'DROP' FROM t": "DROP",
    "SELECT updated_at FROM t": None,
    "SELECT replace(x,'a','b') FROM t": "REPLACE",
    "INSERT INTO t SELECT 1 -- DROP": "DROP",
    "-- note\nSELECT 1": "",
    "WITH a AS (SELECT 1) SELECT * FROM a": None,
    "SELECT 1; SELECT 2": None,
    "SELECTED 1": None,
    "  select 1  ": None,
    "\u00a0SELECT 1": None,
    "\u00e9DROP table": "",
    "DROP\u00e9": "",
    "insert_date": "",
    "SELECT * FROM \u00c9CREATE": None,
    "": "",
    "EXPLAIN SELECT 1": "",
}


def test_guard_on_literal_statements(spark):
    df = spark.createDataFrame([(s,) for s in STATEMENTS], "s string")
    got = {r.s: (r.is_safe, r.reason) for r in with_sql_guard(df, "s").collect()}
    for statement, keyword in STATEMENTS.items():
        if keyword is None:
            assert got[statement] == (True, ""), statement
        elif keyword == "":
            assert got[statement] == (False, NOT_READ_ONLY), statement
        else:
            message = f"Destructive SQL Operation Blocked: Contains forbidden keyword '{keyword}'."
            assert got[statement] == (False, message), statement


@pytest.mark.parametrize("shape", ["{k}", "SELECT {k}", "select {l} from t", "WITH x AS ({k}", "SELECT (1){k}-1"])
def test_a_lone_keyword_is_always_refused(spark, shape):
    df = spark.createDataFrame([(shape.format(k=k, l=k.lower()),) for k in FORBIDDEN_KEYWORDS], "s string")
    assert all(not r.is_safe and "forbidden keyword" in r.reason for r in with_sql_guard(df, "s").collect())


@pytest.mark.parametrize("shape", ["SELECT x{k}", "SELECT {k}_1", "SELECT {k}s", "SELECT \u00e9{k}", "SELECT 1{k}"])
def test_a_keyword_inside_a_word_is_not(spark, shape):
    df = spark.createDataFrame([(shape.format(k=k),) for k in FORBIDDEN_KEYWORDS], "s string")
    assert all(r.is_safe for r in with_sql_guard(df, "s").collect())


QUESTIONS = {
    "Sales for each category, please": "category",
    "categories by customer": "category",
    "Which customer bought most?": "customer",
    "who is our Top Spender": "customer",
    "how much do they spend": "customer",
    "units by country": "country",
    "REGION split": "country",
    "my location": "country",
    "sales per month": "trend",
    "yearly": "trend",
    "a trend by region": "country",
    "our margin": "profit",
    "profit per category": "category",
    "Compare all countries by turnover": "default",
    "nothing here": "default",
    "": "default",
}


def test_router_on_literal_questions(spark):
    df = spark.createDataFrame([(s,) for s in QUESTIONS], "s string")
    assert {r.s: r.intent for r in with_intent(df, "s").collect()} == QUESTIONS


REPLIES = {
    "Here:\n```sql\nSELECT 1\n```\nbye": "SELECT 1",
    "no fence SELECT 2": "no fence SELECT 2",
    "```sql\n```": "",
    "```SQL\nSELECT 3\n```": "SQL\nSELECT 3",
    "```sql SELECT 4 ``` and ```sql SELECT 5 ```": "SELECT 4",
    "  ```sql\n  SELECT 6  \n```  ": "SELECT 6",
    "```\nSELECT 7\n```": "SELECT 7",
    "open ```sql SELECT 8": "open  SELECT 8",
}


def test_fence_extraction_on_literal_replies(spark):
    df = spark.createDataFrame([(s,) for s in REPLIES], "s string")
    assert {r.s: r.x for r in df.select("s", extract_sql_block(F.col("s")).alias("x")).collect()} == REPLIES


def test_sandbox_rules(spark):
    cases = {
        "SELECT java_method('java.lang.Math','abs',-1)": "java_method",
        "SELECT reflect('a','b')": "java_method",
        "SELECT TRANSFORM(a) USING 'cat' FROM t": "script_transform",
        "SELECT * FROM parquet.`/x`": "path_table",
        "SELECT 1; SELECT 2": "multi_statement",
        "SELECT 1;": None,
        "SELECT transform(array(1), x -> x + 1)": None,
        "SELECT * FROM fact_sales": None,
    }
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    got = {r.s: r.v for r in df.select("s", sandbox_violation(F.col("s")).alias("v")).collect()}
    assert got == cases
