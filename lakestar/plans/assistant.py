"""Questions and ad-hoc SQL over the warehouse.

``answer_batch`` routes a whole table of questions at once: each question is
tagged with its intent (one expression over the column), and each intent that
occurs is computed once as its mart - not once per question. ``run_sandbox``
executes read-only SQL over temporary views of the gold tables after the
keyword/prefix guard and the Spark-specific rules.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.functions.guard import extract_sql_block, guard_reason, sandbox_violation, with_intent, with_sql_guard
from lakestar.plans import intents
from lakestar.session import concurrently, work_dir


@dataclass
class BatchAnswer:
    routed: DataFrame
    results: dict[str, DataFrame]


def answer_batch(questions: DataFrame, col: str, tables: dict[str, DataFrame]) -> BatchAnswer:
    """Runs one job at once, which finds the intents that occur (six at most)."""
    routed = with_intent(questions, col)
    return BatchAnswer(routed, {i: intents.mart(i, tables) for i in present_intents(routed)})


def present_intents(routed: DataFrame) -> list[str]:
    return sorted(r[0] for r in routed.select("intent").distinct().collect())  # six at most


#: Rows up to which a result is packed into its record; a larger one is written as a table.
PACK_ROWS = 10_000
ANSWER = "intent string, sql string, success boolean, data string, stored string, error string"


def answers(spark: SparkSession, tables: dict[str, DataFrame], wanted: list[str] | None = None) -> DataFrame:
    """(intent, sql, success, data, stored, error): a row for each intent, at most six.

    Each statement is judged once, and its mart run once, at once and next to
    the others. ``data`` is the result as a VARIANT: an array with an object
    for each row, in order. A result of more than ``PACK_ROWS`` rows is written
    below the work folder instead, and ``stored`` names the place. Whatever
    fails while one intent is planned or run is that intent's ``error``.
    """
    wanted = list(intents.TEMPLATES) if wanted is None else wanted
    judged = with_sql_guard(spark.createDataFrame([(i, intents.statement(i)) for i in wanted], "intent string, sql string"), "sql").collect()

    def answer(row) -> tuple:
        if not row["is_safe"]:
            return row["intent"], row["sql"], False, None, None, row["reason"]
        try:
            data, stored = packed(intents.mart(row["intent"], tables), PACK_ROWS)
        except (PySparkException, Py4JError) as exc:
            return row["intent"], row["sql"], False, None, None, str(exc)
        return row["intent"], row["sql"], True, data, stored, None

    rows = concurrently([lambda r=r: answer(r) for r in judged]) if judged else []
    return spark.createDataFrame(rows, ANSWER).withColumn("data", F.parse_json("data"))


def packed(result: DataFrame, most: int) -> tuple[str | None, str | None]:
    """(JSON array of the rows, None) of a small result, (None, path) of a large one."""
    as_json = result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    rows = as_json.limit(most + 1).collect()
    if len(rows) <= most:
        return f"[{','.join(r[0] for r in rows)}]", None
    path = f"{work_dir(result.sparkSession)}/answers/{uuid.uuid4().hex}"
    result.write.parquet(path)
    return None, path


def answer_records(questions: DataFrame, col: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The questions with the record of their answer: intent, statement,
    ``success``, ``data`` (or the place where it is ``stored``) and ``error``,
    as in ``answers``. Runs the intents that occur at once; the questions
    themselves are only routed and joined with these few rows."""
    routed = with_intent(questions, col)
    return with_answers(routed, answers(questions.sparkSession, tables, present_intents(routed)))


def with_answers(routed: DataFrame, found: DataFrame) -> DataFrame:
    """Six rows of ``PACK_ROWS`` result rows at most are broadcast to the questions."""
    return routed.join(F.broadcast(found), "intent", "left")


@dataclass
class SandboxResult:
    success: bool
    sql: str
    data: DataFrame | None
    error: str | None


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def check_statement(spark: SparkSession, sql: str) -> str | None:
    """Refusal reason for one statement (guard first, then added rules)."""
    row = (
        spark.createDataFrame([(sql,)], "s string")
        .select(guard_reason(F.col("s")).alias("g"), sandbox_violation(F.col("s")).alias("v"))
        .first()
    )
    if row["g"]:
        return row["g"]
    if row["v"]:
        return f"Sandbox rule blocked: {row['v']}."
    return None


_COMMAND = "org.apache.spark.sql.catalyst.plans.logical.Command"
_REFLECTION = ("CallMethodViaReflection", "TryReflect")
_SUBQUERIES = ("ScalarSubquery", "ListQuery", "Exists", "LateralSubquery", "FunctionTableSubqueryArgumentExpression")
# leaves that read nothing
_CONSTANT_LEAVES = ("LocalRelation", "OneRowRelation", "CTERelationRef", "Range", "EmptyRelation")


def _items(seq):
    return [seq.apply(i) for i in range(seq.size())]


def _expressions(node):
    stack = _items(node.expressions())
    while stack:
        e = stack.pop()
        yield e
        stack.extend(_items(e.children()))


def _nodes(plan):
    """Nodes of a logical plan, those of its subqueries included."""
    stack = [plan]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(_items(node.children()))
        for e in _expressions(node):
            if e.getClass().getSimpleName() in _SUBQUERIES:
                stack.append(e.plan())


def _roots(leaf) -> frozenset[str]:
    """Paths that a file relation reads; nothing for any other leaf."""
    if leaf.getClass().getSimpleName() != "LogicalRelation":
        return frozenset()
    relation = leaf.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return frozenset()
    return frozenset(p.toString() for p in _items(relation.location().rootPaths()))


def table_roots(tables: dict[str, DataFrame]) -> frozenset[str]:
    """Paths of the version's own tables."""
    return frozenset(r for df in tables.values() for leaf in _items(df._jdf.queryExecution().analyzed().collectLeaves()) for r in _roots(leaf))


def analysed(spark: SparkSession, sql: str):
    """The analysed plan of a statement; nothing is executed, commands neither."""
    state = spark._jsparkSession.sessionState()
    skip = spark.sparkContext._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
    return state.executePlan(state.sqlParser().parsePlan(sql.strip().rstrip(";")), skip).analyzed()


def plan_violation(spark: SparkSession, sql: str, allowed: frozenset[str]) -> str | None:
    """Second line behind the text rules: the plan's node classes, not its
    text. Commands, scripts and reflection are refused, and so is every leaf
    that reads anything but the tables' own files. Statements that fail
    analysis are left to the execution step, which reports the error."""
    try:
        plan = analysed(spark, sql)
    except Exception:  # noqa: BLE001 - reported when the statement runs
        return None
    command = spark.sparkContext._jvm.java.lang.Class.forName(_COMMAND)
    for node in _nodes(plan):
        name = node.getClass().getSimpleName()
        if command.isInstance(node) or name == "ScriptTransformation":
            return name
        for e in _expressions(node):
            if e.getClass().getSimpleName() in _REFLECTION:
                return e.getClass().getSimpleName()
        if not node.children().size() and name not in _CONSTANT_LEAVES:
            roots = _roots(node)
            if not roots or not roots <= allowed:
                return f"{name} outside the warehouse"
    return None


@contextmanager
def _no_paths_as_tables(spark: SparkSession):
    """Within, ``format.`path``` is no table name."""
    key = "spark.sql.runSQLOnFiles"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_sandbox(spark: SparkSession, tables: dict[str, DataFrame], sql: str, from_reply: bool = False) -> SandboxResult:
    if from_reply:
        sql = spark.createDataFrame([(sql,)], "s string").select(extract_sql_block(F.col("s"))).first()[0]
    reason = check_statement(spark, sql)
    if reason:
        return SandboxResult(False, sql, None, reason)
    own = {n: df for n, df in tables.items() if not n.startswith("_")}
    register_views(own)
    with _no_paths_as_tables(spark):
        found = plan_violation(spark, sql, table_roots(own))
        if found:
            return SandboxResult(False, sql, None, f"Sandbox plan check blocked: {found}.")
        try:
            # analysis resolves all tables here; execution reads what it resolved
            return SandboxResult(True, sql, spark.sql(sql.strip().rstrip(";")), None)
        except Exception as exc:  # noqa: BLE001 - reported like the original
            return SandboxResult(False, sql, None, str(exc))
