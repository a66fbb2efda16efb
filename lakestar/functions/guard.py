"""Text operators over columns of SQL statements, questions and model replies.

The modelled system applies these to one string at a time; here each is a
column expression, so a whole table of statements/questions is audited or
routed in one Spark job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.text import WHITESPACE_CLASS, py_strip

# ---------------------------------------------------------------------------
# Fixed values that must equal the modelled system's for identical results:
# the forbidden keywords (checked in this order), the two refusal messages,
# the routing keywords per intent (first matching intent wins) and the
# fenced-block pattern.
FORBIDDEN_KEYWORDS = [
    "DROP", "DELETE", "UPDATE", "INSERT", "ALTER",
    "TRUNCATE", "REPLACE", "CREATE", "GRANT", "PRAGMA",
]
KEYWORD_MESSAGE = "Destructive SQL Operation Blocked: Contains forbidden keyword '{kw}'."
PREFIX_MESSAGE = "Security Guardrail Blocked: Only SELECT or WITH read-only queries are permitted."
READ_ONLY_PREFIXES = ["SELECT", "WITH"]
INTENT_KEYWORDS = [
    ("category", ["category", "categories"]),
    ("customer", ["customer", "spend", "top spender"]),
    ("country", ["country", "region", "location"]),
    ("trend", ["month", "year", "trend"]),
    ("profit", ["profit", "margin"]),
]
DEFAULT_INTENT = "default"
FENCE_OPEN = "```sql"
FENCE_CLOSE = "```"
# ---------------------------------------------------------------------------

# Python's \b in a str pattern: word characters are letters, digits and "_".
_WORD = "[\\p{L}\\p{N}_]"


def keyword_pattern(kw: str) -> str:
    return f"(?<!{_WORD}){kw}(?!{_WORD})"


def _any_keyword_pattern() -> str:
    return f"(?<!{_WORD})(?:{'|'.join(FORBIDDEN_KEYWORDS)})(?!{_WORD})"


# Java's look-behind does not see a supplementary-plane character as one code
# point, so keyword boundaries are tested on a view of the text in which such
# letters/digits become "X" (a letter in no keyword) and the rest a space.
_SUPPLEMENTARY_WORD = "[\\x{10000}-\\x{10FFFF}&&[\\p{L}\\p{N}]]"
_SUPPLEMENTARY = "[\\x{10000}-\\x{10FFFF}]"


def bmp_word_view(col: Column) -> Column:
    # the replacements only run on the (rare) texts holding such characters
    return F.when(
        col.rlike(_SUPPLEMENTARY),
        F.regexp_replace(F.regexp_replace(col, _SUPPLEMENTARY_WORD, "X"), _SUPPLEMENTARY, " "),
    ).otherwise(col)


def guard_reason(col: Column, prepared: tuple[Column, Column] | None = None) -> Column:
    """Refusal message of the read-only check, NULL when the statement passes.
    ``prepared``: the upper-cased stripped text and its BMP view, when the
    caller has them as columns already."""
    if prepared is None:
        u = F.upper(py_strip(col))
        w = bmp_word_view(u)
    else:
        u, w = prepared
    per_keyword = F.coalesce(
        *[
            F.when(w.rlike(keyword_pattern(kw)), F.lit(KEYWORD_MESSAGE.format(kw=kw)))
            for kw in FORBIDDEN_KEYWORDS
        ]
    )
    read_only = None
    for prefix in READ_ONLY_PREFIXES:
        cond = u.startswith(prefix)
        read_only = cond if read_only is None else (read_only | cond)
    return (
        F.when(w.rlike(_any_keyword_pattern()), per_keyword)
        .when(~read_only, F.lit(PREFIX_MESSAGE))
    )


def with_sql_guard(df: DataFrame, col: str, safe_col: str = "is_safe", reason_col: str = "reason") -> DataFrame:
    # the normalised text is a column of its own (a separate projection), so
    # the strip/upper/view work runs once per row, not once per CASE branch
    prepared = df.withColumn("__u", F.upper(py_strip(F.col(col)))).withColumn("__w", bmp_word_view(F.col("__u")))
    reason = guard_reason(F.col(col), (F.col("__u"), F.col("__w")))
    return (
        prepared.withColumn(reason_col, F.coalesce(reason, F.lit("")))
        .withColumn(safe_col, F.col(reason_col) == F.lit(""))
        .drop("__u", "__w")
    )


def intent(col: Column) -> Column:
    p = F.lower(col)
    expr = None
    for name, words in INTENT_KEYWORDS:
        cond = None
        for w in words:
            c = p.contains(w)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DEFAULT_INTENT))


def with_intent(df: DataFrame, col: str, out: str = "intent") -> DataFrame:
    return df.withColumn(out, intent(F.col(col)))


_FENCE_RE = f"(?s){FENCE_OPEN}{WHITESPACE_CLASS}*(.*?){WHITESPACE_CLASS}*{FENCE_CLOSE}"
_FENCE_STRIP_RE = f"{FENCE_OPEN}|{FENCE_CLOSE}"


def extract_sql_block(col: Column) -> Column:
    """SQL from a model reply: the first ```sql fenced block (stripped), or the
    whole stripped reply when there is none; then any remaining fence markers
    are removed and the result stripped again."""
    content = py_strip(col)
    picked = F.when(content.rlike(_FENCE_RE), py_strip(F.regexp_extract(content, _FENCE_RE, 1))).otherwise(content)
    return py_strip(F.regexp_replace(picked, _FENCE_STRIP_RE, ""))


# Spark-specific holes of a prefix/keyword check: these start with SELECT and
# still run JVM code, external processes or read arbitrary paths.
_SANDBOX_RULES = [
    ("java_method", "(?<![\\p{L}\\p{N}_])(JAVA_METHOD|TRY_REFLECT|REFLECT)(?![\\p{L}\\p{N}_])"),
    ("script_transform", "(?s)(?<![\\p{L}\\p{N}_])TRANSFORM(?![\\p{L}\\p{N}_]).*(?<![\\p{L}\\p{N}_])USING(?![\\p{L}\\p{N}_])"),
    ("path_table", "(?<![\\p{L}\\p{N}_])(PARQUET|CSV|JSON|ORC|TEXT|AVRO|BINARYFILE|JDBC)\\s*\\.\\s*`"),
    ("multi_statement", ";[\\s;]*\\S"),
]


def sandbox_violation(col: Column) -> Column:
    """Name of the first added sandbox rule a statement breaks, else NULL.

    Text checks are not a sandbox: the assistant also checks the analysed plan
    and refuses paths as table names.
    """
    u = bmp_word_view(F.upper(py_strip(col)))
    return F.coalesce(*[F.when(u.rlike(p), F.lit(name)) for name, p in _SANDBOX_RULES])
