"""Column expressions built only from Spark built-ins (no Python UDFs)."""

from lakestar.functions.numeric import half_even_round, sqlite_round, safe_ratio
from lakestar.functions.text import py_strip, title_case, txn_id, period_label
from lakestar.functions.keys import stable_key
from lakestar.functions.guard import (
    with_sql_guard,
    with_intent,
    extract_sql_block,
    sandbox_violation,
)

__all__ = [
    "half_even_round",
    "sqlite_round",
    "safe_ratio",
    "py_strip",
    "title_case",
    "txn_id",
    "period_label",
    "stable_key",
    "with_sql_guard",
    "with_intent",
    "extract_sql_block",
    "sandbox_violation",
]
