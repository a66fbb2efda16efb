"""Distributed building blocks: numbering, keep-first, lookups, constraint checks."""

from lakestar.operators.numbering import stage_ordered, number_rows
from lakestar.operators.dedup import keep_first, first_per_key
from lakestar.operators.lookup import lookup_join, broadcast_if_small

__all__ = [
    "stage_ordered",
    "number_rows",
    "keep_first",
    "first_per_key",
    "lookup_join",
    "broadcast_if_small",
]
