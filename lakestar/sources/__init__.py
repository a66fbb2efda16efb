"""Readers for the bronze sources and the mapping of the driver's test tables."""

from lakestar.sources.readers import (
    read_registry,
    read_catalogue,
    read_ledger,
    read_orders_extract,
    read_jdbc_table,
    choose_source,
)

__all__ = [
    "read_registry",
    "read_catalogue",
    "read_ledger",
    "read_orders_extract",
    "read_jdbc_table",
    "choose_source",
]
