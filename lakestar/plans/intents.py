"""Question templates: one definition each, from which both the mart and the
statement of an answer's record are made, so that they cannot drift apart.

A template sums figures of the fact over attributes of one dimension. The mart
reduces the fact to a row for each dimension key before it joins (as all marts
do); the statement says the same in SQL, with the same integer cents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.functions.numeric import sqlite_round
from lakestar.plans import marts
from lakestar.plans.marts import Tables


@dataclass(frozen=True)
class Figure:
    """A sum over the fact: its column in the reduced fact, how a row of the reduced fact gets it, and whether it is money in cents."""

    column: str
    per_key: str
    money: bool = False

    @property
    def total(self) -> str:
        return f"SUM(s.{self.column}) / 100e0" if self.money else f"SUM(s.{self.column})"


FIGURES = {
    "orders": Figure("orders", "COUNT(sales_key)"),
    "units": Figure("units", "SUM(quantity)"),
    "revenue": Figure("revenue_c", "SUM(CAST(ROUND(total_revenue * 100) AS BIGINT))", money=True),
    "profit": Figure("profit_c", "SUM(CAST(ROUND(total_profit * 100) AS BIGINT))", money=True),
}


@dataclass(frozen=True)
class Template:
    """``attributes`` and ``figures`` are (name, label); ``each_key`` reports every dimension key
    instead of every combination of attributes. Rows go by the labels in ``descending``, ties by the
    attributes (by the key where each is reported)."""

    dimension: str
    key: str
    attributes: tuple[tuple[str, str], ...]
    figures: tuple[tuple[str, str], ...]
    descending: tuple[str, ...]
    each_key: bool = False
    limit: int | None = None

    @property
    def ties(self) -> list[str]:
        return [self.key] if self.each_key else [label for _, label in self.attributes if label not in self.descending]

    def mart(self, tables: Tables) -> DataFrame:
        if self.dimension == "dim_time" and self.limit:
            tables = {**tables, "fact_sales": marts.latest_months(tables, self.limit)}
        names = [name for name, _ in self.attributes]
        joined = marts._fact_by(tables, self.key).join(tables[self.dimension].select(self.key, *names), self.key)
        rows = joined if self.each_key else marts._rollup(joined, *names)
        shown = [F.col(name).alias(label) for name, label in self.attributes]
        for name, label in self.figures:
            f = FIGURES[name]
            shown.append((sqlite_round(marts.money(f.column)) if f.money else F.col(f.column)).alias(label))
        if self.each_key:
            shown.append(F.col(self.key))
        rows = rows.select(*shown).orderBy(*[F.desc(c) for c in self.descending], *[F.asc(c) for c in self.ties])
        rows = rows.limit(self.limit) if self.limit else rows
        return rows.drop(self.key)

    def statement(self) -> str:
        reduced = ", ".join(f"{FIGURES[n].per_key} AS {FIGURES[n].column}" for n, _ in self.figures)
        shown = [f"d.{n} AS {label}" for n, label in self.attributes] + [f"{FIGURES[n].total} AS {label}" for n, label in self.figures]
        group = [f"d.{self.key}"] * self.each_key + [f"d.{n}" for n, _ in self.attributes]
        order = [f"{c} DESC" for c in self.descending] + ([f"d.{self.key}"] if self.each_key else self.ties)
        return (
            f"SELECT {', '.join(shown)} "
            f"FROM (SELECT {self.key}, {reduced} FROM fact_sales GROUP BY {self.key}) s "
            f"JOIN {self.dimension} d ON s.{self.key} = d.{self.key} "
            f"GROUP BY {', '.join(group)} ORDER BY {', '.join(order)}" + (f" LIMIT {self.limit}" if self.limit else "")
        )


@dataclass(frozen=True)
class Detail:
    """The first rows of the fact by key, with columns of its dimensions as (alias, column). Every fact
    row matches one row of each dimension (foreign keys are checked at build), so the rows are taken
    before the joins: the joins see ``limit`` rows, not the fact."""

    columns: tuple[tuple[str, str], ...]
    dimensions: tuple[tuple[str, str, str], ...]  # alias, table, key
    limit: int

    def mart(self, tables: Tables) -> DataFrame:
        own = [c for a, c in self.columns if a == "f"]
        rows = marts.head_of_fact(tables, self.limit).select("sales_key", *[k for _, _, k in self.dimensions], *own)
        for alias, table, key in self.dimensions:
            rows = rows.join(tables[table].select(key, *[c for a, c in self.columns if a == alias]), key)
        return rows.orderBy("sales_key").select(*[c for _, c in self.columns])

    def statement(self) -> str:
        joins = " ".join(f"JOIN {table} {alias} ON f.{key} = {alias}.{key}" for alias, table, key in self.dimensions)
        return f"SELECT {', '.join(f'{a}.{c}' for a, c in self.columns)} FROM fact_sales f {joins} WHERE f.sales_key <= {self.limit} ORDER BY f.sales_key"


# ---------------------------------------------------------------------------
# What each template reports, under which labels, in which order
# and how many rows; these equal the modelled system's.
TEMPLATES: dict[str, Template | Detail] = {
    "category": Template("dim_products", "product_key", (("category", "Category"),), (("revenue", "Revenue"), ("units", "Quantity_Sold")), ("Revenue",)),
    "customer": Template(
        "dim_customers", "customer_key", (("customer_name", "Customer"), ("country", "Country"), ("membership_tier", "Tier")), (("revenue", "Total_Spent"),), ("Total_Spent",), each_key=True, limit=10
    ),
    "country": Template("dim_customers", "customer_key", (("country", "Country"),), (("orders", "Orders"), ("revenue", "Revenue")), ("Revenue",)),
    "trend": Template("dim_time", "time_key", (("year", "Year"), ("month", "Month")), (("revenue", "Revenue"), ("profit", "Profit")), ("Year", "Month"), limit=12),
    "profit": Template("dim_products", "product_key", (("category", "Category"),), (("revenue", "Revenue"), ("profit", "Profit")), ("Profit",)),
    "default": Detail(
        (("f", "transaction_id"), ("c", "customer_name"), ("p", "product_name"), ("p", "category"), ("f", "total_revenue")),
        (("c", "dim_customers", "customer_key"), ("p", "dim_products", "product_key")),
        10,
    ),
}
# ---------------------------------------------------------------------------


def mart(intent: str, tables: Tables) -> DataFrame:
    return TEMPLATES[intent].mart(tables)


def statement(intent: str) -> str:
    return TEMPLATES[intent].statement()
