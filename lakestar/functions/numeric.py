"""Rounding and ratios.

Two rounding rules live side by side, as in the modelled system:

* transforms (unit cost, revenue, profit) round like pandas ``Series.round``:
  ``rint(x * 10^d) / 10^d``, half to even on the scaled binary value;
* reporting queries round like SQLite ``ROUND``: the shortest decimal form of
  the double, half away from zero. Spark's own ``round`` on a double works on
  the exact binary value (341.915 -> 341.91) and so differs; casting to a
  decimal first goes through the decimal string and matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even_round(col: Column, digits: int = 2) -> Column:
    scale = float(10**digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def sqlite_round(col: Column, digits: int = 2) -> Column:
    return F.round(col.cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(num, den)
