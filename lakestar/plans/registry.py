"""Customer/store registry derived from an orders extract.

Row position in the extract matters (first occurrence wins, country is
assigned cyclically from it, ids follow it): it is a column of the extract, or
the row's place in the files, numbered from 0 by ``positioned``.
"""

from __future__ import annotations

import time
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.text import first_token, last_token, py_strip
from lakestar.operators import quality
from lakestar.operators.dedup import keep_first
from lakestar.operators.lookup import broadcast_if_small, lookup_join
from lakestar.operators.numbering import number_in_file_order, number_rows, stage_ordered, target_partitions
from lakestar.plans import gold
from lakestar.session import checkpointed, discard
from lakestar.sources.readers import FILE_POSITION

# ---------------------------------------------------------------------------
# Fixed values of the registry derivation.
COUNTRIES = ["United States", "Canada", "United Kingdom", "Germany", "France", "Australia"]
SEGMENT_TIERS = {"Corporate": "Platinum", "Consumer": "Gold", "Home Office": "Silver"}
DEFAULT_TIER = "Gold"
EMAIL_DOMAIN = "@superstore.com"
DEFAULT_FIRST = "user"
DEFAULT_LAST = "cust"
STORE_PREFIX = "Superstore Hub - "
MISSING_TEXT = "nan"
# ---------------------------------------------------------------------------


def _text(col: str) -> Column:
    """``str(value).strip()`` with pandas' text for a missing value."""
    return py_strip(F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(MISSING_TEXT)))


def cyclic_country(position: Column) -> Column:
    arr = F.array(*[F.lit(c) for c in COUNTRIES])
    return F.element_at(arr, (F.pmod(position, F.lit(len(COUNTRIES))) + 1).cast("int"))


def segment_tier(segment: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in SEGMENT_TIERS.items() for x in kv])
    return F.coalesce(F.element_at(m, segment), F.lit(DEFAULT_TIER))


def positioned(extract: DataFrame, position_col: str | None = None) -> DataFrame:
    """The extract with its row position as ``pos``."""
    if position_col is not None:
        return extract.withColumnRenamed(position_col, "pos")
    return number_in_file_order(extract, list(FILE_POSITION), "pos", start=0)


def unique_customers(extract: DataFrame) -> DataFrame:
    """First extract row per raw customer name (map-side combined)."""
    return keep_first(extract.select("pos", "`Customer Name`", "`Customer Segment`"), ["Customer Name"], ["pos"])


def registry_emails(extract: DataFrame) -> DataFrame:
    """``first.last@domain``; an address that an earlier customer has gets the
    row position appended. An appended address counts as had from then on, so
    a later customer whose own address equals it is appended too.

    The first customer with an address is found by a min-position aggregate;
    those that chains of appended addresses reach are added by
    ``chained_heads``. Runs jobs at once.
    """
    name = _text("Customer Name")
    first, last = first_token(name, DEFAULT_FIRST), last_token(name, DEFAULT_LAST)
    stem = F.concat(first, F.lit("."), last)
    based = checkpointed(
        unique_customers(extract).select(
            "pos",
            name.alias("customer_name"),
            F.concat(stem, F.lit(EMAIL_DOMAIN)).alias("base_email"),
            F.concat(stem, F.col("pos").cast("string"), F.lit(EMAIL_DOMAIN)).alias("appended"),
            _text("Customer Segment").alias("segment"),
        )
    )
    heads = based.groupBy("base_email").agg(F.min("pos").alias("head"))
    joined = checkpointed(lookup_join(based, heads, "base_email", "inner").withColumn("_taken", F.col("pos") != F.col("head")))
    reached = chained_heads(joined)
    suffixed = F.col("_taken")
    if reached is not None:
        side, small = broadcast_if_small(reached.withColumn("_chained", F.lit(True)))
        joined = joined.join(side, "pos", "left")
        suffixed = suffixed | F.coalesce(F.col("_chained"), F.lit(False))
    return joined.select(
        "pos",
        "customer_name",
        "base_email",
        F.when(suffixed, F.col("appended")).otherwise(F.col("base_email")).alias("email"),
        suffixed.alias("suffixed"),
        "segment",
    )


def chained_heads(joined: DataFrame) -> DataFrame | None:
    """Positions of customers that are the first with their address, but whose
    address an earlier customer got appended; None if there are none.

    One pass matches all appended addresses with the later first customers that
    have them as their own (which end in a digit, as appended ones do): the
    links that a chain may take. Appended customers then pass the word on along
    these few links alone, round by round, each from those that the round
    before reached.
    """
    stem_end = F.col("base_email").substr(F.length("base_email") - len(EMAIL_DOMAIN), F.lit(1))
    heads = joined.where(~F.col("_taken") & stem_end.between("0", "9")).select(F.col("base_email").alias("appended"), F.col("pos").alias("to"))
    links = joined.select("appended", F.col("pos").alias("by"), "_taken").join(heads, "appended").where("by < to")
    links = checkpointed(links.select("by", "to", "_taken"))
    frontier = checkpointed(links.where("_taken").select(F.col("to").alias("pos")).distinct())
    if not frontier.limit(1).count():
        discard(frontier, links)
        return None
    reached = frontier
    while True:
        further = links.join(frontier.select(F.col("pos").alias("by")), "by").select(F.col("to").alias("pos")).distinct()
        further = checkpointed(further.join(reached, "pos", "left_anti"))
        if not further.limit(1).count():
            discard(further, links, *([frontier] if frontier is not reached else []))
            return reached
        grown = checkpointed(reached.union(further))
        discard(*{id(x): x for x in (reached, frontier)}.values())
        reached, frontier = grown, further


def registry_customers(emails: DataFrame, extract: DataFrame) -> DataFrame:
    staged = stage_ordered(emails, ["pos"], target_partitions(extract))
    return number_rows(staged, "customer_id").select(
        "customer_id",
        "customer_name",
        "email",
        cyclic_country(F.col("pos")).alias("country"),
        segment_tier(F.col("segment")).alias("membership_tier"),
    )


def registry_stores(extract: DataFrame, max_stores: int | None = None) -> DataFrame:
    """Outlets in the order of their first rows; ``max_stores`` keeps only the first so many."""
    outlets = keep_first(extract.select("pos", "City", "State"), ["City", "State"], ["pos"])
    stores = number_rows(stage_ordered(outlets, ["pos"], target_partitions(extract)), "store_id")
    if max_stores is not None:
        stores = stores.where(F.col("store_id") <= max_stores)
    return stores.select(
        "store_id",
        F.concat(F.lit(STORE_PREFIX), _text("City")).alias("store_name"),
        _text("City").alias("city"),
        _text("State").alias("state"),
        cyclic_country(F.col("pos")).alias("country"),
    )


class Registry:
    """Tables of one extract; each is only computed when it is asked for."""

    def __init__(self, extract: DataFrame, position_col: str | None = None, max_stores: int | None = None) -> None:
        self._source, self._position, self._max_stores = extract, position_col, max_stores

    @cached_property
    def extract(self) -> DataFrame:
        return positioned(self._source, self._position)

    @cached_property
    def emails(self) -> DataFrame:
        return registry_emails(self.extract)

    @cached_property
    def customers(self) -> DataFrame:
        return registry_customers(self.emails, self._source)

    @cached_property
    def stores(self) -> DataFrame:
        return registry_stores(self.extract, self._max_stores)


def build_registry(extract: DataFrame, position_col: str | None = None, max_stores: int | None = None) -> Registry:
    return Registry(extract, position_col, max_stores)


def check_registry(customers: DataFrame, stores: DataFrame) -> None:
    """What the registry's tables promise: unique ids and e-mails, no nulls, text within its lengths."""
    limits = quality.REGISTRY_MAX_LENGTHS
    quality.assert_clean(
        quality.key_violations([("customers", customers, "customer_id"), ("customers", customers, "email"), ("stores", stores, "store_id")]),
        ["duplicate_keys"], "registry key",
    )
    quality.assert_clean(
        quality.null_violations([("customers", customers, customers.columns), ("stores", stores, stores.columns)]),
        ["null_rows"], "registry NOT NULL",
    )
    quality.assert_clean(
        quality.length_violations([("customers", customers, limits["customers"]), ("stores", stores, limits["stores"])]),
        ["violations"], "registry text length",
    )


def write_registry(registry: Registry, root: str) -> dict[str, str]:
    """Set-based load of the registry tables (replaces row-by-row inserts) as a
    new version of ``root``; it becomes the current one only if it holds what
    the tables promise."""
    spark = registry.customers.sparkSession
    version = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    paths = {t: f"{root.rstrip('/')}/{version}/{t}" for t in ("customers", "stores")}
    registry.customers.write.parquet(paths["customers"])
    registry.stores.write.parquet(paths["stores"])
    check_registry(spark.read.parquet(paths["customers"]), spark.read.parquet(paths["stores"]))
    gold.write_small_file(spark, f"{root.rstrip('/')}/{gold.CURRENT_POINTER}", version + "\n")
    return paths
