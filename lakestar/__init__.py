"""lakestar: a Spark-native retail star-schema warehouse.

Bronze sources (customer/store registry, product catalogue, sales ledger) are
conformed into one sales fact and four dimensions with built-in Spark
expressions; marts, data-quality checks and text operators run as DataFrame
jobs on top of the written gold tables.
"""

__all__ = ["functions", "operators", "sources", "plans"]
