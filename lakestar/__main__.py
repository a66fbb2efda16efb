"""Command line: ``python -m lakestar <command> ...``.

  registry  --extract CSV --out DIR [--position-column NAME] [--max-stores N] [--multi-line]
  build     --warehouse DIR SOURCES
  report    --warehouse DIR [--out DIR] [SOURCES]
  ask       --warehouse DIR "question ..." [--out DIR] [SOURCES]
  sql       --warehouse DIR "SELECT ..." [--out DIR] [--rows N] [SOURCES]

SOURCES are ``--customers P --stores P --catalogue P --ledger P``; of an option
given several times the first place that opens is read. ``--order-columns a:long,b:int`` names the ledger's order (default: file
order), ``--multi-line`` allows line breaks in quoted CSV fields,
``--date-format`` adds a format of ledger dates, ``--quarantine`` sets rows with
unreadable dates aside. With SOURCES, ``report``, ``ask`` and ``sql`` build a
warehouse that does not exist yet.

Results are printed whole, streamed partition by partition, or written as
Parquet with ``--out``; ``--rows`` prints the first so many only.

The session comes from ``SparkSession.builder`` (spark-submit settings
apply); a ``local[*]`` session is used when none is configured.
"""

from __future__ import annotations

import argparse
import itertools
import sys

from pyspark.sql import DataFrame, SparkSession


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("lakestar")
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    try:
        return builder.getOrCreate()
    except Exception:  # noqa: BLE001 - no master configured outside spark-submit
        from lakestar.session import local_session

        return local_session()


def _order_columns(spec: str) -> dict[str, str]:
    cols = {}
    for part in filter(None, spec.split(",")):
        name, _, typ = part.partition(":")
        cols[name.strip()] = (typ or "string").strip()
    return cols


def _print(df: DataFrame, rows: int | None = None) -> None:
    """All rows as tab-separated text (``rows``: the first so many), one partition in memory at a time."""
    print("\t".join(df.columns))
    for row in itertools.islice(df.toLocalIterator(), rows):
        print("\t".join("" if v is None else str(v) for v in row))


def _give(df: DataFrame, out: str | None, rows: int | None = None) -> None:
    if out:
        df.write.parquet(out)
        print(out)
    else:
        _print(df, rows)


def _first(name: str, paths: list[str], opened) -> DataFrame:
    """The first of several places that opens; the others are reported."""
    from lakestar.sources.readers import choose_source

    choice = choose_source([(p, lambda p=p: opened(p)) for p in paths])
    for place, error in choice.errors.items():
        print(f"{name}: {place} not read ({error})", file=sys.stderr)
    return choice.df


def _bronze(spark: SparkSession, args):
    from lakestar.plans import gold, silver
    from lakestar.sources import readers

    order = _order_columns(args.order_columns)
    if order:
        ledger = lambda p: readers.read_ledger(spark, p, order, args.multi_line)
    else:
        ledger = lambda p: readers.read_ledger_in_file_order(spark, p, args.multi_line)
    position = list(readers.FILE_POSITION)
    return gold.Bronze(
        customers=_first("customers", args.customers, lambda p: readers.read_registry(spark, p, "customers", file_order=True)),
        stores=_first("stores", args.stores, lambda p: readers.read_registry(spark, p, "stores")),
        products=_first("catalogue", args.catalogue, lambda p: readers.read_catalogue(spark, p, args.catalogue_array, file_order=True)),
        sales=_first("ledger", args.ledger, ledger),
        order_cols=list(order) or position,
        customer_order=position,
        product_order=position,
        dates=silver.DateRule((*args.date_format, *silver.DateRule().formats), args.quarantine),
    )


_SOURCES = ("customers", "stores", "catalogue", "ledger")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakestar")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("registry")
    p.add_argument("--extract", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--position-column", help="column of the row position (default: place in the files, from 0)")
    p.add_argument("--max-stores", type=int, help="only the first so many outlets (default: all)")
    p.add_argument("--multi-line", action="store_true")
    for name in ("build", "report", "ask", "sql"):
        p = sub.add_parser(name)
        p.add_argument("--warehouse", required=True)
        for source in _SOURCES:
            p.add_argument(f"--{source}", action="append", required=name == "build")
        p.add_argument("--order-columns", default="", help="ledger order, e.g. row_no:long (default: file order)")
        p.add_argument("--catalogue-array", action="store_true", help="catalogue files hold one JSON array each")
        p.add_argument("--multi-line", action="store_true", help="quoted CSV fields may hold line breaks")
        p.add_argument("--date-format", action="append", default=[], help="further format of ledger dates, e.g. d.M.yyyy")
        p.add_argument("--quarantine", action="store_true", help="set rows with unreadable dates aside")
        if name != "build":
            p.add_argument("--out", help="write the result here as Parquet")
        if name in ("ask", "sql"):
            p.add_argument("text")
        if name == "sql":
            p.add_argument("--rows", type=int, help="print the first so many rows (default: all)")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or _session()

    from lakestar.plans import assistant, gold, intents, registry, warehouse
    from lakestar.sources import readers

    if args.command == "registry":
        extract = readers.read_orders_extract(spark, args.extract, args.position_column, args.multi_line)
        print(registry.write_registry(registry.build_registry(extract, args.position_column, args.max_stores), args.out))
        return 0
    if args.command == "build":
        before = gold.staging_folders(spark)
        result = gold.build(spark, _bronze(spark, args), args.warehouse)
        for folder in (gold.staging_folders(spark) - before) | {result.staging}:
            gold.delete_path(spark, folder)
        print(result.version_path)
        for stage, rows in sorted(result.counts.items()):
            print(f"{stage:>20} {rows}")
        return 0
    if all(getattr(args, s) for s in _SOURCES):
        version = gold.ensure_warehouse(spark, args.warehouse, lambda: _bronze(spark, args))
    else:
        version = gold.current_version_path(spark, args.warehouse)
    tables = gold.open_tables(spark, version)
    if args.command == "report":
        for name, df in warehouse.run_all_reports(tables).items():
            print(f"--- {name}")
            _give(df, args.out and f"{args.out.rstrip('/')}/{name}")
        return 0
    if args.command == "ask":
        qs = spark.createDataFrame([(args.text,)], "question string")
        batch = assistant.answer_batch(qs, "question", tables)
        intent, result = next(iter(batch.results.items()))
        print(f"intent: {intent}\nsql: {intents.statement(intent)}")
        _give(result, args.out)
        return 0
    res = assistant.run_sandbox(spark, tables, args.text)
    if not res.success:
        print(f"refused: {res.error}", file=sys.stderr)
        return 2
    _give(res.data, args.out, args.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
