"""Command line: ``python -m ebbtide run|report|append``.

Order tables come from Parquet paths, or from a database when ``--jdbc`` is given and
ORDERS_DB_URL (with ORDERS_DB_USER and ORDERS_DB_PASSWORD) is set.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ebbtide.params import ChurnParams, ModelParams
from ebbtide.plans.run import regenerate_report, run
from ebbtide.session import remove_scratch
from ebbtide.sources.schemas import ORDER_ITEM
from ebbtide.sources.sinks import append_inputs, stamped, write_parquet
from ebbtide.sources.tables import (
    Tables,
    block_splits,
    conform,
    is_readable,
    normalise_header,
    read_jdbc,
    read_parquet,
)


def _from_database(spark: SparkSession, splits: int) -> Tables:
    ends = read_jdbc(spark, "(SELECT min(id) AS lo, max(id) AS hi FROM order_header) ends")
    low, high = ends.select(F.col("lo").cast("long"), F.col("hi").cast("long")).first()
    header = read_jdbc(spark, "order_header", "id", low or 0, (high or 0) + 1, splits)
    # Ranges of blocks: hashing the text key would make every part scan the whole table.
    size = read_jdbc(
        spark,
        "(SELECT pg_relation_size('order_item') / current_setting('block_size')::int "
        "AS blocks) size",
    )
    blocks = size.select(F.col("blocks").cast("long")).first()[0]
    item = read_jdbc(spark, "order_item", predicates=block_splits(blocks, splits))
    return Tables(normalise_header(header), conform(item, ORDER_ITEM))


def _tables(spark: SparkSession, args: argparse.Namespace) -> Tables:
    if args.jdbc:
        tables = _from_database(spark, args.splits)
    else:
        tables = read_parquet(spark, args.header, args.items)
    if not is_readable(tables.order_header):
        raise SystemExit("order_header cannot be read")
    return tables


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ebbtide")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "report"):
        sub = commands.add_parser(name)
        sub.add_argument("--header")
        sub.add_argument("--items")
        sub.add_argument("--jdbc", action="store_true")
        sub.add_argument("--splits", type=int, default=64)
        sub.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
        sub.add_argument("--output", required=True)
        if name == "run":
            sub.add_argument("--history-days", type=int, default=365)
            sub.add_argument("--period-days", type=int, default=60)
            sub.add_argument("--baseline-days", type=int, default=120)
            sub.add_argument("--threshold", type=float, default=0.5)
            sub.add_argument("--min-orders", type=int, default=3)
        else:
            sub.add_argument("--model", required=True)
            sub.add_argument("--predictions", required=True)
    sub = commands.add_parser("append")
    sub.add_argument("--target", required=True)
    sub.add_argument("inputs", nargs="+")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or SparkSession.builder.appName("ebbtide").getOrCreate()
    # Dates are taken from timestamps, so they must not depend on the cluster's zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        _execute(spark, args)
    finally:
        if own:
            remove_scratch(spark)


def _execute(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "append":
        result = append_inputs(spark, args.inputs, args.target, ORDER_ITEM)
        print(f"{result.rows} rows appended, {len(result.failed)} inputs left out")
        return
    tables = _tables(spark, args)
    params = ChurnParams(as_of=args.as_of)
    if args.command == "run":
        params = replace(
            params,
            history_days=args.history_days,
            current_days=args.period_days,
            previous_days=args.period_days,
            baseline_days=args.baseline_days,
            threshold=args.threshold,
            min_orders=args.min_orders,
        )
        done = run(tables, params, ModelParams(), args.output)
        print("\n".join(f"{name}: {path}" for name, path in done.paths.items()))
    else:
        report = regenerate_report(spark, tables, params, args.model, args.predictions)
        print(write_parquet(report, stamped(args.output, "churn_report")))


if __name__ == "__main__":
    main()
