"""Run a load from the command line or with spark-submit.

    python -m ticketmart daily --database mart --drops s3a://bucket/sales \\
        --checkpoint s3a://bucket/checkpoint --jdbc-url jdbc:... --jdbc-driver ... --jdbc-user ...

The database password is read from the environment variable MART_DB_PASSWORD.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from ticketmart import schemas as S
from ticketmart.plans import loads
from ticketmart.plans.mart import Mart
from ticketmart.plans.refresh import daily_refresh, initial_load, third_party_step
from ticketmart.session import build_session
from ticketmart.sources.jdbc import JdbcSource

COMMANDS: dict[str, Callable[[Mart], None]] = {
    "initial": initial_load,
    "daily": daily_refresh,
    "dimensions": loads.refresh_dimensions,
    "third-party-initial": loads.load_third_party,
    "third-party-daily": third_party_step,
    "sales-initial": loads.load_sales,
    "sales-daily": loads.load_sales_daily,
    "compact": loads.compact_sales,
}


def parser() -> argparse.ArgumentParser:
    result = argparse.ArgumentParser(prog="ticketmart", description="Load the ticket-sales mart.")
    result.add_argument("command", choices=[*COMMANDS, *S.DIMENSIONS], help="a load, or one dimension to refresh")
    result.add_argument("--database", required=True, help="catalog database of the mart; made if absent")
    result.add_argument("--drops", required=True, help="folder of the reseller drops")
    result.add_argument("--checkpoint", help="folder of the drop stream's progress")
    result.add_argument("--jdbc-url", required=True)
    result.add_argument("--jdbc-driver", required=True)
    result.add_argument("--jdbc-user", required=True)
    result.add_argument("--jdbc-schema", default="public")
    result.add_argument("--parts", type=int, default=64, help="parallel reads of sales and of customers")
    result.add_argument("--customer-parts", type=int, help="parallel reads of customers, if others than --parts")
    result.add_argument("--fetch-size", type=int, help="rows that are fetched from the database at a time")
    result.add_argument("--keep-sale-time", action="store_true", help="store the time of own sales as sale_datetime")
    result.add_argument("--agreements-in-force", action="store_true", help="only agreements of the day of the sale")
    result.add_argument("--reconcile-sales", action="store_true", help="find own sales that came, changed or went on any day")
    result.add_argument("--last-deliveries", action="store_true", help="take a sale of several drops from the last one")
    result.add_argument("--row-hash", help="SQL of the database: a whole number of all columns of a sale")
    return result


def mart_from(spark: SparkSession, args: argparse.Namespace) -> Mart:
    options = {"url": args.jdbc_url, "driver": args.jdbc_driver, "user": args.jdbc_user}
    if args.fetch_size is not None:
        options["fetchsize"] = str(args.fetch_size)
    password = os.environ.get("MART_DB_PASSWORD")
    if password is not None:
        options["password"] = password
    splits = {"sales": "sale_id", "customers": "customer_id"}
    table_parts = {"customers": args.customer_parts} if args.customer_parts else {}
    source = JdbcSource(spark, options, args.jdbc_schema, splits, args.parts, table_parts, args.row_hash)
    return Mart(
        spark,
        args.database,
        source,
        args.drops,
        args.checkpoint,
        args.keep_sale_time,
        args.agreements_in_force,
        args.reconcile_sales,
        args.last_deliveries,
    )


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
    mart = mart_from(spark, args)
    if args.command in S.DIMENSIONS:
        loads.refresh_dimension(mart, args.command)
    else:
        COMMANDS[args.command](mart)


if __name__ == "__main__":
    main()
