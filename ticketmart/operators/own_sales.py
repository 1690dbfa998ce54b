"""The platform's own sales: derived columns and the five lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart import functions as C
from ticketmart import schemas as S
from ticketmart.operators.heavy import lookup_heavy
from ticketmart.operators.in_force import Periods, by_month, lookup_in_force
from ticketmart.operators.layout import clustered
from ticketmart.operators.lookup import lookup, lookup_nullable, sized, small_dimensions

Tables = Mapping[str, DataFrame]


def sold_since(sales: DataFrame, day: dt.date | Column | None, *, keep_undated: bool = False) -> DataFrame:
    """Sales from the start of ``day`` on, so that this day is always taken whole.

    The bound has the column's own type: the filter reaches the scan or the database.
    ``keep_undated`` takes the sales without a day as well.
    """
    if day is None:
        return sales
    sale_date = F.col("sale_date")
    recent = sale_date >= F.lit(day).cast(sales.schema["sale_date"].dataType)
    return sales.where(recent | sale_date.isNull() if keep_undated else recent)


def with_seller_type(sales: DataFrame) -> DataFrame:
    return sales.withColumn("seller_type", C.seller_type(F.col("reseller_id")))


def with_event_type(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Only the type: sales have a venue of their own."""
    return lookup(sales, events.select("event_id", "event_type"), "event_id")


def reseller_columns(resellers: DataFrame) -> DataFrame:
    return resellers.select("reseller_id", "reseller_name", F.col("location").alias("reseller_location"))


def with_reseller(sales: DataFrame, resellers: DataFrame) -> DataFrame:
    """Organizer sales have no reseller: their name and location stay NULL."""
    return lookup_nullable(sales, reseller_columns(resellers), "reseller_id", spread_by="sale_id")


def with_channel(sales: DataFrame, sales_channels: DataFrame) -> DataFrame:
    return lookup(sales, sales_channels, "sales_channel_id")


def with_agreement(sales: DataFrame, partnerships: DataFrame) -> DataFrame:
    """One row per agreement of the sale's organizer and reseller."""
    return lookup_nullable(sales, partnerships, "organizer_id", "reseller_id", spread_by="sale_id")


def agreement_periods(partnerships: DataFrame, *keys: str) -> Periods:
    return by_month(partnerships, "start_date", "end_date", keys)


def with_agreement_in_force(sales: DataFrame, agreements: Periods) -> DataFrame:
    """As ``with_agreement``, but only agreements that hold on the day of the sale."""
    return lookup_in_force(sales, agreements, "organizer_id", "reseller_id", day="sale_date", spread_by="sale_id")


def with_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return lookup(sales, customers, "customer_id")


def with_sale_day(sales: DataFrame, keep_time: bool = False) -> DataFrame:
    """Cut ``sale_date`` to its day; ``keep_time`` keeps it as ``sale_datetime``."""
    if keep_time:
        sales = sales.withColumn("sale_datetime", F.col("sale_date"))
    return sales.withColumn("sale_date", C.sale_day(F.col("sale_date")))


def enrich_own_sales(
    sales: DataFrame,
    tables: Tables,
    cluster_by: Sequence[str] = (),
    *,
    keep_time: bool = False,
    in_force: bool = False,
    heavy_share: float | None = None,
) -> DataFrame:
    """All lookups. Those in dimensions too large to be broadcast come first, while rows
    are narrow; agreements, which may multiply rows, are the last of them, and with
    ``in_force`` just those that hold on the day of the sale. ``heavy_share`` deals customers
    with more than that share of all sales over many tasks, where customers are too many to
    be broadcast; it takes one more pass over the sales' customers.

    ``cluster_by`` names the partition columns of the table to be written. Rows are brought
    together for them after the lookups that shuffle and before those that are broadcast,
    while there is less to move. The latter are hinted, so that what the check calls small is
    broadcast even where the planner counts the columns of a join as well.
    """
    rows = with_sale_day(sales, keep_time)
    agreements = agreement_periods(tables["partnerships"], "organizer_id", "reseller_id") if in_force else None

    def customer(rows: DataFrame, customers: DataFrame) -> DataFrame:
        if heavy_share is None or "customers" in small:
            return with_customer(rows, customers)
        return lookup_heavy(rows, customers, "customer_id", spread_by="sale_id", share=heavy_share)

    def agreement(rows: DataFrame, partnerships: DataFrame) -> DataFrame:
        return with_agreement(rows, partnerships) if agreements is None else with_agreement_in_force(rows, agreements)

    lookups = {
        "customers": customer,
        "events": with_event_type,
        "sales_channels": with_channel,
        "resellers": with_reseller,
        "partnerships": agreement,
    }
    # Of events one column is looked up besides the key. Agreements in force have their own check.
    looked_up = {name: tables[name] for name in lookups if agreements is None or name != "partnerships"}
    small = small_dimensions({**looked_up, "events": tables["events"].select("event_id", "event_type")})
    if agreements is not None and agreements.is_broadcast:
        small.add("partnerships")
    for name in [name for name in lookups if name not in small]:
        rows = lookups[name](rows, sized(tables[name], False))
    rows = clustered(rows, cluster_by)
    for name in [name for name in lookups if name in small]:
        rows = lookups[name](rows, sized(tables[name], True))
    return with_seller_type(rows).select(*S.OWN_COLUMNS, *(["sale_datetime"] if keep_time else []))
