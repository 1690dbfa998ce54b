"""Table schemas and the fixed values of the ticket-sales data model."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = T.StringType()  # UUID columns arrive as text
TEXT = T.StringType()
MONEY = T.DecimalType(10, 2)
RATE = T.DecimalType(5, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Relational source tables.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "venues": _struct(venue_id=KEY, venue_name=TEXT, location=TEXT),
    "organizers": _struct(organizer_id=KEY, organizer_name=TEXT),
    "resellers": _struct(reseller_id=KEY, reseller_name=TEXT, location=TEXT),
    "customers": _struct(customer_id=KEY, customer_name=TEXT),
    "sales_channels": _struct(sales_channel_id=KEY, channel_name=TEXT),
    "events": _struct(event_id=KEY, event_name=TEXT, event_type=TEXT, venue_id=KEY),
    "partnerships": _struct(
        partnership_id=KEY,
        organizer_id=KEY,
        reseller_id=KEY,
        commission_rate=RATE,
        start_date=T.DateType(),
        end_date=T.DateType(),
    ),
    "sales": _struct(
        sale_id=KEY,
        event_id=KEY,
        venue_id=KEY,
        organizer_id=KEY,
        reseller_id=KEY,
        customer_id=KEY,
        sales_channel_id=KEY,
        ticket_quantity=T.IntegerType(),
        total_amount=MONEY,
        sale_date=T.TimestampType(),
    ),
}

DIMENSIONS = (
    "venues",
    "events",
    "customers",
    "organizers",
    "resellers",
    "sales_channels",
    "partnerships",
)

# File names, headers, labels and channel names are a contract
# with the resellers and with the readers of the mart.
DROP_NAME_PATTERN = r"DailySales_\d{8}_([^\.]+)\.csv"
DROP_DAY_PATTERN = r"DailySales_(\d{8})_[^\.]+\.csv"
DROP_DAY_FORMAT = "MMddyyyy"
TRANSACTION_ID = "Transaction ID"
EVENT_ID = "Event ID"
EVENT_NAME = "Event Name"
TICKETS = "Number of Purchased Tickets"
AMOUNT = "Total Amount"
CHANNEL = "Sales Channel"
FIRST_NAME = "Customer First Name"
LAST_NAME = "Customer Last Name"
OFFICE = "Office Location"
CREATED = "Created Date"
OFFICE_CHANNEL = "office"
ON_SITE_CHANNEL = "on-the-site"
OWN_ORIGIN = "B2B platform"
THIRD_PARTY_ORIGIN = "3rd party"
SOLD_BY_ORGANIZER = "organizer"
SOLD_BY_RESELLER = "reseller"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# The two header lines in use. They differ in width, so the width of a line
# tells which of them applies to it.
NARROW_LAYOUT = (
    TRANSACTION_ID, EVENT_NAME, TICKETS, AMOUNT, CHANNEL,
    FIRST_NAME, LAST_NAME, OFFICE, CREATED,
)
WIDE_LAYOUT = (
    TRANSACTION_ID, EVENT_ID, EVENT_NAME, TICKETS, AMOUNT, CHANNEL,
    FIRST_NAME, LAST_NAME, OFFICE, CREATED,
)

# Columns of the derived tables, partition columns last.
THIRD_PARTY_COLUMNS = (
    "organizer_id", "reseller_id", "sale_id", "ticket_quantity", "total_amount",
    "source_file", "customer_name", "channel_name", "partnership_id",
    "commission_rate", "start_date", "end_date", "reseller_name",
    "reseller_location", "event_id", "event_type", "venue_id", "seller_type",
    "sale_date",
)
OWN_COLUMNS = (
    "customer_id", "organizer_id", "reseller_id", "sales_channel_id", "event_id",
    "sale_id", "venue_id", "ticket_quantity", "total_amount", "seller_type",
    "event_type", "reseller_name", "reseller_location", "channel_name",
    "partnership_id", "commission_rate", "start_date", "end_date",
    "customer_name", "sale_date",
)
SALES_COLUMNS = (*OWN_COLUMNS[:-1], "source_file", "data_source", "sale_date")

THIRD_PARTY_PARTITIONS = ("file_day", "sale_date")
SALES_PARTITIONS = ("data_source", "sale_date")
