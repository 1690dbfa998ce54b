"""The registered queries over the driver's tables, and their SQL counterparts.

A query that shows one operator applies it to a role. A query that shows a job
sets up a mart of its own in the shared scratch folder, runs the job and gives the
table it wrote.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import functions as C
from ticketmart import schemas as S
from ticketmart.operators import own_sales, third_party, union, watermark
from ticketmart.operators.lookup import broadcast_limit, known_small, planned_bytes
from ticketmart.plans import loads
from ticketmart.plans.mart import Mart
from ticketmart.plans.refresh import daily_refresh, initial_load
from ticketmart.roles import as_drop_rows, role, role_sql
from ticketmart.session import scoped_settings, scratch_folder
from ticketmart.sinks import COMPRESSION, upsert_partitions
from ticketmart.sources.catalog import list_partitions
from ticketmart.sources.drops import read_daily_sales, write_drops, writing_tasks
from ticketmart.streaming.drops import ingest_new_drops

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _with_roles(select: str, *names: str) -> str:
    parts = ", ".join(f"r_{name} AS ({role_sql(name)})" for name in names)
    return f"WITH {parts} {select}"


def _query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        _QUERIES[name] = query
        _ORACLES[name] = oracle
        return query

    return register


# Marts and drops in the scratch folder.


def new_database(spark: SparkSession) -> str:
    database = f"ticketmart_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_folder(spark)}/{database}/tables'")
    return database


def mart_in(spark: SparkSession, sf_dir: str, database: str, drops: str = "", streamed: bool = False) -> Mart:
    folder = f"{scratch_folder(spark)}/{database}"
    return Mart(
        spark,
        database,
        source=lambda name: role(spark, sf_dir, name),
        drops=drops or f"{folder}/drops",
        checkpoint=f"{folder}/checkpoint" if streamed else None,
    )


def new_mart(spark: SparkSession, sf_dir: str, drops: str = "", streamed: bool = False) -> Mart:
    return mart_in(spark, sf_dir, new_database(spark), drops, streamed)


def deliver_drops(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    when: Column | None = None,
    shift_days: int = 0,
    name: Column | None = None,
) -> None:
    """Write the drops role as CSV drops, one region's in the wide layout.

    ``shift_days`` moves the lines, but not their drops, to later days; ``name`` gives the
    drops other names. There are few drops, whatever the size, so they are not shuffled, and
    neither are the line items while their suppliers can be broadcast.
    """
    lines = role(spark, sf_dir, "drops")
    if when is not None:
        lines = lines.where(when)
    if name is not None:
        lines = lines.withColumn("source_file", name)
    if shift_days:
        lines = lines.withColumn("created", F.date_add(F.to_date("created"), shift_days).cast("string"))
    lines = lines.withColumn(S.EVENT_ID, F.lit(None).cast("string")).withColumnRenamed("source_file", "drop")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    limits = {"spark.sql.autoBroadcastJoinThreshold": str(broadcast_limit(suppliers))} if known_small(suppliers) else {}
    read = planned_bytes(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    with scoped_settings(spark, limits):
        for is_wide, layout in ((0, S.NARROW_LAYOUT), (1, S.WIDE_LAYOUT)):
            drops = as_drop_rows(lines.where(F.col("is_wide") == is_wide)).select(*layout, "drop")
            write_drops(drops, folder, shuffled=False, tasks=writing_tasks(spark, read))


_shared: dict[tuple[str, ...], str] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], str]) -> str:
    """Name of something that several queries of one application read."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def shared_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def make() -> str:
        mart = new_mart(spark, sf_dir)
        loads.refresh_dimensions(mart)
        return mart.database

    return mart_in(spark, sf_dir, _once(spark, sf_dir, "dimensions", make)).dimensions()


def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The role of own sales as a stored table, for sources that are read several times."""

    def make() -> str:
        folder = f"{scratch_folder(spark)}/sales_{uuid.uuid4().hex[:12]}"
        role(spark, sf_dir, "sales").write.parquet(folder, compression=COMPRESSION)
        return folder

    folder = _once(spark, sf_dir, "sales", make)
    return spark.read.schema(role(spark, sf_dir, "sales").schema).parquet(folder)


def shared_drops(spark: SparkSession, sf_dir: str) -> str:
    def make() -> str:
        folder = f"{scratch_folder(spark)}/drops_{uuid.uuid4().hex[:12]}"
        deliver_drops(spark, sf_dir, folder)
        return folder

    return _once(spark, sf_dir, "drops", make)


def _with_stored_sales(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: stored_sales(spark, sf_dir) if name == "sales" else role(spark, sf_dir, name)


def shared_mart(spark: SparkSession, sf_dir: str) -> Mart:
    drops = shared_drops(spark, sf_dir)

    def make() -> str:
        mart = new_mart(spark, sf_dir, drops)
        initial_load(mart)
        return mart.database

    return mart_in(spark, sf_dir, _once(spark, sf_dir, "mart", make), drops)


def _last_drop_day(spark: SparkSession, sf_dir: str) -> dt.date:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.agg(F.to_date(F.trunc(F.max("l_shipdate"), "quarter")).alias("day")).first()["day"]


# Dimensions.


def _dimension_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = new_mart(spark, sf_dir)
        loads.refresh_dimension(mart, name)
        return mart.table(name)

    return query


for _name in S.DIMENSIONS:
    _query(f"dim_{_name}", role_sql(_name))(_dimension_query(_name))


# Own sales, step by step.

_OWN_SELECT = """
    SELECT s.customer_id, s.organizer_id, s.reseller_id, s.sales_channel_id, s.event_id, s.sale_id,
        s.venue_id, s.ticket_quantity, s.total_amount,
        CASE WHEN s.reseller_id IS NULL THEN 'organizer' ELSE 'reseller' END AS seller_type,
        e.event_type, r.reseller_name, r.location AS reseller_location, c.channel_name,
        p.partnership_id, p.commission_rate, p.start_date, p.end_date, u.customer_name,
        CAST(s.sale_date AS DATE) AS sale_date
    FROM r_sales s
        LEFT JOIN r_events e ON e.event_id = s.event_id
        LEFT JOIN r_resellers r ON r.reseller_id = s.reseller_id
        LEFT JOIN r_sales_channels c ON c.sales_channel_id = s.sales_channel_id
        LEFT JOIN r_partnerships p ON p.organizer_id = s.organizer_id AND p.reseller_id = s.reseller_id
        LEFT JOIN r_customers u ON u.customer_id = s.customer_id"""
_OWN_ROLES = ("sales", "events", "resellers", "sales_channels", "partnerships", "customers")


@_query("own_sales", _with_roles(_OWN_SELECT, *_OWN_ROLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_sales.enrich_own_sales(role(spark, sf_dir, "sales"), shared_dimensions(spark, sf_dir))


@_query(
    "seller_type",
    _with_roles(
        """SELECT sale_id, reseller_id,
            CASE WHEN reseller_id IS NULL THEN 'organizer' ELSE 'reseller' END AS seller_type
        FROM r_sale_lines""",
        "sale_lines",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = own_sales.with_seller_type(role(spark, sf_dir, "sale_lines"))
    return rows.select("sale_id", "reseller_id", "seller_type")


@_query(
    "own_sales_event",
    _with_roles(
        """SELECT s.sale_id, s.event_id, e.event_type
        FROM r_sale_lines s LEFT JOIN r_events e ON e.event_id = s.event_id""",
        "sale_lines", "events",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shared_dimensions(spark, sf_dir)["events"]
    rows = own_sales.with_event_type(role(spark, sf_dir, "sale_lines"), events)
    return rows.select("sale_id", "event_id", "event_type")


@_query(
    "own_sales_reseller",
    _with_roles(
        """SELECT s.sale_id, s.reseller_id, r.reseller_name, r.location AS reseller_location
        FROM r_sale_lines s LEFT JOIN r_resellers r ON r.reseller_id = s.reseller_id""",
        "sale_lines", "resellers",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    resellers = shared_dimensions(spark, sf_dir)["resellers"]
    rows = own_sales.with_reseller(role(spark, sf_dir, "sale_lines"), resellers)
    return rows.select("sale_id", "reseller_id", "reseller_name", "reseller_location")


@_query(
    "own_sales_channel",
    _with_roles(
        """SELECT s.sale_id, s.sales_channel_id, c.channel_name
        FROM r_sale_orders s LEFT JOIN r_sales_channels c ON c.sales_channel_id = s.sales_channel_id""",
        "sale_orders", "sales_channels",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = shared_dimensions(spark, sf_dir)["sales_channels"]
    rows = own_sales.with_channel(role(spark, sf_dir, "sale_orders"), channels)
    return rows.select("sale_id", "sales_channel_id", "channel_name")


@_query(
    "own_sales_partnership",
    _with_roles(
        """SELECT s.sale_id, s.organizer_id, s.reseller_id, p.partnership_id, p.commission_rate,
            p.start_date, p.end_date
        FROM r_sale_lines s
            LEFT JOIN r_partnerships p ON p.organizer_id = s.organizer_id AND p.reseller_id = s.reseller_id""",
        "sale_lines", "partnerships",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    partnerships = shared_dimensions(spark, sf_dir)["partnerships"]
    rows = own_sales.with_agreement(role(spark, sf_dir, "sale_lines"), partnerships)
    return rows.select(
        "sale_id", "organizer_id", "reseller_id", "partnership_id", "commission_rate", "start_date", "end_date"
    )


# An agreement's days count from the first to the last; a missing one leaves that side open.
_IN_FORCE = "coalesce(p.start_date <= {day}, TRUE) AND coalesce({day} <= p.end_date, TRUE) AND {day} IS NOT NULL"
_OWN_IN_FORCE = _OWN_SELECT.replace(
    "p.reseller_id = s.reseller_id", "p.reseller_id = s.reseller_id AND " + _IN_FORCE.format(day="CAST(s.sale_date AS DATE)")
)


@_query("own_sales_in_force", _with_roles(_OWN_IN_FORCE, *_OWN_ROLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only agreements that hold on the day of the sale."""
    sales = role(spark, sf_dir, "sales")
    return own_sales.enrich_own_sales(sales, shared_dimensions(spark, sf_dir), in_force=True)


@_query(
    "own_sales_customer",
    _with_roles(
        """SELECT s.sale_id, s.customer_id, u.customer_name
        FROM r_sale_orders s LEFT JOIN r_customers u ON u.customer_id = s.customer_id""",
        "sale_orders", "customers",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = shared_dimensions(spark, sf_dir)["customers"]
    rows = own_sales.with_customer(role(spark, sf_dir, "sale_orders"), customers)
    return rows.select("sale_id", "customer_id", "customer_name")


@_query("sale_day", _with_roles("SELECT sale_id, CAST(sale_date AS DATE) AS sale_date FROM r_activity", "activity"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_sales.with_sale_day(role(spark, sf_dir, "activity")).select("sale_id", "sale_date")


@_query(
    "sale_day_with_time",
    _with_roles(
        "SELECT sale_id, sale_date AS sale_datetime, CAST(sale_date AS DATE) AS sale_date FROM r_activity",
        "activity",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = own_sales.with_sale_day(role(spark, sf_dir, "activity"), keep_time=True)
    return rows.select("sale_id", "sale_datetime", "sale_date")


@_query(
    "incremental_filter",
    _with_roles(
        """SELECT sale_id, sale_date FROM r_activity
        WHERE sale_date >= (SELECT CAST(max(sale_date) AS DATE) - 7 FROM r_activity)""",
        "activity",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = role(spark, sf_dir, "activity")
    a_week_back = sales.agg(F.date_sub(C.sale_day(F.max("sale_date")), 7)).scalar()
    return own_sales.sold_since(sales, a_week_back).select("sale_id", "sale_date")


# Third-party lines, step by step.


def _normal_sql(source: str) -> str:
    return f"""
    SELECT transaction_id AS sale_id, event_name, CAST(tickets AS INT) AS ticket_quantity,
        CAST(amount AS DECIMAL(10,2)) AS total_amount,
        CASE WHEN channel = 'office' THEN 'on-the-site' ELSE channel END AS channel_name,
        first_name || ' ' || last_name AS customer_name, CAST(created AS DATE) AS sale_date,
        regexp_extract(source_file, '{S.DROP_NAME_PATTERN}', 1) AS reseller_id, source_file
    FROM {source}"""


def _third_party_select(source: str) -> str:
    return f"""
    SELECT p.organizer_id, n.reseller_id, n.sale_id, n.ticket_quantity, n.total_amount, n.source_file,
        n.customer_name, n.channel_name, p.partnership_id, p.commission_rate, p.start_date, p.end_date,
        r.reseller_name, r.location AS reseller_location, e.event_id, e.event_type, e.venue_id,
        'reseller' AS seller_type, n.sale_date
    FROM ({_normal_sql(source)}) n
        LEFT JOIN r_partnerships p ON p.reseller_id = n.reseller_id
        LEFT JOIN r_resellers r ON r.reseller_id = n.reseller_id
        LEFT JOIN r_organizers o ON o.organizer_id = p.organizer_id
        LEFT JOIN r_events e ON e.event_name = n.event_name"""


_THIRD_PARTY_ROLES = ("partnerships", "resellers", "organizers", "events")


def _normal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return third_party.normalise(as_drop_rows(role(spark, sf_dir, "drop_lines")))


@_query(
    "reseller_from_filename",
    _with_roles(
        f"""SELECT transaction_id AS sale_id, source_file,
            regexp_extract(source_file, '{S.DROP_NAME_PATTERN}', 1) AS reseller_id
        FROM r_drop_lines""",
        "drop_lines",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = role(spark, sf_dir, "drop_lines")
    return lines.select(
        F.col("transaction_id").alias("sale_id"),
        "source_file",
        C.reseller_from_file(F.col("source_file")).alias("reseller_id"),
    )


@_query("third_party_normalised", _with_roles(_normal_sql("r_drop_lines"), "drop_lines"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal_lines(spark, sf_dir).drop("file_day")


@_query(
    "third_party_partnership",
    _with_roles(
        f"""SELECT n.sale_id, n.reseller_id, p.organizer_id, p.partnership_id, p.commission_rate,
            p.start_date, p.end_date
        FROM ({_normal_sql("r_drop_lines")}) n LEFT JOIN r_partnerships p ON p.reseller_id = n.reseller_id""",
        "drop_lines", "partnerships",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    partnerships = shared_dimensions(spark, sf_dir)["partnerships"]
    rows = third_party.with_agreements(_normal_lines(spark, sf_dir), partnerships)
    return rows.select(
        "sale_id", "reseller_id", "organizer_id", "partnership_id", "commission_rate", "start_date", "end_date"
    )


@_query(
    "third_party_reseller",
    _with_roles(
        f"""SELECT n.sale_id, n.reseller_id, r.reseller_name, r.location AS reseller_location
        FROM ({_normal_sql("r_drop_lines")}) n LEFT JOIN r_resellers r ON r.reseller_id = n.reseller_id""",
        "drop_lines", "resellers",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    resellers = shared_dimensions(spark, sf_dir)["resellers"]
    rows = third_party.with_reseller(_normal_lines(spark, sf_dir), resellers)
    return rows.select("sale_id", "reseller_id", "reseller_name", "reseller_location")


@_query(
    "third_party_organizer",
    _with_roles(
        f"""SELECT n.sale_id, p.organizer_id, o.organizer_name
        FROM ({_normal_sql("r_drop_lines")}) n
            LEFT JOIN r_partnerships p ON p.reseller_id = n.reseller_id
            LEFT JOIN r_organizers o ON o.organizer_id = p.organizer_id""",
        "drop_lines", "partnerships", "organizers",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = shared_dimensions(spark, sf_dir)
    rows = third_party.with_agreements(_normal_lines(spark, sf_dir), tables["partnerships"])
    return third_party.with_organizer(rows, tables["organizers"]).select("sale_id", "organizer_id", "organizer_name")


@_query(
    "third_party_event",
    _with_roles(
        f"""SELECT n.sale_id, n.event_name, e.event_id, e.event_type, e.venue_id
        FROM ({_normal_sql("r_drop_lines")}) n LEFT JOIN r_events e ON e.event_name = n.event_name""",
        "drop_lines", "events",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shared_dimensions(spark, sf_dir)["events"]
    rows = third_party.with_event(_normal_lines(spark, sf_dir), events)
    return rows.select("sale_id", "event_name", "event_id", "event_type", "venue_id")


@_query("third_party_enriched", _with_roles(_third_party_select("r_drop_lines"), "drop_lines", *_THIRD_PARTY_ROLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = third_party.enrich_third_party(_normal_lines(spark, sf_dir), shared_dimensions(spark, sf_dir))
    return rows.select(*S.THIRD_PARTY_COLUMNS)


_THIRD_PARTY_IN_FORCE = _third_party_select("r_drop_lines").replace(
    "p.reseller_id = n.reseller_id", "p.reseller_id = n.reseller_id AND " + _IN_FORCE.format(day="n.sale_date")
)


@_query("third_party_in_force", _with_roles(_THIRD_PARTY_IN_FORCE, "drop_lines", *_THIRD_PARTY_ROLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only agreements that hold on the day of the sale; without one there is no organizer."""
    rows = third_party.enrich_third_party(_normal_lines(spark, sf_dir), shared_dimensions(spark, sf_dir), in_force=True)
    return rows.select(*S.THIRD_PARTY_COLUMNS)


# Union.


def _sales_select(source: str, with_time: bool = False) -> str:
    columns = ", ".join([*S.SALES_COLUMNS, *(["sale_datetime"] if with_time else [])])
    day = "CAST(s.sale_date AS DATE) AS sale_date"
    own = _OWN_SELECT.replace(day, f"{day}, s.sale_date AS sale_datetime")
    return f"""
    SELECT {columns}
    FROM (SELECT o.*, NULL AS source_file, 'B2B platform' AS data_source FROM ({own}) o)
    UNION ALL
    SELECT {columns}
    FROM (SELECT t.*, NULL AS customer_id, NULL AS sales_channel_id, '3rd party' AS data_source, NULL AS sale_datetime
          FROM ({_third_party_select(source)}) t)"""


def _sales_oracle(lines: str) -> str:
    return _with_roles(_sales_select(f"r_{lines}"), lines, "organizers", *_OWN_ROLES)


@_query("sales_union", _sales_oracle("drop_lines"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = shared_dimensions(spark, sf_dir)
    own = own_sales.enrich_own_sales(role(spark, sf_dir, "sales"), tables)
    return union.unite_sales(own, third_party.enrich_third_party(_normal_lines(spark, sf_dir), tables))


# Loads. Where a row shows its source file, the scratch folder is left out of it.


def _file_name_only(rows: DataFrame) -> DataFrame:
    return rows.withColumn("source_file", F.regexp_extract("source_file", S.DROP_NAME_PATTERN, 0))


_LOADED_THIRD_PARTY = _with_roles(_third_party_select("r_drops"), "drops", *_THIRD_PARTY_ROLES)


def _stored_third_party(mart: Mart) -> DataFrame:
    return _file_name_only(mart.table("sales_csv").select(*S.THIRD_PARTY_COLUMNS))


def _stored_sales(mart: Mart) -> DataFrame:
    name = F.regexp_extract("source_file", S.DROP_NAME_PATTERN, 0)
    return mart.table("sales").withColumn("source_file", name).select(*S.SALES_COLUMNS)


@_query("third_party_initial", _LOADED_THIRD_PARTY)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = new_mart(spark, sf_dir, shared_drops(spark, sf_dir))
    loads.refresh_dimensions(mart)
    loads.load_third_party(mart)
    return _stored_third_party(mart)


@_query(
    "third_party_day",
    _with_roles(
        _third_party_select("r_drops") + " WHERE n.sale_date = (SELECT max(CAST(created AS DATE)) FROM r_drops)",
        "drops", *_THIRD_PARTY_ROLES,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drops of one day, here the last one; the other files are not opened."""
    drops = read_daily_sales(spark, shared_drops(spark, sf_dir), _last_drop_day(spark, sf_dir))
    rows = third_party.enrich_third_party(third_party.normalise(drops), shared_dimensions(spark, sf_dir))
    return _file_name_only(rows.select(*S.THIRD_PARTY_COLUMNS))


@_query("third_party_daily", _LOADED_THIRD_PARTY)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All drops but those of the last day, then a daily load for the rest."""
    mart, last = new_mart(spark, sf_dir), _last_drop_day(spark, sf_dir)
    created = F.to_date("created")
    loads.refresh_dimensions(mart)
    deliver_drops(spark, sf_dir, mart.drops, created < last)
    loads.load_third_party(mart)
    deliver_drops(spark, sf_dir, mart.drops, created >= last)
    loads.load_third_party_daily(mart)
    return _stored_third_party(mart)


@_query("third_party_corrected", _LOADED_THIRD_PARTY)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops with lines of another day too many, loaded; then the right drops under their names."""
    mart = new_mart(spark, sf_dir)
    loads.refresh_dimensions(mart)
    deliver_drops(spark, sf_dir, mart.drops)
    deliver_drops(spark, sf_dir, mart.drops, F.col("last_name").isNull(), shift_days=400)
    loads.load_third_party(mart)
    corrected = Mart(spark, mart.database, mart.source, f"{mart.drops}_corrected")
    deliver_drops(spark, sf_dir, corrected.drops)
    loads.load_third_party(corrected)
    return _stored_third_party(corrected)


@_query("third_party_stream", _LOADED_THIRD_PARTY)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drops of the last day come first; the stream still finds all the older ones."""
    mart, last = new_mart(spark, sf_dir, streamed=True), _last_drop_day(spark, sf_dir)
    created = F.to_date("created")
    loads.refresh_dimensions(mart)
    deliver_drops(spark, sf_dir, mart.drops, created >= last)
    ingest_new_drops(mart).awaitTermination()
    deliver_drops(spark, sf_dir, mart.drops, created < last)
    ingest_new_drops(mart).awaitTermination()
    return _stored_third_party(mart)


@_query("sales_initial", _sales_oracle("drops"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = new_mart(spark, sf_dir, shared_drops(spark, sf_dir))
    initial_load(mart)
    return _stored_sales(mart)


@_query(
    "sales_with_time",
    _with_roles(_sales_select("r_drops", with_time=True), "drops", "organizers", *_OWN_ROLES),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored variant that keeps the time of own sales."""
    mart = new_mart(spark, sf_dir, shared_drops(spark, sf_dir))
    mart = Mart(spark, mart.database, mart.source, mart.drops, keep_sale_time=True)
    initial_load(mart)
    name = F.regexp_extract("source_file", S.DROP_NAME_PATTERN, 0)
    return mart.table("sales").withColumn("source_file", name).select(*S.SALES_COLUMNS, "sale_datetime")


@_query("sales_incremental", _sales_oracle("drops"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An initial load of what there was at midnight of the last sale day, then a daily refresh."""
    mart, last = new_mart(spark, sf_dir), _last_drop_day(spark, sf_dir)
    created = F.to_date("created")
    mart = dataclasses.replace(mart, source=_with_stored_sales(spark, sf_dir))

    def source_at_midnight(name: str) -> DataFrame:
        table = mart.source(name)
        if name != "sales":
            return table
        midnight = table.agg(F.date_trunc("day", F.max("sale_date"))).scalar()
        return table.where(F.col("sale_date") <= midnight)

    deliver_drops(spark, sf_dir, mart.drops, created < last)
    initial_load(Mart(spark, mart.database, source_at_midnight, mart.drops))
    deliver_drops(spark, sf_dir, mart.drops, created >= last)
    daily_refresh(mart)
    return _stored_sales(mart)


@_query("sales_reconciled", _sales_oracle("drops"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source whose old sales come late, change and go: the daily load brings in all of it.

    The initial load sees a source without some sales, with other amounts for some, and with
    sales that are taken away later, some of them on days that have no others.
    """
    final = mart_in(spark, sf_dir, new_database(spark), shared_drops(spark, sf_dir))
    final = dataclasses.replace(final, source=_with_stored_sales(spark, sf_dir))

    def source_before(name: str) -> DataFrame:
        table = final.source(name)
        if name != "sales":
            return table
        lot = F.crc32("sale_id") % 50
        gone = table.where(lot == 2).withColumn("sale_id", F.concat("sale_id", F.lit("-gone")))
        alone = gone.withColumn("sale_date", F.col("sale_date") - F.expr("INTERVAL '9' DAY"))
        amount = F.when(lot == 1, F.col("total_amount") + 1).otherwise(F.col("total_amount")).cast(S.MONEY)
        return table.where(lot != 0).withColumn("total_amount", amount).unionByName(gone).unionByName(alone)

    initial_load(dataclasses.replace(final, source=source_before, reconcile_sales=True))
    daily_refresh(dataclasses.replace(final, reconcile_sales=True))
    return _stored_sales(final)


_SECOND_NAME = "substr(source_file, 1, 13) || '02' || substr(source_file, 16)"
_TWICE_DELIVERED = f"(SELECT * REPLACE (CASE WHEN is_wide = 1 THEN {_SECOND_NAME} ELSE source_file END AS source_file) FROM r_drops)"


@_query("sales_last_deliveries", _with_roles(_sales_select(_TWICE_DELIVERED), "drops", "organizers", *_OWN_ROLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region's drops come again, a day later by their names; each sale is kept once, from these."""
    mart = dataclasses.replace(new_mart(spark, sf_dir), last_deliveries=True)
    deliver_drops(spark, sf_dir, mart.drops)
    deliver_drops(spark, sf_dir, mart.drops, F.col("is_wide") == 1, name=F.expr(_SECOND_NAME))
    initial_load(mart)
    return _stored_sales(mart)


# Partitions and watermarks.


@_query(
    "partition_overwrite",
    _with_roles(
        """SELECT sale_id, CAST(sale_date AS DATE) AS sale_date,
            CAST(CASE WHEN CAST(sale_date AS DATE) = (SELECT max(CAST(sale_date AS DATE)) FROM r_sales)
                THEN total_amount * 2 ELSE total_amount END AS DECIMAL(10,2)) AS total_amount
        FROM r_sales""",
        "sales",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all sales, then put doubled amounts in place of the last day's partition."""
    table = new_mart(spark, sf_dir).name("amounts")
    rows = own_sales.with_sale_day(role(spark, sf_dir, "sales")).select("sale_date", "sale_id", "total_amount")
    upsert_partitions(rows, table, ["sale_date"])
    last_day = rows.agg(F.max("sale_date")).scalar()
    doubled = rows.where(F.col("sale_date") == last_day).withColumn(
        "total_amount", (F.col("total_amount") * 2).cast(S.MONEY)
    )
    upsert_partitions(doubled, table, ["sale_date"])
    return spark.table(table)


@_query(
    "partition_new_column",
    _with_roles(
        """SELECT sale_id, CAST(sale_date AS DATE) AS sale_date, total_amount,
            CASE WHEN CAST(sale_date AS DATE) = (SELECT max(CAST(sale_date AS DATE)) FROM r_sales)
                THEN ticket_quantity END AS ticket_quantity
        FROM r_sales""",
        "sales",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all sales without a column, then the last day again with it."""
    table = new_mart(spark, sf_dir).name("amounts")
    rows = own_sales.with_sale_day(role(spark, sf_dir, "sales")).select("sale_date", "sale_id", "total_amount", "ticket_quantity")
    upsert_partitions(rows.drop("ticket_quantity"), table, ["sale_date"])
    last_day = rows.agg(F.max("sale_date")).scalar()
    upsert_partitions(rows.where(F.col("sale_date") == last_day), table, ["sale_date"])
    return spark.table(table)


_DAYS = """
    SELECT 'B2B platform' AS data_source, CAST(sale_date AS DATE) AS sale_date FROM r_sales
    UNION ALL SELECT '3rd party', CAST(created AS DATE) FROM r_drops"""


@_query(
    "partition_listing",
    _with_roles(
        f"""SELECT DISTINCT 'data_source=' || data_source || '/sale_date=' || CAST(sale_date AS STRING) AS "partition"
        FROM ({_DAYS}) AS days""",
        "sales", "drops",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_partitions(spark, shared_mart(spark, sf_dir).name("sales"))


@_query(
    "latest_partition",
    _with_roles(f"SELECT max(sale_date) AS latest_day FROM ({_DAYS}) AS days", "sales", "drops"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.latest_partition(list_partitions(spark, shared_mart(spark, sf_dir).name("sales")))


@_query(
    "next_file_day",
    _with_roles(
        """SELECT next_day, strftime(next_day, '%m%d%Y') AS name_day
        FROM (SELECT max(CAST(created AS DATE)) + 1 AS next_day FROM r_drops) AS latest""",
        "drops",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    partitions = list_partitions(spark, shared_mart(spark, sf_dir).name("sales_csv"))
    return watermark.next_day(watermark.latest_partition(partitions, "file_day"))


@_query(
    "incremental_watermark",
    _with_roles(
        f"SELECT data_source, max(sale_date) AS latest_day FROM ({_DAYS}) AS days GROUP BY data_source",
        "sales", "drops",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_mart(spark, sf_dir).name("sales")

    def of(origin: str) -> DataFrame:
        latest = watermark.latest_partition(list_partitions(spark, table, data_source=origin))
        return union.with_origin(latest, origin)

    return of(S.OWN_ORIGIN).unionByName(of(S.THIRD_PARTY_ORIGIN))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
