"""The driver's test tables seen as ticketing tables.

Each role is one SQL text over whole tables that Spark and DuckDB both run; table
names stand in braces. Every line item is an own sale and, in another role, a
line of a reseller's drop.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from ticketmart import schemas as S

_DROP_DAY = "CAST(date_trunc('quarter', l_shipdate) AS DATE)"


def _drop_name(reseller: str) -> str:
    day = f"CAST({_DROP_DAY} AS STRING)"
    stamp = f"substr({day}, 6, 2) || substr({day}, 9, 2) || substr({day}, 1, 4)"
    return f"'DailySales_' || {stamp} || '_' || CAST({reseller} AS STRING)"


# Drop columns shared by both third-party roles. Names that end in 1 belong to
# no event and names that end in 0 to two, see the events role.
_DROP_COLUMNS = f"""
    CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
        || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS transaction_id,
    'Show ' || CAST(l_partkey AS STRING) AS event_name,
    CAST(CAST(l_quantity AS INT) AS STRING) AS tickets,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) AS amount,
    CASE l_returnflag WHEN 'A' THEN 'office' WHEN 'N' THEN 'web' ELSE 'mobile app' END AS channel,
    'Kim' AS first_name,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag || l_linestatus END AS last_name,
    CASE l_returnflag WHEN 'A' THEN 'London' ELSE NULL END AS office,
    CAST({_DROP_DAY} AS STRING) AS created"""

ROLES: dict[str, str] = {
    "venues": """
        SELECT CAST(n_nationkey AS STRING) AS venue_id, n_name AS venue_name, r_name AS location
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "organizers": """
        SELECT CAST(r_regionkey AS STRING) AS organizer_id, r_name AS organizer_name FROM {region}""",
    "resellers": """
        SELECT CAST(s_suppkey AS STRING) AS reseller_id, s_name AS reseller_name, n_name AS location
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "customers": """
        SELECT CAST(c_custkey AS STRING) AS customer_id, c_name AS customer_name FROM {customer}""",
    "sales_channels": """
        SELECT DISTINCT o_orderstatus AS sales_channel_id,
            CASE o_orderstatus WHEN 'F' THEN 'on-the-site' WHEN 'O' THEN 'web' ELSE 'mobile app' END
                AS channel_name
        FROM {orders}""",
    "events": """
        SELECT CAST(p_partkey AS STRING) AS event_id,
            'Show ' || CAST(CASE WHEN p_partkey % 10 = 1 THEN p_partkey - 1 ELSE p_partkey END AS STRING)
                AS event_name,
            p_type AS event_type,
            CAST(p_partkey % 25 AS STRING) AS venue_id
        FROM {part}""",
    # Two agreements per reseller; for a fifth of the resellers with the same organizer.
    "partnerships": """
        SELECT 'nation-' || CAST(s_suppkey AS STRING) AS partnership_id,
            CAST(n_regionkey AS STRING) AS organizer_id,
            CAST(s_suppkey AS STRING) AS reseller_id,
            CAST(CAST(s_suppkey * 37 % 9000 + 100 AS DOUBLE) / 100 AS DECIMAL(5,2)) AS commission_rate,
            DATE '2017-01-01' + CAST(s_suppkey % 730 AS INT) AS start_date,
            DATE '2019-01-01' + CAST(s_suppkey % 1000 AS INT) AS end_date
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
        UNION ALL
        SELECT 'turn-' || CAST(s_suppkey AS STRING), CAST(s_suppkey % 5 AS STRING),
            CAST(s_suppkey AS STRING),
            CAST(CAST(s_suppkey * 53 % 9000 + 100 AS DOUBLE) / 100 AS DECIMAL(5,2)),
            DATE '2018-01-01' + CAST(s_suppkey % 365 AS INT),
            DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INT)
        FROM {supplier}""",
    # Booked on the first day of the order's quarter, the first line at midnight, others later.
    "sales": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
                || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS sale_id,
            CAST(l_partkey AS STRING) AS event_id,
            CAST(l_partkey % 25 AS STRING) AS venue_id,
            CAST(l_partkey % 5 AS STRING) AS organizer_id,
            CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS reseller_id,
            CAST(o_custkey AS STRING) AS customer_id,
            o_orderstatus AS sales_channel_id,
            CAST(l_quantity AS INT) AS ticket_quantity,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount,
            date_trunc('quarter', o_orderdate) + INTERVAL '1' HOUR * (l_linenumber - 1) AS sale_date
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # The parts of a sale that need no order.
    "sale_lines": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
                || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS sale_id,
            CAST(l_partkey AS STRING) AS event_id,
            CAST(l_partkey % 5 AS STRING) AS organizer_id,
            CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS reseller_id
        FROM {lineitem}""",
    "sale_orders": """
        SELECT CAST(o_orderkey AS STRING) AS sale_id, CAST(o_custkey AS STRING) AS customer_id,
            o_orderstatus AS sales_channel_id
        FROM {orders}""",
    "activity": """
        SELECT CAST(event_id AS STRING) AS sale_id, value AS total_amount, ts AS sale_date FROM {events}""",
    # Lines with the file they came from; a name that does not fit for line 7.
    "drop_lines": f"""
        SELECT {_DROP_COLUMNS},
            's3://drops/' || {_drop_name("l_suppkey")}
                || CASE WHEN l_linenumber = 7 THEN '.CSV' ELSE '.csv' END AS source_file
        FROM {{lineitem}}""",
    # The same lines as real drops: in each region the reseller with the lowest key
    # files one drop a quarter for all, so the number of drops does not grow with the data.
    # The hint is safe: there is one lead per region.
    "drops": f"""
        SELECT /*+ BROADCAST(leads) */ {_DROP_COLUMNS},
            CAST(lead_key AS STRING) AS lead_reseller,
            CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END AS is_wide,
            {_drop_name("lead_key")} || '.csv' AS source_file
        FROM {{lineitem}}
            JOIN {{supplier}} ON l_suppkey = s_suppkey
            JOIN {{nation}} ON s_nationkey = n_nationkey
            JOIN (SELECT n_regionkey AS lead_region, MIN(s_suppkey) AS lead_key
                  FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
                  GROUP BY n_regionkey) AS leads ON n_regionkey = lead_region""",
}


def _tables_in(sql: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(sql) if field})


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The role as a Spark DataFrame over the Parquet tables of ``sf_dir``."""
    sql = ROLES[name]
    tables = {table: spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in _tables_in(sql)}
    return spark.sql(sql, **tables)


def role_sql(name: str) -> str:
    """The role as SQL over tables registered under their own names."""
    sql = ROLES[name]
    return sql.format(**{table: table for table in _tables_in(sql)})


def as_drop_rows(lines: DataFrame) -> DataFrame:
    """Role columns under the header names that a drop has."""
    names = ("transaction_id", "event_name", "tickets", "amount", "channel",
             "first_name", "last_name", "office", "created")
    return lines.withColumnsRenamed(dict(zip(names, S.NARROW_LAYOUT)))
