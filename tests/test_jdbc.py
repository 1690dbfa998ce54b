"""The options of a JDBC scan. No database is started, so the scan itself is not run."""

from __future__ import annotations

import uuid

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ticketmart.sources.jdbc import JdbcSource, read_jdbc, uuid_ranges

OPTIONS = {"url": "jdbc:example://host/db", "user": "u", "password": "p", "driver": "d"}


class Reader:
    """Stands in for ``spark.read`` and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def load(self):
        return self.told

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


class Session:
    @property
    def read(self):
        return Reader()


def test_whole_table():
    assert read_jdbc(Session(), OPTIONS, "public.venues") == {
        **OPTIONS, "format": "jdbc", "dbtable": "public.venues", "fetchsize": "10000",
    }
    assert read_jdbc(Session(), {**OPTIONS, "fetchsize": "5"}, "public.venues")["fetchsize"] == "5"


def test_column_range():
    told = read_jdbc(
        Session(), OPTIONS, "public.sales", partition_column="sale_date", lower="2019-01-01", upper="2023-01-01", num_partitions=8
    )
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"], told["numPartitions"]) == (
        "sale_date", "2019-01-01", "2023-01-01", "8",
    )
    with pytest.raises(ValueError, match="bounds"):
        read_jdbc(Session(), OPTIONS, "public.sales", partition_column="sale_date")
    with pytest.raises(ValueError, match="either"):
        read_jdbc(Session(), OPTIONS, "public.sales", partition_column="sale_date", predicates=["1 = 1"])


def test_source_splits_large_tables_by_key():
    splits = {"sales": "sale_id", "customers": "customer_id"}
    source = JdbcSource(Session(), OPTIONS, uuid_splits=splits, parts=4, table_parts={"customers": 2})
    assert "predicates" not in source("venues")
    told = source("sales")
    assert told["dbtable"] == "public.sales" and len(told["predicates"]) == 4
    assert told["url"] == OPTIONS["url"] and told["user"] == "u" and told["fetchsize"] == "10000"
    assert len(source("customers")["predicates"]) == 2
    assert OPTIONS["url"]  # the caller's options are left as they are


@given(st.uuids() | st.none(), st.integers(1, 70))
def test_every_key_is_in_exactly_one_range(key, parts):
    ranges = uuid_ranges("k", parts)
    assert len(ranges) == parts
    value = "NULL" if key is None else f"'{key}'"
    counted = " + ".join(f"CASE WHEN {condition} THEN 1 ELSE 0 END" for condition in ranges)
    assert duckdb.sql(f"SELECT {counted} FROM (SELECT CAST({value} AS UUID) AS k)").fetchall() == [(1,)]


def test_ranges_are_even():
    keys = [str(uuid.uuid4()) for _ in range(2000)]
    cuts = uuid_ranges("k", 4)
    counts = [duckdb.sql(f"SELECT count(*) FROM (SELECT unnest({keys}) AS k) WHERE {cut}").fetchall()[0][0] for cut in cuts]
    assert sum(counts) == 2000 and min(counts) > 400


def test_fingerprints_of_days_are_made_by_the_database():
    assert JdbcSource(Session(), OPTIONS).sales_fingerprints() is None
    source = JdbcSource(Session(), OPTIONS, schema="main", row_hash="hash(sale_id) % 1000")
    connection = duckdb.connect()
    connection.execute("CREATE TABLE sales (sale_id VARCHAR, ticket_quantity INT, total_amount DECIMAL(10,2), sale_date TIMESTAMP)")
    connection.execute("INSERT INTO sales VALUES ('a', 2, 1.50, '2020-01-01 10:00'), ('b', 3, 2.25, '2020-01-01 23:59'), ('c', 1, 1, NULL)")
    found = connection.execute(source.fingerprint_query()).fetchall()
    assert sorted((str(row[0]), row[1], row[2], float(row[3])) for row in found) == [("2020-01-01", 2, 5, 3.75), ("None", 1, 1, 1.0)]
