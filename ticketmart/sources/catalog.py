"""Catalog tables and their partitions, read from metadata only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas as S
from ticketmart.sources.files import delete_folder


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def folder_beside(spark: SparkSession, table: str) -> str:
    """Folder of that name inside the folder of the table's database."""
    database, _, name = table.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{name.lower()}"


def versions_folder(spark: SparkSession, table: str) -> str:
    """Folder of a table's versions."""
    return f"{folder_beside(spark, table)}_versions"


def list_partitions(spark: SparkSession, table: str, **only: str) -> DataFrame:
    """One row ``partition`` per stored partition, for instance ``sale_date=2020-01-31``.

    ``only`` restricts the listing, for instance ``data_source="3rd party"``.
    """
    spec = ", ".join(f"{column} = '{value}'" for column, value in only.items())
    return spark.sql(f"SHOW PARTITIONS {table}" + (f" PARTITION ({spec})" if spec else ""))


def partition_day(partition: Column, column: str) -> Column:
    """The day in a partition name; NULL for the partition of NULL days."""
    text = F.regexp_extract(partition, rf"(?:^|/){column}=([^/]*)", 1)
    return F.when(text != S.NULL_PARTITION, text).cast("date")


# Partitions that one statement names.
_PARTITIONS_AT_ONCE = 200


def partition_spec(values: Mapping[str, object]) -> str:
    parts = [f"{column} = {'NULL' if value is None else repr(str(value))}" for column, value in values.items()]
    return f"PARTITION ({', '.join(parts)})"


def drop_partitions(spark: SparkSession, table: str, partitions: Sequence[Mapping[str, object]]) -> None:
    """Remove partitions and their files; None stands for the partition of NULLs.

    The columns come in the table's order. The catalog drops the files of managed tables
    only, so the folders are deleted here, after the catalog has forgotten them.
    """
    if not partitions:
        return
    location = table_location(spark, table).rstrip("/")
    for at in range(0, len(partitions), _PARTITIONS_AT_ONCE):
        some = partitions[at : at + _PARTITIONS_AT_ONCE]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(partition_spec, some))}")
        for values in some:
            names = [f"{column}={S.NULL_PARTITION if value is None else value}" for column, value in values.items()]
            delete_folder(spark, "/".join([location, *names]))


def drop_partition(spark: SparkSession, table: str, **values: object) -> None:
    drop_partitions(spark, table, [values])
