"""Relational source tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


# Rows that a driver fetches at a time. Some drivers hold a whole result without it.
FETCH_SIZE = "10000"


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    *,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Scan a whole table; in parallel when a column range or predicates are given.

    ``partition_column`` with its bounds suits numbers, dates and timestamps.
    ``predicates`` give one task each and must cover every row once. Filters put
    on the result are pushed to the database in every case.
    """
    options = {"fetchsize": FETCH_SIZE, **options}
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give either predicates or a partition column")
        settings = dict(options)
        return spark.read.jdbc(settings.pop("url"), table, predicates=list(predicates), properties=settings)
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if lower is None or upper is None or num_partitions is None:
            raise ValueError("a partition column needs both bounds and a number of partitions")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=str(num_partitions),
        )
    return reader.load()


def uuid_ranges(column: str, parts: int) -> list[str]:
    """Predicates that cut a UUID key into ``parts`` equal ranges.

    Random UUIDs are uniform, so the ranges stay even when one day, customer or
    reseller holds a large share of the rows, and each is one index range scan.
    """
    if parts < 1:
        raise ValueError("parts must be positive")
    cuts = [f"{i * 2**32 // parts:08x}-0000-0000-0000-000000000000" for i in range(1, parts)]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < '{cuts[0]}' OR {column} IS NULL"
    middle = [f"{column} >= '{low}' AND {column} < '{high}'" for low, high in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= '{cuts[-1]}'"]


@dataclass(frozen=True)
class JdbcSource:
    """``source(name)`` gives the table ``name`` of one database schema.

    ``uuid_splits`` names the key column of each table that is read in parallel, and
    ``table_parts`` the number of reads where a table's differs from ``parts``.
    ``row_hash`` is an expression of the database that makes a whole number of all columns
    of a sale; with it, the fingerprints of days are computed there.
    """

    spark: SparkSession
    options: Mapping[str, str]
    schema: str = "public"
    uuid_splits: Mapping[str, str] = field(default_factory=dict)
    parts: int = 64
    table_parts: Mapping[str, int] = field(default_factory=dict)
    row_hash: str | None = None

    def __call__(self, name: str) -> DataFrame:
        key = self.uuid_splits.get(name)
        return read_jdbc(
            self.spark,
            self.options,
            f"{self.schema}.{name}",
            predicates=uuid_ranges(key, self.table_parts.get(name, self.parts)) if key else None,
        )

    def fingerprint_query(self) -> str:
        return (
            "SELECT CAST(sale_date AS DATE) AS sale_date, COUNT(*) AS n, SUM(ticket_quantity) AS tickets, "
            f"SUM(total_amount) AS amount, SUM({self.row_hash}) AS digest "
            f"FROM {self.schema}.sales GROUP BY CAST(sale_date AS DATE)"
        )

    def sales_fingerprints(self) -> DataFrame | None:
        """As ``day_fingerprints`` of the sales, aggregated by the database; a row per day comes back."""
        if self.row_hash is None:
            return None
        types = {"sale_date": "date", "n": "long", "tickets": "long", "amount": "decimal(38,2)", "digest": "decimal(38,0)"}
        found = read_jdbc(self.spark, self.options, f"({self.fingerprint_query()}) AS days")
        return found.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in types.items()])
