from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ticketmart import schemas as S


@dataclass(frozen=True)
class Mart:
    """Where a mart reads from and writes to.

    ``source(name)`` gives a relational source table, ``drops`` is the folder of
    the reseller drops and ``checkpoint`` the folder in which the drop stream keeps
    its progress; without one, drops are found by day. ``keep_sale_time`` stores the
    time of own sales beside their day. ``agreements_in_force`` takes only agreements that
    hold on the day of the sale, ``reconcile_sales`` looks for own sales that came, changed
    or went on any day, not just since the last one. ``last_deliveries`` takes a sale that
    several drops hold from the one delivered last. ``heavy_share`` is the share of all rows
    from which on a key of a large dimension is dealt over many tasks.
    """

    spark: SparkSession
    database: str
    source: Callable[[str], DataFrame]
    drops: str
    checkpoint: str | None = None
    keep_sale_time: bool = False
    agreements_in_force: bool = False
    reconcile_sales: bool = False
    last_deliveries: bool = False
    heavy_share: float | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in S.DIMENSIONS}
