"""Left lookups of the rows that are in force on a day.

A row of the dimension holds from its first to its last day, both included; a NULL day
leaves that side open. Joining on the keys alone would compare a fact with all periods a
key ever had. So the months that a period touches become a join key too, and the exact
days are compared for what is left. A dimension that is known to be small and has few
periods a key is broadcast as it is, without months.

Months before the first and after the last day that any period names all look alike, so
they share one month each. That bounds the months of an open period, and a fact of any
day has exactly one month: no pair is found twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.operators.lookup import (
    any_null,
    broadcast_limit,
    known_small,
    planned_bytes,
    row_bytes,
    sized,
    spread_key,
    unpacked_limit,
)

_MONTH, _FIRST, _LAST, _SPREAD = "_month", "_first_day", "_last_day", "_spread"

# Periods of a key that each of its facts may be compared with.
MAX_PERIODS = 64


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


@dataclass(frozen=True)
class Periods:
    """Rows of a dimension once for each month they touch, and whether they are known to be small.

    ``plain`` has each row once; ``is_plain_small`` says that it is small and has few rows a key.
    """

    rows: DataFrame
    earliest: int
    latest: int
    is_small: bool
    plain: DataFrame
    is_plain_small: bool

    @property
    def is_broadcast(self) -> bool:
        return self.is_small or self.is_plain_small


def by_month(dimension: DataFrame, start: str, end: str, keys: Sequence[str] = ()) -> Periods:
    """Lay out a dimension by the months of its periods; one small aggregate tells the bounds.

    The planner knows the stored size of the dimension, but not how long its rows are nor how
    many months they touch; the aggregate tells both. A period that ends before it starts is never in force.
    With ``keys`` the periods of each key are counted too, if that may save the months.
    """
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    valid = dimension.where(F.coalesce(first <= last, F.lit(True)))
    bounds = valid.agg(
        F.least(F.min(_month(first)), F.min(_month(last))).alias("earliest"),
        F.greatest(F.max(_month(first)), F.max(_month(last))).alias("latest"),
        F.count("*").alias("periods"),
        F.sum(F.coalesce(_month(last) - _month(first) + 1, F.lit(0)).cast("long")).alias("closed_months"),
        F.count_if(first.isNull() | last.isNull()).alias("open"),
        F.avg(row_bytes(valid)).alias("row_bytes"),
    ).first()
    earliest, latest = (bounds["earliest"] or 0) - 1, (bounds["latest"] or 0) + 1
    months = (bounds["closed_months"] or 0) + bounds["open"] * (latest - earliest + 1)
    from_month = F.coalesce(_month(first), F.lit(earliest))
    to_month = F.coalesce(_month(last), F.lit(latest))
    plain = valid.withColumns({_FIRST: first, _LAST: last})
    rows = plain.withColumn(_MONTH, F.explode(F.sequence(from_month, to_month)))
    is_small = planned_bytes(dimension) * max(months, 1) <= broadcast_limit(dimension) * max(bounds["periods"], 1)
    # Three columns are added: the month and both days.
    is_small = is_small and ((bounds["row_bytes"] or 0) + 24) * months <= unpacked_limit(dimension)
    is_plain_small = False
    if keys and known_small(dimension):
        counted = valid.where(~any_null(valid, keys)).groupBy(*keys).count()
        is_plain_small = (counted.agg(F.max("count")).first()[0] or 0) <= MAX_PERIODS
    return Periods(rows, earliest, latest, is_small, plain, is_plain_small)


def lookup_in_force(facts: DataFrame, periods: Periods, *keys: str, day: str, spread_by: str) -> DataFrame:
    """One row per period of the keys that holds on the fact's day; without any, one row with NULLs.

    Facts without a key or without a day match nothing and are spread by ``spread_by``.
    A key with many facts is parted by month. The months that lie beyond all periods and
    what is still hot are left to adaptive execution, which can split the facts' side.
    """
    if periods.is_plain_small:
        return _lookup_plain(facts, periods, *keys, day=day)
    sold = F.col(day).cast("date")
    unmatched = any_null(facts, [*keys, day])
    month = F.greatest(F.least(_month(sold), F.lit(periods.latest)), F.lit(periods.earliest))
    left = facts.withColumns(
        {_MONTH: F.when(~unmatched, month).otherwise(F.lit(0)), _SPREAD: spread_key(unmatched, spread_by)}
    ).alias("facts")
    rows = periods.rows.withColumn(_SPREAD, any_null(periods.rows, keys).cast("long"))
    right = sized(rows, periods.is_small).alias("periods")
    found = [F.col(f"facts.`{key}`") == F.col(f"periods.`{key}`") for key in (*keys, _MONTH, _SPREAD)]
    condition = _holds_on(F.col(f"facts.`{day}`").cast("date"))
    for equal in found:
        condition = equal & condition
    added = [name for name in periods.rows.columns if name not in {*keys, _MONTH, _FIRST, _LAST}]
    return left.join(right, condition, "left").select(
        *[F.col(f"facts.`{name}`") for name in facts.columns], *[F.col(f"periods.`{name}`") for name in added]
    )


def _lookup_plain(facts: DataFrame, periods: Periods, *keys: str, day: str) -> DataFrame:
    left, right = facts.alias("facts"), F.broadcast(periods.plain).alias("periods")
    day_of = F.col(f"facts.`{day}`").cast("date")
    condition = day_of.isNotNull() & _holds_on(day_of)
    for key in keys:
        condition = (F.col(f"facts.`{key}`") == F.col(f"periods.`{key}`")) & condition
    added = [name for name in periods.plain.columns if name not in {*keys, _FIRST, _LAST}]
    return left.join(right, condition, "left").select(
        *[F.col(f"facts.`{name}`") for name in facts.columns], *[F.col(f"periods.`{name}`") for name in added]
    )


def _holds_on(day_of: Column) -> Column:
    since, until = F.col(f"periods.{_FIRST}"), F.col(f"periods.{_LAST}")
    return F.coalesce(since <= day_of, F.lit(True)) & F.coalesce(day_of <= until, F.lit(True))
