from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketmart import schemas as S


def reseller_from_file(source_file: Column) -> Column:
    """Reseller id inside a drop's name; the empty text when the name does not fit."""
    return F.regexp_extract(source_file, S.DROP_NAME_PATTERN, 1)


def drop_day(source_file: Column) -> Column:
    """Day inside a drop's name; NULL when the name does not fit."""
    digits = F.regexp_extract(source_file, S.DROP_DAY_PATTERN, 1)
    return F.try_to_timestamp(digits, F.lit(S.DROP_DAY_FORMAT)).cast("date")


def drop_path(source_file: Column) -> Column:
    """Path of the drop that a file is, or lies in; both forms of a local path are one."""
    path = F.regexp_replace(source_file, "^file:/+", "file:/")
    found = F.regexp_extract(path, f"^.*{S.DROP_NAME_PATTERN}", 0)
    return F.when(found != "", found).otherwise(path)


def full_name(first: Column, last: Column) -> Column:
    """Both parts with a space between; NULL as soon as one part is NULL."""
    return F.concat(first, F.lit(" "), last)


def normal_channel(channel: Column) -> Column:
    """Map the resellers' word for box-office sales to the platform's; keep the rest."""
    return F.when(channel == S.OFFICE_CHANNEL, S.ON_SITE_CHANNEL).otherwise(channel)


def seller_type(reseller_id: Column) -> Column:
    """A sale without reseller was made by the organizer."""
    return F.when(reseller_id.isNull(), S.SOLD_BY_ORGANIZER).otherwise(S.SOLD_BY_RESELLER)


def sale_day(moment: Column) -> Column:
    return F.to_date(moment)


def any_of(value: Column, days: Sequence[dt.date | None]) -> Column:
    """Whether a day is one of ``days``, None included."""
    known = [day for day in days if day is not None]
    found = value.isin(known) if known else F.lit(False)
    return found | value.isNull() if len(known) < len(days) else found
