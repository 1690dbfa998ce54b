"""Made-up ticket sales for tests and trials, computed by Spark.

Every value is a hash of the seed, the column and the row number. Rows therefore
come out the same on every run and in every partitioning, and a foreign key is
computed from the number of the row it points to, without a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas as S
from ticketmart.sources.drops import write_drops

# Default row counts and value domains.
BASE_ROWS = {
    "venues": 10, "events": 5, "organizers": 5, "resellers": 3,
    "customers": 500, "partnerships": 5, "sales": 5000,
}
EVENT_TYPES = ("Concert", "Sports", "Theater", "Conference", "Festival", "Exhibition")
CHANNELS = ("on-the-site", "web", "mobile app")
DROP_CHANNELS = ("office", "web", "mobile app")
OFFICES = ("New York", "London", "Tokyo", "Sydney", "San Francisco")
FIRST_NAMES = ("Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gia", "Hugo")
LAST_NAMES = ("Abe", "Berg", "Cruz", "Diaz", "Ekman", "Ford", "Grau", "Hale")
FIRST_DAY = "2019-01-01"
SALE_DAYS = 1461  # 2019 to 2022
DROP_DAYS = 730  # 2019-01-01 to 2020-12-30
MAX_DROP_ROWS = 300


class _Values:
    """Hash-based values of one seed."""

    def __init__(self, seed: int, heaviest: float | None = None) -> None:
        self.seed, self.heaviest = seed, heaviest

    def key(self, label: str, row: Column, below: int) -> Column:
        """Number of another table's row: uniform, or skewed with ``heaviest`` as row 0's share.

        The other rows share the rest by a power law, row r about 1 / r: the inverse of its
        distribution turns a uniform number into a row, so no row is looked up. Row 1 has
        the most of them; too small a share for row 0 is refused.
        """
        if self.heaviest is None or below < 2:
            return self.number(label, row, below)
        rest = math.log(2) / math.log(below) * (1 - self.heaviest)
        if not rest <= self.heaviest < 1:
            raise ValueError(f"the heaviest of {below} keys needs a share from {rest:.3f} up to 1")
        uniform = (self.number(label, row, 1 << 40) + 0.5) / float(1 << 40)
        lot = (uniform - self.heaviest) / (1 - self.heaviest)
        other = F.least(F.floor(F.pow(F.lit(float(below)), lot)), F.lit(below - 1))
        return F.when(uniform < self.heaviest, F.lit(0)).otherwise(other).cast("long")

    def number(self, label: str, row: Column, below: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(label), row), F.lit(below))

    def between(self, label: str, row: Column, low: int, high: int) -> Column:
        return self.number(label, row, high - low + 1) + low

    def choice(self, label: str, row: Column, values: tuple[str, ...]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (self.number(label, row, len(values)) + 1).cast("int"))

    def uuid(self, table: str, row: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(self.seed)), F.lit(table), row.cast("string")))
        parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        return F.concat_ws("-", *[F.substring(digest, at, width) for at, width in parts])


def _hundredths(amount: Column, kind) -> Column:
    return (amount.cast("decimal(18,0)") / 100).cast(kind)


def row_counts(scale: float) -> dict[str, int]:
    return {name: max(1, round(rows * scale)) for name, rows in BASE_ROWS.items()}


def _named(kind: str, row: Column) -> Column:
    return F.concat(F.lit(f"{kind} "), row.cast("string"))


def generate_tables(
    spark: SparkSession, scale: float = 1.0, seed: int = 0, heaviest: float | None = None
) -> dict[str, DataFrame]:
    """All source tables with consistent keys; every third sale has no reseller.

    ``heaviest`` is the share of sales that the most frequent customer has, and the most
    frequent event; without it customers and events are even.
    """
    rows, v, row = row_counts(scale), _Values(seed, heaviest), F.col("id")

    def table(name: str, count: int | None = None, **columns: Column) -> DataFrame:
        schema = S.SOURCE_SCHEMAS[name]
        base = spark.range(count or rows[name])
        return base.select([columns[f.name].cast(f.dataType).alias(f.name) for f in schema])

    def other(name: str, label: str) -> Column:
        return v.uuid(name, v.number(label, row, rows[name]))

    event = v.key("sale event", row, rows["events"])
    start = F.date_add(F.lit("2017-01-01").cast("date"), v.number("start", row, 730).cast("int"))
    first_second = F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp"))
    return {
        "venues": table(
            "venues",
            venue_id=v.uuid("venues", row),
            venue_name=_named("Venue", row),
            location=v.choice("venue place", row, OFFICES),
        ),
        "organizers": table(
            "organizers", organizer_id=v.uuid("organizers", row), organizer_name=_named("Organizer", row)
        ),
        "resellers": table(
            "resellers",
            reseller_id=v.uuid("resellers", row),
            reseller_name=_named("Reseller", row),
            location=v.choice("reseller place", row, OFFICES),
        ),
        "customers": table(
            "customers", customer_id=v.uuid("customers", row), customer_name=_named("Customer", row)
        ),
        "sales_channels": table(
            "sales_channels",
            len(CHANNELS),
            sales_channel_id=v.uuid("sales_channels", row),
            channel_name=F.element_at(F.array(*map(F.lit, CHANNELS)), (row + 1).cast("int")),
        ),
        "events": table(
            "events",
            event_id=v.uuid("events", row),
            event_name=_named("Show", row),
            event_type=v.choice("event type", row, EVENT_TYPES),
            venue_id=v.uuid("venues", _venue_of(v, row, rows)),
        ),
        "partnerships": table(
            "partnerships",
            partnership_id=v.uuid("partnerships", row),
            organizer_id=other("organizers", "partnership organizer"),
            reseller_id=other("resellers", "partnership reseller"),
            commission_rate=_hundredths(v.between("rate", row, 1, 9999), S.RATE),
            start_date=start,
            end_date=F.date_add(start, v.between("length", row, 720, 1080).cast("int")),
        ),
        "sales": table(
            "sales",
            sale_id=v.uuid("sales", row),
            event_id=v.uuid("events", event),
            venue_id=v.uuid("venues", _venue_of(v, event, rows)),
            organizer_id=other("organizers", "sale organizer"),
            reseller_id=F.when(row % 3 != 0, other("resellers", "sale reseller")),
            customer_id=v.uuid("customers", v.key("sale customer", row, rows["customers"])),
            sales_channel_id=v.uuid("sales_channels", v.number("sale channel", row, len(CHANNELS))),
            ticket_quantity=v.between("tickets", row, 1, 10),
            total_amount=_hundredths(v.between("amount", row, 1, 9_999_999), S.MONEY),
            sale_date=F.timestamp_seconds(first_second + v.number("moment", row, SALE_DAYS * 86_400)),
        ),
    }


def _venue_of(v: _Values, event: Column, rows: dict[str, int]) -> Column:
    return v.number("event venue", event, rows["venues"])


def drop_lines(
    spark: SparkSession, n_files: int, scale: float = 1.0, seed: int = 0, heaviest: float | None = None
) -> DataFrame:
    """Lines of ``n_files`` drops of 10 to 300 rows each, with the name of their drop.

    ``heaviest`` is the share of lines that the most frequent event has.
    """
    rows, v, file = row_counts(scale), _Values(seed, heaviest), F.col("file")
    line = F.col("line")
    channel = v.choice("drop channel", line, DROP_CHANNELS)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), v.number("drop day", file, DROP_DAYS).cast("int"))
    reseller = v.uuid("resellers", v.number("drop reseller", file, rows["resellers"]))
    lines = (
        spark.range(n_files)
        .select(F.col("id").alias("file"))
        .select("file", F.explode(F.sequence(F.lit(1), v.between("drop rows", file, 10, MAX_DROP_ROWS).cast("int"))).alias("at"))
        .select("file", (file * MAX_DROP_ROWS + F.col("at")).alias("line"))
    )
    return lines.select(
        line.cast("string").alias(S.TRANSACTION_ID),
        _named("Show", v.key("drop event", line, rows["events"])).alias(S.EVENT_NAME),
        v.between("drop tickets", line, 1, 5).cast("string").alias(S.TICKETS),
        _hundredths(v.between("drop amount", line, 2000, 20000), S.MONEY).cast("string").alias(S.AMOUNT),
        channel.alias(S.CHANNEL),
        v.choice("first", line, FIRST_NAMES).alias(S.FIRST_NAME),
        v.choice("last", line, LAST_NAMES).alias(S.LAST_NAME),
        F.when(channel == S.OFFICE_CHANNEL, v.choice("office", line, OFFICES)).alias(S.OFFICE),
        day.cast("string").alias(S.CREATED),
        F.concat(
            F.lit("DailySales_"), F.date_format(day, S.DROP_DAY_FORMAT), F.lit("_"), reseller, F.lit(".csv")
        ).alias("drop"),
    )


def generate_daily_files(
    spark: SparkSession, folder: str, n_files: int, scale: float = 1.0, seed: int = 0, heaviest: float | None = None
) -> None:
    write_drops(drop_lines(spark, n_files, scale, seed, heaviest), folder)
