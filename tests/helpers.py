from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ticketmart import schemas as S
from ticketmart.plans.mart import Mart

D = dt.date
T = dt.datetime


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    """All rows as tuples in a stable order, NULLs included."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def source_frames(spark: SparkSession, **data: list[tuple]) -> dict[str, DataFrame]:
    return {
        name: spark.createDataFrame(data.get(name, []), schema) for name, schema in S.SOURCE_SCHEMAS.items()
    }


def small_source(spark: SparkSession, sales: list[tuple] = ()) -> dict[str, DataFrame]:
    """Reseller r0 has no agreement, r1 one, r2 two with organizer o1 and one with o2."""
    return source_frames(
        spark,
        venues=[("v1", "Arena", "Oslo")],
        organizers=[("o1", "Org 1"), ("o2", "Org 2")],
        resellers=[("r0", "Res 0", "Rome"), ("r1", "Res 1", "Bern"), ("r2", "Res 2", "Kyiv")],
        customers=[("c1", "Ann"), ("c2", "Bob")],
        sales_channels=[("h1", "web"), ("h2", "on-the-site")],
        events=[
            ("e1", "Gala", "Concert", "v1"),
            ("e2", "Derby", "Sports", "v1"),
            ("e3", "Derby", "Festival", "v1"),
        ],
        partnerships=[
            ("p1", "o1", "r1", Decimal("10.50"), D(2017, 1, 1), D(2019, 1, 1)),
            ("p2", "o1", "r2", Decimal("20.00"), D(2017, 1, 1), None),
            ("p3", "o1", "r2", Decimal("21.00"), None, None),
            ("p4", "o2", "r2", Decimal("22.00"), D(2018, 1, 1), D(2020, 1, 1)),
        ],
        sales=list(sales),
    )


def own_sale(sale_id: str, when: dt.datetime | None, reseller: str | None = None, **other) -> tuple:
    values = dict(
        sale_id=sale_id, event_id="e1", venue_id="v1", organizer_id="o1", reseller_id=reseller,
        customer_id="c1", sales_channel_id="h1", ticket_quantity=2, total_amount=Decimal("12.30"), sale_date=when,
    )
    values.update(other)
    return tuple(values[name] for name in S.SOURCE_SCHEMAS["sales"].names)


def drop_line(number: str, created: str, event: str = "Gala", **other: str) -> dict[str, str]:
    line = {
        S.TRANSACTION_ID: number, S.EVENT_ID: "", S.EVENT_NAME: event, S.TICKETS: "2", S.AMOUNT: "30.5",
        S.CHANNEL: "web", S.FIRST_NAME: "Kim", S.LAST_NAME: "Berg", S.OFFICE: "", S.CREATED: created,
    }
    line.update(other)
    return line


def put_drop(
    folder: Path, stamp: str, reseller: str, lines: list[dict[str, str]], layout=S.NARROW_LAYOUT, name: str | None = None
) -> Path:
    """One plain CSV file with CRLF line ends."""
    folder.mkdir(parents=True, exist_ok=True)
    text = "".join(",".join(cells) + "\r\n" for cells in [layout, *[[line[h] for h in layout] for line in lines]])
    path = folder / (name or f"DailySales_{stamp}_{reseller}.csv")
    path.write_text(text, newline="")
    return path


def mart_of(spark: SparkSession, database: str, source: dict[str, DataFrame], folder: Path, **more) -> Mart:
    drops = folder / "drops"
    drops.mkdir(parents=True, exist_ok=True)
    return Mart(spark, database, source.__getitem__, str(drops), **more)
