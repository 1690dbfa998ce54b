from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, T, drop_line, mart_of, own_sale, put_drop, rows, small_source
from ticketmart.operators.in_force import by_month, lookup_in_force
from ticketmart.operators.own_sales import agreement_periods, enrich_own_sales
from ticketmart.plans.refresh import daily_refresh, initial_load
from ticketmart.session import scoped_settings

PERIODS = [
    ("p1", "k1", D(2020, 1, 10), D(2020, 3, 5)),
    ("p2", "k1", D(2020, 3, 5), D(2020, 3, 5)),  # one day, in force together with p1
    ("p3", "k1", D(2020, 3, 6), None),
    ("p4", "k2", None, D(2020, 2, 29)),
    ("p5", "k2", None, None),
    ("p6", "k3", D(2021, 5, 2), D(2021, 5, 1)),  # ends before it starts
    ("p7", None, D(2020, 1, 1), None),
    ("p1", "k1", D(2020, 1, 10), D(2020, 3, 5)),  # a repeated row counts twice
]
DAYS = [
    D(1850, 1, 1), D(2020, 1, 9), D(2020, 1, 10), D(2020, 2, 1), D(2020, 2, 29), D(2020, 3, 1), D(2020, 3, 5), D(2020, 3, 6),
    D(2021, 5, 1), D(2021, 5, 2), D(2199, 12, 31), None,
]
FACTS = [(f"{key}-{day}", key, day) for key in ("k1", "k2", "k3", "k9", None) for day in DAYS]


def frames(spark, facts=FACTS, periods=PERIODS):
    return (
        spark.createDataFrame(facts, "id string, k string, day date"),
        spark.createDataFrame(periods, "p string, k string, since date, until date"),
    )


def brute(facts, periods):
    found = []
    for fact_id, key, day in facts:
        held = [
            (p, since, until)
            for p, k, since, until in periods
            if day and key and k == key and (since or day) <= day <= (until or day) and not (since and until and since > until)
        ]
        found += [(fact_id, key, day, *period) for period in held or [(None, None, None)]]
    return sorted(found, key=repr)


def of_known_size(spark, frame, folder):
    frame.write.parquet(str(folder / "periods"))
    return spark.read.parquet(str(folder / "periods"))


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_periods_in_force(spark, tmp_path, limit):
    facts, periods = frames(spark)
    periods = of_known_size(spark, periods, tmp_path)
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": limit}):
        laid_out = by_month(periods, "since", "until")
        assert laid_out.is_small == (limit != "-1")
        found = lookup_in_force(facts, laid_out, "k", day="day", spread_by="id")
        assert found.columns == ["id", "k", "day", "p", "since", "until"]
        assert rows(found) == brute(FACTS, PERIODS)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (limit != "-1")


@pytest.mark.parametrize("periods", [[], [("p5", "k2", None, None)], [("p6", "k3", D(2021, 5, 2), D(2021, 5, 1))]])
def test_tables_without_bounds(spark, periods):
    facts, frame = frames(spark, periods=periods)
    found = lookup_in_force(facts, by_month(frame, "since", "until"), "k", day="day", spread_by="id")
    assert rows(found) == brute(FACTS, periods)
    empty, frame = frames(spark, facts=[], periods=periods)
    assert rows(lookup_in_force(empty, by_month(frame, "since", "until"), "k", day="day", spread_by="id")) == []


def test_a_key_with_many_periods_is_compared_within_the_month(spark):
    """3,000 periods of one day each and a hot key: the join sees a month's at a time."""
    periods = spark.range(3000).selectExpr(
        "concat('p', id) as p", "'k' as k", "date_add(date'2015-01-01', cast(id as int)) as since", "date_add(date'2015-01-01', cast(id as int)) as until"
    )
    facts = spark.range(0, 30_000, 1, 4).selectExpr(
        "cast(id as string) as id", "'k' as k", "date_add(date'2015-01-01', cast(id % 3000 as int)) as day"
    )
    laid_out = by_month(periods, "since", "until")
    found = lookup_in_force(facts, laid_out, "k", day="day", spread_by="id")
    assert found.where("since = day AND p = concat('p', cast(id % 3000 as string))").count() == 30_000
    assert laid_out.rows.groupBy("k", "_month").count().agg({"count": "max"}).first()[0] == 31


def test_own_sales_take_the_agreements_of_their_day(spark):
    sales = [
        own_sale("before", T(2016, 12, 31, 23, 59), "r1"), own_sale("first", T(2017, 1, 1), "r1"),
        own_sale("last", T(2019, 1, 1, 23, 59, 59), "r1"), own_sale("after", T(2019, 1, 2), "r1"),
        own_sale("open", T(2030, 1, 1), "r2"), own_sale("early", T(2016, 1, 1), "r2"),
        own_sale("undated", None, "r1"), own_sale("organizer", T(2018, 1, 1), None),
    ]
    tables = small_source(spark, sales)
    found = enrich_own_sales(tables["sales"], tables, in_force=True)
    assert rows(found, "sale_id", "partnership_id") == sorted(
        [("before", None), ("first", "p1"), ("last", "p1"), ("after", None), ("open", "p2"), ("open", "p3"), ("early", "p3"),
         ("undated", None), ("organizer", None)], key=repr,
    )
    every = enrich_own_sales(tables["sales"], tables)
    assert every.columns == found.columns and every.count() == 10


def test_loads_with_agreements_in_force(spark, database, tmp_path):
    source = small_source(spark, [own_sale("s1", T(2019, 1, 1), "r1"), own_sale("s2", T(2019, 1, 2), "r1")])
    mart = mart_of(spark, database, source, tmp_path, agreements_in_force=True)
    drops = tmp_path / "drops"
    put_drop(drops, "01012020", "r2", [drop_line("1", "2020-01-01"), drop_line("2", "2020-01-02")])
    put_drop(drops, "01012020", "r1", [drop_line("3", "2020-01-01")])
    initial_load(mart)
    put_drop(drops, "01032020", "r2", [drop_line("4", "2016-01-03")])
    daily_refresh(mart)
    assert rows(mart.table("sales"), "sale_id", "partnership_id", "organizer_id", "reseller_name") == sorted(
        [("1", "p2", "o1", "Res 2"), ("1", "p3", "o1", "Res 2"), ("1", "p4", "o2", "Res 2"), ("2", "p2", "o1", "Res 2"),
         ("2", "p3", "o1", "Res 2"), ("3", None, None, "Res 1"), ("4", "p3", "o1", "Res 2"), ("s1", "p1", "o1", "Res 1"),
         ("s2", None, "o1", "Res 1")], key=repr,
    )


def test_the_size_check_counts_months(spark, tmp_path):
    """A small dimension whose periods touch many months is not broadcast."""
    periods = spark.createDataFrame([("p", "k", D(1, 1, 1), D(9999, 12, 31))] * 50, "p string, k string, since date, until date")
    assert not by_month(periods, "since", "until").is_small  # of unknown size
    periods = of_known_size(spark, periods, tmp_path)
    size = int(periods._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": str(size * 100)}):
        assert not by_month(periods, "since", "until").is_small
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": str(size * 200_000)}):
        assert by_month(periods, "since", "until").is_small


def test_amounts_stay_exact(spark):
    tables = small_source(spark, [own_sale("s1", T(2018, 6, 1), "r1")])
    (row,) = agreement_periods(tables["partnerships"]).rows.where("partnership_id = 'p1'").select("commission_rate").distinct().collect()
    assert row["commission_rate"] == Decimal("10.50")


def test_few_periods_a_key_are_broadcast_without_months(spark, tmp_path):
    facts, periods = frames(spark)
    periods = of_known_size(spark, periods, tmp_path)
    laid_out = by_month(periods, "since", "until", ["k"])
    assert laid_out.is_plain_small and laid_out.is_broadcast
    found = lookup_in_force(facts, laid_out, "k", day="day", spread_by="id")
    assert found.columns == ["id", "k", "day", "p", "since", "until"]
    assert rows(found) == brute(FACTS, PERIODS)
    assert "_month" not in found._jdf.queryExecution().executedPlan().toString()


def test_many_periods_a_key_keep_their_months(spark, tmp_path):
    periods = spark.createDataFrame([("p", "k", D(2020, 1, 1), D(2020, 1, 2))] * 65, "p string, k string, since date, until date")
    assert not by_month(of_known_size(spark, periods, tmp_path), "since", "until", ["k"]).is_plain_small


def test_the_size_check_counts_long_rows(spark, tmp_path, monkeypatch):
    from ticketmart.operators import lookup

    _, periods = frames(spark)
    periods = of_known_size(spark, periods.withColumn("p", F.repeat("p", 1000)), tmp_path)
    assert by_month(periods, "since", "until", ["k"]).is_plain_small
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 8 * 2000)
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1"}):
        laid_out = by_month(periods, "since", "until", ["k"])
        assert not laid_out.is_small and not laid_out.is_plain_small
