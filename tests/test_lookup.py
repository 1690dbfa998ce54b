from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, T, drop_line, own_sale, rows, small_source
from ticketmart import schemas as S
from ticketmart.operators import own_sales, third_party
from ticketmart.operators import lookup as lookups
from ticketmart.operators.lookup import known_small, lookup_nullable, small_dimensions, unpacked_bytes
from ticketmart.session import scoped_settings

SALES = [
    own_sale("s1", T(2020, 1, 1, 10), "r1"),
    own_sale("s2", T(2020, 1, 1, 11), "r2", event_id="e9", customer_id="c9", sales_channel_id="h9"),
    own_sale("s3", T(2020, 1, 2, 0), None, event_id="e2", sales_channel_id="h2", customer_id="c2"),
    own_sale("s4", T(2020, 1, 2, 1), "r9"),
]


def third_party_lines(spark):
    lines = [
        ("1", "Gala", "r1"), ("2", "Derby", "r2"), ("3", "Nothing", "r0"), ("4", None, "r9"), ("5", "Gala", ""),
    ]
    columns = ", ".join(f"`{h}` string" for h in [*S.NARROW_LAYOUT, "source_file"])
    data = []
    for number, event, reseller in lines:
        line = drop_line(number, "2020-05-03", event)
        name = f"DailySales_05032020_{reseller}.csv" if reseller else "somewhere.csv"
        data.append((*[line[h] for h in S.NARROW_LAYOUT], name))
    return third_party.normalise(spark.createDataFrame(data, columns))


@pytest.fixture
def tables(spark):
    return small_source(spark, SALES)


def test_event_type_without_the_events_venue(spark, tables):
    found = own_sales.with_event_type(tables["sales"], tables["events"])
    assert rows(found, "sale_id", "event_type") == [("s1", "Concert"), ("s2", None), ("s3", "Sports"), ("s4", "Concert")]
    assert found.columns.count("venue_id") == 1


def test_reseller_of_organizer_sales_is_null(spark, tables):
    found = own_sales.with_reseller(tables["sales"], tables["resellers"])
    assert rows(found, "sale_id", "reseller_name", "reseller_location") == [
        ("s1", "Res 1", "Bern"), ("s2", "Res 2", "Kyiv"), ("s3", None, None), ("s4", None, None),
    ]


def test_channel_and_customer(spark, tables):
    channel = own_sales.with_channel(tables["sales"], tables["sales_channels"])
    assert rows(channel, "sale_id", "channel_name") == [
        ("s1", "web"), ("s2", None), ("s3", "on-the-site"), ("s4", "web"),
    ]
    customer = own_sales.with_customer(tables["sales"], tables["customers"])
    assert rows(customer, "sale_id", "customer_name") == [("s1", "Ann"), ("s2", None), ("s3", "Bob"), ("s4", "Ann")]


def test_agreements_of_organizer_and_reseller_multiply_sales(spark, tables):
    found = own_sales.with_agreement(tables["sales"], tables["partnerships"])
    assert rows(found, "sale_id", "partnership_id") == [
        ("s1", "p1"), ("s2", "p2"), ("s2", "p3"), ("s3", None), ("s4", None),
    ]


def test_enriched_own_sales(spark, tables):
    found = own_sales.enrich_own_sales(tables["sales"], tables)
    assert tuple(found.columns) == S.OWN_COLUMNS
    assert found.count() == 5
    first = found.where("sale_id = 's1'").first()
    assert (first.seller_type, first.sale_date, first.total_amount) == ("reseller", D(2020, 1, 1), Decimal("12.30"))
    assert (first.channel_name, first.customer_name, first.commission_rate) == ("web", "Ann", Decimal("10.50"))
    assert found.where("sale_id = 's3'").first().seller_type == "organizer"


def test_sale_day_may_keep_the_time(spark, tables):
    found = own_sales.with_sale_day(tables["sales"], keep_time=True).where("sale_id = 's1'")
    assert rows(found, "sale_datetime", "sale_date") == [(T(2020, 1, 1, 10), D(2020, 1, 1))]


def test_third_party_agreements_bring_the_organizer_and_multiply(spark, tables):
    found = third_party.with_agreements(third_party_lines(spark), tables["partnerships"])
    assert rows(found, "sale_id", "organizer_id", "partnership_id") == [
        ("1", "o1", "p1"), ("2", "o1", "p2"), ("2", "o1", "p3"), ("2", "o2", "p4"),
        ("3", None, None), ("4", None, None), ("5", None, None),
    ]


def test_third_party_reseller(spark, tables):
    found = third_party.with_reseller(third_party_lines(spark), tables["resellers"])
    assert rows(found, "sale_id", "reseller_id", "reseller_name") == [
        ("1", "r1", "Res 1"), ("2", "r2", "Res 2"), ("3", "r0", "Res 0"), ("4", "r9", None), ("5", "", None),
    ]


def test_third_party_event_by_name(spark, tables):
    found = third_party.with_event(third_party_lines(spark), tables["events"])
    assert rows(found, "sale_id", "event_id", "event_type", "venue_id") == [
        ("1", "e1", "Concert", "v1"), ("2", "e2", "Sports", "v1"), ("2", "e3", "Festival", "v1"),
        ("3", None, None, None), ("4", None, None, None), ("5", "e1", "Concert", "v1"),
    ]


def test_enriched_third_party_equals_the_joins_one_by_one(spark, tables):
    lines = third_party_lines(spark)
    steps = third_party.with_agreements(lines, tables["partnerships"])
    steps = third_party.with_reseller(steps, tables["resellers"])
    steps = third_party.with_organizer(steps, tables["organizers"])
    steps = third_party.with_event(steps, tables["events"])
    steps = steps.withColumn("seller_type", F.lit("reseller"))
    found = third_party.enrich_third_party(lines, tables)
    assert tuple(found.columns) == (*S.THIRD_PARTY_COLUMNS, "file_day")
    assert rows(found) == rows(steps, *found.columns)
    assert {row.seller_type for row in found.collect()} == {"reseller"}


def test_shuffled_lookups_give_the_same_rows(spark, tables):
    own = rows(own_sales.enrich_own_sales(tables["sales"], tables))
    third = rows(third_party.enrich_third_party(third_party_lines(spark), tables))
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not known_small(tables["resellers"])
        assert rows(own_sales.enrich_own_sales(tables["sales"], tables)) == own
        assert rows(third_party.enrich_third_party(third_party_lines(spark), tables)) == third


def executed(frame) -> str:
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark, tmp_path):
    """Stored facts of which a third have the key 'hot' and a third no key at all."""
    facts = spark.range(0, 60_000, 1, 4).select(
        F.col("id").cast("string").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, (F.col("id") % 500).cast("string"))
        .alias("reseller_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("note"),
    )
    facts.write.parquet(f"{tmp_path}/facts")
    dimension = spark.range(500).select(F.col("id").cast("string").alias("reseller_id"), F.col("id").alias("size"))
    dimension.unionByName(spark.createDataFrame([("hot", -1)], "reseller_id string, size long")).write.parquet(
        f"{tmp_path}/dimension"
    )
    return spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/dimension")


SMALL_CLUSTER_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def test_null_keys_are_spread_and_a_hot_key_is_split(spark, large):
    facts, dimension = large
    plain = facts.join(dimension, on="reseller_id", how="left")
    expected = plain.agg(F.count("*"), F.count("size"), F.sum("size")).first()
    with scoped_settings(spark, SMALL_CLUSTER_LIMITS):
        found = lookup_nullable(facts, dimension, "reseller_id", spread_by="sale_id")
        plan = executed(found)
        assert found.agg(F.count("*"), F.count("size"), F.sum("size")).first() == expected
        assert found.count() == 60_000
    assert "skew=true" in plan
    assert re.search(r"SortMergeJoin.*\[reseller_id#\d+, _spread#\d+L\]", plan)


def test_null_keys_reach_every_shuffle_partition(spark, large):
    facts, dimension = large
    settings = {
        **SMALL_CLUSTER_LIMITS,
        "spark.sql.adaptive.enabled": "false",
    }
    with scoped_settings(spark, settings):
        found = lookup_nullable(facts, dimension, "reseller_id", spread_by="sale_id")
        sizes = [
            row["count"]
            for row in found.where("reseller_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
        ]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)


def test_a_hot_reseller_is_split_in_the_profile_join(spark, large, tmp_path):
    facts, dimension = large
    resellers = dimension.select(
        "reseller_id", F.col("size").cast("string").alias("reseller_name"), F.lit("x").alias("location")
    )
    partnerships = dimension.select(
        F.concat(F.lit("p"), "reseller_id").alias("partnership_id"), F.lit("o1").alias("organizer_id"), "reseller_id"
    )
    with scoped_settings(spark, SMALL_CLUSTER_LIMITS):
        found = third_party.with_reseller_profile(facts, resellers, partnerships)
        plan = executed(found)
        assert found.count() == 60_000
    assert "skew=true" in plan


def test_filter_bound_has_the_columns_type_and_reaches_the_scan(spark, tmp_path):
    frame = spark.createDataFrame([("a", T(2020, 1, 1)), ("b", T(2020, 1, 2))], "sale_id string, sale_date timestamp_ntz")
    frame.write.parquet(f"{tmp_path}/sales")
    found = own_sales.sold_since(spark.read.parquet(f"{tmp_path}/sales"), D(2020, 1, 2))
    assert rows(found, "sale_id") == [("b",)]
    assert "GreaterThanOrEqual(sale_date,2020-01-02" in found._jdf.queryExecution().executedPlan().toString()


def test_a_low_threshold_does_not_shuffle_the_facts(spark, large):
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1"}):
        assert known_small(large[1])
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not known_small(large[1])


def test_rows_are_brought_together_between_shuffled_and_broadcast_lookups(spark, tables, tmp_path):
    """A large dimension does not move the agreements, which multiply rows, before the shuffle."""
    stored = {}
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    mixed = {**stored, "events": tables["events"], "customers": tables["customers"]}  # of unknown size
    own = own_sales.enrich_own_sales(tables["sales"], mixed, ["sale_date"])
    third = third_party.enrich_third_party(third_party_lines(spark), mixed, ["file_day", "sale_date"])
    for found in (own, third):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("BroadcastHashJoin") < plan.index("REBALANCE_PARTITIONS_BY_COL") < plan.index("SortMergeJoin")
    assert rows(own) == rows(own_sales.enrich_own_sales(tables["sales"], tables))
    assert rows(third) == rows(third_party.enrich_third_party(third_party_lines(spark), tables))


def stored(tables, folder, **others):
    found = {}
    for name, table in {**tables, **others}.items():
        table.write.parquet(f"{folder}/{name}")
        found[name] = table.sparkSession.read.parquet(f"{folder}/{name}")
    return found


def test_a_dimension_with_small_files_and_large_rows_is_not_broadcast(spark, tables, tmp_path):
    long = tables["customers"].withColumn("customer_name", F.repeat("customer_name", 100))
    tables = stored(tables, tmp_path, customers=long)
    plain = own_sales.enrich_own_sales(tables["sales"], tables)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and known_small(tables["customers"])
    size = unpacked_bytes({"customers": tables["customers"]})["customers"]
    assert size > 2 * 300
    with pytest.MonkeyPatch.context() as patch, scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1"}):
        patch.setattr(lookups, "BROADCAST_BYTES", size - 1)
        found = own_sales.enrich_own_sales(tables["sales"], tables)
        assert not known_small(tables["customers"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("SortMergeJoin", plan)) >= 1 and "customer_id" in plan[plan.index("SortMergeJoin") :][:60]
        assert rows(found) == rows(plain)
    # Nor by the planner, which knows the size of the files only.
    limit = lookups.planned_bytes(tables["customers"]) + 1
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": str(limit)}):
        hinted = own_sales.with_customer(tables["sales"], lookups.sized(tables["customers"], False))
        assert "SortMergeJoin" in hinted._jdf.queryExecution().executedPlan().toString()


def test_dimensions_are_broadcast_together_while_they_fit(spark, tables, tmp_path, monkeypatch):
    tables = stored({name: tables[name] for name in ("resellers", "events", "customers")}, tmp_path)
    sizes = unpacked_bytes(tables)
    # Eight for the row, and a text's length and twelve for each column.
    assert sizes["customers"] == 2 * (8 + 12 + 12) + len("c1" "Ann" "c2" "Bob")
    assert small_dimensions(tables) == set(tables)
    smallest, second, _ = sorted(sizes, key=sizes.get)
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1"}):
        for limit, found in ((sizes[smallest] - 1, set()), (sizes[smallest] + sizes[second], {smallest, second})):
            monkeypatch.setattr(lookups, "BROADCAST_BYTES", limit)
            assert small_dimensions(tables) == found
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert small_dimensions(tables) == set()


def test_resellers_of_the_files_are_broadcast_where_all_are_too_many(spark, tables, tmp_path, monkeypatch):
    more = spark.range(2000).select(F.concat(F.lit("x"), "id").alias("reseller_id"), F.lit("n").alias("reseller_name"), F.lit("l").alias("location"))
    tables = stored(tables, tmp_path, resellers=tables["resellers"].unionByName(more))
    lines = third_party_lines(spark)
    expected = rows(third_party.enrich_third_party(lines, tables))
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 5000)
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1"}):
        for in_force in (False, True):
            whole = third_party.enrich_third_party(lines, tables, in_force=in_force)
            some = third_party.enrich_third_party(lines, tables, in_force=in_force, files=lines.select("source_file"))
            plans = [frame._jdf.queryExecution().executedPlan().toString() for frame in (whole, some)]
            assert [bool(re.search("SortMergeJoin.*LeftOuter", plan)) for plan in plans] == [True, False]
            assert rows(some) == rows(whole)
            if not in_force:
                assert rows(some) == expected
