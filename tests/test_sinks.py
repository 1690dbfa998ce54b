from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, rows
from ticketmart.session import scoped_settings
from ticketmart.sinks import PREVIOUS, STAGED, compact, full_refresh, upsert_partitions
from ticketmart.sources.catalog import drop_partitions, table_exists, versions_folder
from ticketmart.sources.files import list_folders

MODE = "spark.sql.sources.partitionOverwriteMode"


def frame(spark, *data):
    # The partition column is in the middle on purpose.
    return spark.createDataFrame(list(data), "id string, sale_date date, note string")


def test_full_refresh_replaces_everything(spark, database):
    table = f"{database}.t"
    full_refresh(frame(spark, ("a", D(2020, 1, 1), "x"), ("b", D(2020, 1, 2), "y")), table)
    full_refresh(frame(spark, ("c", D(2020, 1, 3), "z")), table)
    assert rows(spark.table(table)) == [("c", D(2020, 1, 3), "z")]
    assert spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Provider'").first()["data_type"] == "parquet"


def test_full_refresh_with_partitions(spark, database):
    table = f"{database}.t"
    full_refresh(frame(spark, ("a", D(2020, 1, 1), "x")), table, ["sale_date"])
    full_refresh(frame(spark, ("c", D(2020, 1, 3), "z")), table, ["sale_date"])
    assert rows(spark.sql(f"SHOW PARTITIONS {table}")) == [("sale_date=2020-01-03",)]


def test_upsert_creates_then_replaces_only_present_partitions(spark, database):
    table = f"{database}.t"
    assert not table_exists(spark, table)
    upsert_partitions(frame(spark, ("a", D(2020, 1, 1), "x"), ("b", D(2020, 1, 2), "y")), table, ["sale_date"])
    assert spark.table(table).columns == ["id", "note", "sale_date"]
    upsert_partitions(frame(spark, ("c", D(2020, 1, 2), "z"), ("d", None, "n")), table, ["sale_date"])
    assert rows(spark.table(table)) == [("a", "x", D(2020, 1, 1)), ("c", "z", D(2020, 1, 2)), ("d", "n", None)]


def test_upsert_of_nothing_changes_nothing(spark, database):
    table = f"{database}.t"
    upsert_partitions(frame(spark, ("a", D(2020, 1, 1), "x")), table, ["sale_date"])
    upsert_partitions(frame(spark), table, ["sale_date"])
    assert rows(spark.table(table), "id") == [("a",)]


def test_the_session_setting_is_put_back(spark, database):
    table, data = f"{database}.t", frame(spark, ("a", D(2020, 1, 1), "x"))
    before = spark.conf.get(MODE)
    upsert_partitions(data, table, ["sale_date"])
    upsert_partitions(data, table, ["sale_date"])
    assert spark.conf.get(MODE) == before
    with pytest.raises(ZeroDivisionError), scoped_settings(spark, {MODE: "dynamic"}):
        1 / 0
    assert spark.conf.get(MODE) == before


def test_a_hot_day_is_written_by_several_tasks(spark, database):
    table = f"{database}.t"
    data = spark.range(0, 200_000, 1, 4).selectExpr(
        "sha2(cast(id as string), 256) as id",
        "if(id % 3 < 2, date'2020-01-01', date_add(date'2020-01-02', cast(id % 5 as int))) as sale_date",
        "'x' as note",
    )
    with scoped_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}):
        upsert_partitions(data, table, ["sale_date"])
    files = {
        row["sale_date"]: row["n"]
        for row in spark.table(table).selectExpr("sale_date", "_metadata.file_path as f")
        .groupBy("sale_date").agg({"f": "approx_count_distinct"}).withColumnRenamed("approx_count_distinct(f)", "n").collect()
    }
    assert spark.table(table).count() == 200_000
    assert files[D(2020, 1, 1)] > 2


def broken(spark):
    """Rows that fail when the last of them are read."""
    data = spark.range(0, 1000, 1, 4).selectExpr("cast(id as string) as id", "date'2020-01-09' as sale_date", "'new' as note")
    return data.withColumn("note", F.when(F.col("id") == "999", F.raise_error(F.lit("source broke off"))).otherwise(F.col("note")))


@pytest.mark.parametrize("partitions", [[], ["sale_date"]])
def test_a_refresh_that_fails_leaves_the_old_rows(spark, database, partitions):
    table = f"{database}.t"
    full_refresh(frame(spark, ("a", D(2020, 1, 1), "x"), ("b", D(2020, 1, 2), "y")), table, partitions)
    before = rows(spark.table(table), "id", "sale_date", "note")
    with pytest.raises(Exception, match="source broke off"):
        full_refresh(broken(spark), table, partitions)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table), "id", "sale_date", "note") == before
    full_refresh(frame(spark, ("c", D(2020, 1, 3), "z")), table, partitions)
    assert rows(spark.table(table), "id") == [("c",)]
    assert len(list_folders(spark, versions_folder(spark, table))) == 1  # what the failed one wrote is gone


@pytest.mark.parametrize("partitions", [[], ["sale_date"]])
def test_a_table_can_be_made_from_itself(spark, database, partitions):
    table = f"{database}.t"
    full_refresh(frame(spark, ("a", D(2020, 1, 1), "x"), ("b", D(2020, 1, 2), "y")), table, partitions)
    full_refresh(spark.table(table).where("id = 'b'").select("id", "sale_date", "note"), table, partitions)
    assert rows(spark.table(table), "id") == [("b",)]


def test_a_run_that_breaks_off_between_the_renames_is_undone(spark, database):
    table = f"{database}.t"
    full_refresh(frame(spark, ("a", D(2020, 1, 1), "x")), table, ["sale_date"])
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{PREVIOUS}")
    frame(spark, ("z", D(2020, 1, 1), "x")).write.saveAsTable(table + STAGED)
    assert not table_exists(spark, table)
    upsert_partitions(frame(spark, ("b", D(2020, 1, 2), "y")), table, ["sale_date"])
    assert rows(spark.table(table), "id") == [("a",), ("b",)]
    assert not table_exists(spark, table + PREVIOUS) and not table_exists(spark, table + STAGED)


def test_a_refresh_may_change_columns_and_layout(spark, database):
    table = f"{database}.t"
    full_refresh(frame(spark, ("a", D(2020, 1, 1), "x")), table)
    full_refresh(frame(spark, ("b", D(2020, 1, 1), "x")).withColumn("more", F.lit(1)), table)
    assert rows(spark.table(table)) == [("b", D(2020, 1, 1), "x", 1)]
    full_refresh(frame(spark, ("c", D(2020, 1, 2), "x")), table, ["sale_date"])
    assert rows(spark.sql(f"SHOW PARTITIONS {table}")) == [("sale_date=2020-01-02",)]
    full_refresh(frame(spark, ("d", D(2020, 1, 3), "x")), table)
    assert rows(spark.table(table)) == [("d", D(2020, 1, 3), "x")]


def test_a_table_that_an_earlier_version_made_is_refreshed(spark, database):
    for partitions in ([], ["sale_date"]):
        table = f"{database}.old{len(partitions)}"
        writer = frame(spark, ("a", D(2020, 1, 1), "x")).write
        (writer.partitionBy(*partitions) if partitions else writer).format("parquet").saveAsTable(table)
        full_refresh(frame(spark, ("b", D(2020, 1, 2), "y")), table, partitions)
        full_refresh(frame(spark, ("c", D(2020, 1, 2), "y")), table, partitions)
        assert rows(spark.table(table), "id") == [("c",)]


def test_a_new_column_is_stored_and_null_before(spark, database):
    table = f"{database}.t"
    upsert_partitions(frame(spark, ("a", D(2020, 1, 1), "x"), ("b", D(2020, 1, 2), "y")), table, ["sale_date"])
    more = frame(spark, ("c", D(2020, 1, 2), "z")).select(F.lit(7).alias("more"), "*")
    upsert_partitions(more, table, ["sale_date"])
    assert spark.table(table).columns == ["id", "note", "more", "sale_date"]
    assert rows(spark.table(table)) == [("a", "x", None, D(2020, 1, 1)), ("c", "z", 7, D(2020, 1, 2))]


def test_lost_and_retyped_columns_are_refused_by_name(spark, database):
    table = f"{database}.t"
    data = frame(spark, ("a", D(2020, 1, 1), "x"))
    upsert_partitions(data, table, ["sale_date"])
    with pytest.raises(ValueError, match=r"lack its columns \['note'\]"):
        upsert_partitions(data.drop("note"), table, ["sale_date"])
    with pytest.raises(ValueError, match="note string -> int"):
        upsert_partitions(data.withColumn("note", F.lit(1)), table, ["sale_date"])
    with pytest.raises(ValueError, match="partitioned by"):
        upsert_partitions(data, table, ["id"])
    assert rows(spark.table(table)) == [("a", "x", D(2020, 1, 1))]


def test_dropped_partitions_leave_no_files(spark, database):
    table = f"{database}.t"
    upsert_partitions(frame(spark, ("a", D(2020, 1, 1), "x"), ("b", None, "y"), ("c", D(2020, 1, 3), "z")), table, ["sale_date"])
    drop_partitions(spark, table, [{"sale_date": D(2020, 1, 1)}, {"sale_date": None}, {"sale_date": D(1999, 1, 1)}])
    assert rows(spark.table(table), "id") == [("c",)]
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    assert rows(spark.table(table), "id") == [("c",)]


def files_of(spark, table):
    found = spark.table(table).select("sale_date", "_metadata.file_name").distinct().collect()
    days = {}
    for row in found:
        days.setdefault(row["sale_date"], set()).add(row["file_name"])
    return days


def appended(spark, table, *data):
    frame(spark, *data).select(*spark.table(table).columns).write.mode("append").insertInto(table)


def test_compaction_rewrites_crowded_partitions_only(spark, database):
    table = f"{database}.t"
    days = [D(2020, 1, 1), D(2020, 1, 2), None]
    upsert_partitions(frame(spark, *[(f"first{day}", day, "x") for day in days]), table, ["sale_date"])
    for i in range(10):
        appended(spark, table, (f"late{i}", days[0], "y"), *([(f"undated{i}", None, "z")] if i < 2 else []))
    before, data = files_of(spark, table), rows(spark.table(table))
    assert [len(before[day]) for day in days] == [11, 1, 3]
    assert compact(spark, table) == 2
    after = files_of(spark, table)
    assert [len(after[day]) for day in days] == [1, 1, 1]
    assert after[days[1]] == before[days[1]] and rows(spark.table(table)) == data
    assert compact(spark, table) == 0 and files_of(spark, table) == after


def test_compaction_keeps_as_many_files_as_the_size_needs(spark, database):
    table = f"{database}.t"
    data = spark.range(0, 40_000, 1, 40).selectExpr("sha2(cast(id as string), 256) as id", "date'2020-01-01' as sale_date", "'x' as note")
    data.write.format("parquet").partitionBy("sale_date").saveAsTable(table)
    size = spark.table(table).select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
    assert compact(spark, table, size // 5) == 1
    assert 3 <= len(files_of(spark, table)[D(2020, 1, 1)]) <= 6
    assert spark.table(table).distinct().count() == 40_000
    assert compact(spark, table, 1) == 0  # every file is large enough


def test_compaction_of_an_empty_table(spark, database):
    table = f"{database}.t"
    full_refresh(frame(spark), table, ["sale_date"])
    assert compact(spark, table) == 0


def test_compaction_takes_partition_values_as_text(spark, database):
    table = f"{database}.t"
    data = spark.createDataFrame([("a", "007"), ("b", "7"), ("c", None)], "id string, code string")
    upsert_partitions(data, table, ["code"])
    for _ in range(2):
        data.write.mode("append").insertInto(table)
    assert compact(spark, table) == 3
    assert rows(spark.table(table)) == sorted([("a", "007"), ("b", "7"), ("c", None)] * 3, key=repr)


def test_tables_and_later_partitions_are_stored_compact(spark, database, tmp_path):
    table = f"{database}.packed"
    upsert_partitions(spark.createDataFrame([("a", 1)], "name string, day int"), table, ["day"])
    upsert_partitions(spark.createDataFrame([("b", 2)], "name string, day int"), table, ["day"])
    stored = spark.table(table).select("_metadata.file_name", "day").collect()
    assert {row["day"] for row in stored} == {1, 2} and all(".zstd." in row["file_name"] for row in stored)
