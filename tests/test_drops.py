from __future__ import annotations

import csv
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, drop_line, put_drop, rows
from ticketmart import schemas as S
from ticketmart.operators.third_party import normalise
from ticketmart.session import scoped_settings
from ticketmart.sources.drops import (
    LISTING_SETTINGS,
    MAX_DAYS_IN_GLOB,
    check_widths,
    drop_lines,
    drop_rows,
    drops_glob,
    list_drops,
    parsed_lines,
    read_daily_sales,
    write_drops,
)


def files_opened(frame) -> int:
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numFiles").get().value()


@pytest.fixture
def folder(tmp_path):
    put_drop(tmp_path, "05032020", "r1", [drop_line("1", "2020-05-03"), drop_line("2", "2020-05-03")])
    put_drop(tmp_path, "05032020", "r2", [drop_line("1", "2020-05-03")], layout=S.WIDE_LAYOUT)
    put_drop(tmp_path, "05042020", "r1", [drop_line("1", "2020-05-04")])
    put_drop(tmp_path, "", "", [drop_line("9", "2020-05-05")], name="DailySales_late_r1.csv")
    put_drop(tmp_path, "", "", [drop_line("8", "2020-05-05")], name="Summary_05032020_r1.csv")
    return tmp_path


def test_all_drops_by_name(spark, folder):
    found = read_daily_sales(spark, str(folder))
    assert found.columns == [*S.NARROW_LAYOUT, "source_file"]
    assert rows(found, S.TRANSACTION_ID) == [("1",), ("1",), ("1",), ("2",), ("9",)]


def test_one_day_opens_its_files_only(spark, folder):
    found = read_daily_sales(spark, str(folder), D(2020, 5, 3))
    assert rows(found, S.TRANSACTION_ID, S.CREATED) == [("1", "2020-05-03"), ("1", "2020-05-03"), ("2", "2020-05-03")]
    assert files_opened(found) == 2


def test_since_and_days_leave_files_out_before_the_scan(spark, folder):
    since = read_daily_sales(spark, str(folder), since=D(2020, 5, 4))
    assert rows(since, S.CREATED) == [("2020-05-04",), ("2020-05-05",)]
    assert files_opened(since) == 2
    listed = read_daily_sales(spark, str(folder), days=[D(2020, 5, 4), None])
    assert rows(listed, S.TRANSACTION_ID) == [("1",), ("9",)]
    assert files_opened(listed) == 2
    assert read_daily_sales(spark, str(folder), days=[]).isEmpty()


def test_no_drop_gives_no_row(spark, folder):
    found = read_daily_sales(spark, str(folder), D(1999, 1, 1))
    assert found.isEmpty()
    assert found.columns == [*S.NARROW_LAYOUT, "source_file"]
    assert read_daily_sales(spark, str(folder), D(1999, 1, 1), since=D(1999, 1, 1)).isEmpty()


def test_both_layouts_in_one_scan_keep_their_columns(spark, folder):
    found = normalise(read_daily_sales(spark, str(folder), D(2020, 5, 3)))
    expected = ("Gala", 2, Decimal("30.50"), "web", "Kim Berg", D(2020, 5, 3))
    columns = ("event_name", "ticket_quantity", "total_amount", "channel_name", "customer_name", "sale_date")
    assert rows(found, *columns) == [expected] * 3
    assert rows(found, "reseller_id", "file_day") == [("r1", D(2020, 5, 3))] * 2 + [("r2", D(2020, 5, 3))]


def test_quoted_commas_and_missing_values(spark, tmp_path):
    line = drop_line("1", "2020-05-03", event='"Rock, Paper"')
    line[S.LAST_NAME] = ""
    for layout, reseller in ((S.NARROW_LAYOUT, "a"), (S.WIDE_LAYOUT, "b")):
        put_drop(tmp_path, "05032020", reseller, [line], layout=layout)
    found = normalise(read_daily_sales(spark, str(tmp_path)))
    assert rows(found, "event_name", "customer_name", "ticket_quantity") == [("Rock, Paper", None, 2)] * 2


NASTY = ['Say "hi", now', '"', '""', "back\\slash", '\\"', " padded ", "a;b|c\td", "Ünïcode ✓", ",,,", "'", "#note", "NULL", "0"]


def test_any_text_in_a_cell_comes_through(spark, tmp_path):
    """As a CSV library writes it, and as Spark writes it."""
    for layout, reseller in ((S.NARROW_LAYOUT, "a"), (S.WIDE_LAYOUT, "b")):
        with open(tmp_path / f"DailySales_05032020_{reseller}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.DictWriter(file, layout, extrasaction="ignore")
            writer.writeheader()
            writer.writerows(drop_line(str(i), "2020-05-03", text) for i, text in enumerate(NASTY))
    found = read_daily_sales(spark, str(tmp_path))
    expected = sorted(((str(i), text) for i, text in enumerate(NASTY)), key=repr)
    for reseller in ("a", "b"):
        part = found.where(F.col("source_file").endswith(f"_{reseller}.csv"))
        assert rows(part, S.TRANSACTION_ID, S.EVENT_NAME) == expected
    again = tmp_path / "again"
    write_drops(found.drop("source_file").withColumn("drop", F.lit("DailySales_05032020_c.csv")), str(again))
    copied = read_daily_sales(spark, str(again))
    assert rows(copied, S.TRANSACTION_ID, S.EVENT_NAME) == sorted(expected * 2, key=repr)


def test_missing_last_cell_does_not_change_the_layout(spark, tmp_path):
    line = drop_line("1", "")
    put_drop(tmp_path, "05032020", "a", [line])
    put_drop(tmp_path, "05032020", "b", [line], layout=S.WIDE_LAYOUT)
    found = normalise(read_daily_sales(spark, str(tmp_path)))
    assert rows(found, "event_name", "ticket_quantity", "sale_date") == [("Gala", 2, None)] * 2


def test_unknown_header_stops_the_job(spark, tmp_path):
    put_drop(tmp_path, "05032020", "a", [drop_line("1", "2020-05-03")], layout=S.NARROW_LAYOUT[:-2])
    with pytest.raises(Exception, match="unknown header line in .*DailySales_05032020_a.csv"):
        read_daily_sales(spark, str(tmp_path)).collect()


def written(tmp_path, *lines):
    (tmp_path / "DailySales_05032020_a.csv").write_text("\n".join(lines) + "\n")


NARROW, WIDE = ",".join(S.NARROW_LAYOUT), ",".join(S.WIDE_LAYOUT)


@pytest.mark.parametrize(
    "lines",
    [
        (WIDE + ",More", "1,,Gala,2,3.5,web,Kim,Berg,,2020-05-03,x"),  # an eleventh column
        (NARROW, "1,Gala"),
        (NARROW, "1,Gala,2,3.5,web,Kim,Berg,,2020-05-03,x,y"),
        (NARROW, "1,Gala,2,3.5,web,Kim,Berg,,2020-05-03", "2,Gala, Night,2,3.5,web,Kim,Berg,,2020-05-03"),
        (WIDE, "1,,Gala,2,3.5,web,Kim,Berg,,2020-05-03", "2,Gala,2,3.5,web,Kim,Berg,,2020-05-03"),
        (NARROW, '1,"Gala,2,3.5,web,Kim,Berg,,2020-05-03'),  # a quote that stays open
        ("1,Gala,2,3.5,web,Kim,Berg,,2020-05-03",),  # no header
    ],
)
def test_lines_that_do_not_fit_their_header_stop_the_job(spark, tmp_path, lines):
    written(tmp_path, *lines)
    with pytest.raises(Exception, match="DailySales_05032020_a.csv"):
        read_daily_sales(spark, str(tmp_path)).collect()


def test_blank_lines_and_empty_files_have_no_rows(spark, tmp_path):
    written(tmp_path, NARROW, "", "1,Gala,2,3.5,web,Kim,Berg,,2020-05-03", "")
    (tmp_path / "DailySales_05032020_b.csv").write_text("")
    assert rows(read_daily_sales(spark, str(tmp_path)), S.TRANSACTION_ID) == [("1",)]


def test_unreadable_number_stops_the_job(spark, tmp_path):
    line = drop_line("1", "2020-05-03")
    line[S.TICKETS] = "two"
    put_drop(tmp_path, "05032020", "a", [line])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalise(read_daily_sales(spark, str(tmp_path))).collect()


def test_a_renamed_header_is_not_passed_over(spark):
    columns = ", ".join(f"`{name}` string" for name in [*S.NARROW_LAYOUT[:-1], "Created On", "source_file"])
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        normalise(spark.createDataFrame([], columns))


def test_folder_drops_written_by_spark_read_back(spark, tmp_path):
    lines = spark.createDataFrame(
        [tuple(drop_line(str(i), "2020-05-03")[h] or None for h in S.NARROW_LAYOUT) for i in range(50)],
        ", ".join(f"`{h}` string" for h in S.NARROW_LAYOUT),
    ).withColumn("drop", F.lit("DailySales_05032020_r1.csv"))
    write_drops(lines, str(tmp_path))
    put_drop(tmp_path, "05032020", "r2", [drop_line("77", "2020-05-03")])
    found = normalise(read_daily_sales(spark, str(tmp_path), D(2020, 5, 3)))
    assert {row[0]: row[1] for row in found.groupBy("reseller_id").count().collect()} == {"r1": 50, "r2": 1}


def test_listing_by_day_opens_no_other_folder(spark, folder):
    assert drops_glob("f/", [D(2020, 5, 3), D(2020, 5, 4)]) == "f/{DailySales,drop=DailySales}_{05032020,05042020}_*.csv"
    assert drops_glob("f", [D(2020, 5, 3), None]) == drops_glob("f") == "f/{DailySales,drop=DailySales}_*_*.csv"
    write_drops(read_daily_sales(spark, str(folder), D(2020, 5, 4)).drop("source_file").withColumn("drop", F.lit("DailySales_05062020_r3.csv")), str(folder))
    assert sorted(rows(list_drops(spark, str(folder), [D(2020, 5, 3)]), "file_day")) == [(D(2020, 5, 3),)] * 2
    assert rows(list_drops(spark, str(folder), [D(2020, 5, 6), D(1999, 1, 1)]), "file_day") == [(D(2020, 5, 6),)]
    assert list_drops(spark, str(folder), [D(1999, 1, 1)]).isEmpty() and list_drops(spark, str(folder), []).isEmpty()
    assert rows(list_drops(spark, str(folder)), "file_day") == sorted(
        [(D(2020, 5, 3),), (D(2020, 5, 3),), (D(2020, 5, 4),), (D(2020, 5, 6),), (None,)], key=repr
    )
    many = [D(2020, 5, 3) + (D(2020, 5, 4) - D(2020, 5, 3)) * i for i in range(MAX_DAYS_IN_GLOB + 1)]
    assert rows(read_daily_sales(spark, str(folder), days=many), S.TRANSACTION_ID) == [("1",)] * 4 + [("2",)]


def test_the_tasks_of_a_listing_do_not_grow_with_the_bytes(spark, tmp_path):
    def tasks(folder) -> int:
        with scoped_settings(spark, {"spark.sql.files.maxPartitionBytes": "20KB", "spark.sql.files.openCostInBytes": "0"}):
            with scoped_settings(spark, LISTING_SETTINGS):
                return list_drops(spark, str(folder)).rdd.getNumPartitions()

    for size, name in ((1, "small"), (400, "large")):
        for i in range(30):
            put_drop(tmp_path / name, "05032020", f"r{i}", [drop_line(str(n), "2020-05-03") for n in range(size)])
    assert tasks(tmp_path / "large") <= 2 * spark.sparkContext.defaultParallelism
    assert tasks(tmp_path / "small") <= 2 * spark.sparkContext.defaultParallelism


def test_marked_rows_keep_header_lines_without_cells(spark, folder):
    cells = parsed_lines(drop_lines(spark, str(folder)))
    marked = drop_rows(cells, marked=True)
    check_widths(marked)
    assert marked.where("is_header").count() == 4
    assert marked.where("is_header").select(F.coalesce(*[F.col(f"`{name}`") for name in S.NARROW_LAYOUT]).alias("cell")).where("cell IS NOT NULL").isEmpty()
    plain = read_daily_sales(spark, str(folder))
    assert rows(marked.where("NOT is_header"), *plain.columns) == rows(plain)


def test_drops_written_without_a_shuffle_give_the_same_rows(spark, tmp_path):
    lines = spark.range(0, 300, 1, 3).select(
        *[F.concat(F.lit(f'{name}, "'), F.col("id").cast("string")).alias(name) for name in S.WIDE_LAYOUT],
        F.concat(F.lit("DailySales_05032020_r"), (F.col("id") % 5).cast("string"), F.lit(".csv")).alias("drop"),
    )
    for shuffled in (True, False):
        write_drops(lines, f"{tmp_path}/{shuffled}", shuffled=shuffled)
    read = [rows(read_daily_sales(spark, f"{tmp_path}/{shuffled}"), *S.NARROW_LAYOUT) for shuffled in (True, False)]
    assert read[0] == read[1] and len(read[0]) == 300
    assert {path.suffix for path in (tmp_path / "False").glob("drop=*/part-*")} == {".gz"}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_few_tasks_write_drops_however_many_partitions_there_are(spark, tmp_path):
    from ticketmart.sources import drops

    lines = spark.range(0, 60, 1, 12).select(*[F.lit("1").alias(name) for name in S.NARROW_LAYOUT], F.lit("DailySales_05032020_r1.csv").alias("drop"))
    write_drops(lines, str(tmp_path), shuffled=False, tasks=3)
    assert len(list((tmp_path / "drop=DailySales_05032020_r1.csv").glob("part-*"))) == 3
    assert read_daily_sales(spark, str(tmp_path)).count() == 60
    cores = spark.sparkContext.defaultParallelism
    assert drops.writing_tasks(spark, 1) == cores and drops.writing_tasks(spark, 100 * drops._WRITER_BYTES + 1) == max(cores, 101)
