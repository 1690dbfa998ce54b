"""Reseller drops: CSV files named ``DailySales_<MMDDYYYY>_<reseller>.csv``.

A drop is a plain file, or a folder of part files named
``drop=DailySales_<MMDDYYYY>_<reseller>.csv`` as a partitioned Spark write
leaves it, so that one large drop can be written and read by many tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas as S
from ticketmart.functions import any_of, drop_day
from ticketmart.session import scoped_settings

# A line is parsed with one more cell, which tells how many cells it has.
_CELLS = [f"c{i}" for i in range(len(S.WIDE_LAYOUT) + 1)]
_END = "\u0002end of line\u0002"
_QUOTING = {"quote": '"', "escape": '"'}  # a quote inside a quoted cell is doubled
_CELL_SCHEMA = ", ".join(f"{name} STRING" for name in _CELLS)


# More days than these are looked for by one pattern for all, and filtered.
MAX_DAYS_IN_GLOB = 400


def drops_glob(folder: str, days: Sequence[dt.date | None] | None = None) -> str:
    """Pattern of all drops, or of those of some days: the others' folders are not listed."""
    stamps = "*"
    if days and None not in days and len(days) <= MAX_DAYS_IN_GLOB:
        stamps = "{" + ",".join(day.strftime("%m%d%Y") for day in days) + "}"
    return f"{folder.rstrip('/')}/{{DailySales,drop=DailySales}}_{stamps}_*.csv"


FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# A listing reads no content, so its files are dealt to tasks by number and not by bytes:
# with a limit that no size reaches, there are as many tasks as the cluster runs at once.
LISTING_SETTINGS = {"spark.sql.files.maxPartitionBytes": str(1 << 60)}


def _read_drops(reader: DataFrameReader, folder: str, days: Sequence[dt.date | None] | None) -> DataFrame | None:
    """The drops of some days or of all, or None where there is no such file."""
    if days is not None and not days:
        return None
    try:
        return reader.load(drops_glob(folder, days))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_drops(spark: SparkSession, folder: str, days: Sequence[dt.date | None] | None = None) -> DataFrame:
    """One row per drop file: ``source_file``, ``modified_at``, ``length``, ``file_day``. No content is read."""
    files = _read_drops(spark.read.format("binaryFile"), folder, days)
    if files is None:
        files = spark.createDataFrame([], FILE_SCHEMA)
    path = F.col("path")
    return files.select(
        path.alias("source_file"), F.col("modificationTime").alias("modified_at"), "length", drop_day(path).alias("file_day")
    )


def of_days(day: Column, since: dt.date | None, days: Sequence[dt.date | None] | None) -> Column:
    """Whether the day of a drop is asked for; names without a day come with ``since``."""
    wanted = F.lit(True)
    if since is not None:
        wanted = (day >= F.lit(since)) | day.isNull()
    if days is not None:
        wanted = wanted & any_of(day, days)
    return wanted


def drop_lines(
    spark: SparkSession,
    folder: str,
    *,
    since: dt.date | None = None,
    days: Sequence[dt.date | None] | None = None,
) -> DataFrame:
    """Lines of the drops: ``value`` and ``source_file``. Files of other days are not opened."""
    lines = _read_drops(spark.read.format("text"), folder, days)
    if lines is None:
        lines = spark.createDataFrame([], "value string").withColumn(
            "_metadata", F.struct(F.lit("").alias("file_path"))
        )
    path = F.col("_metadata.file_path")
    return lines.where(of_days(drop_day(path), since, days)).select("value", path.alias("source_file"))


def read_daily_sales(
    spark: SparkSession,
    folder: str,
    day: dt.date | None = None,
    *,
    since: dt.date | None = None,
    days: Sequence[dt.date | None] | None = None,
) -> DataFrame:
    """Rows of the drops under their header names, with ``source_file``.

    ``day`` takes the drops of one day, ``since`` those of that day and later and
    those whose names have no day, ``days`` those of the listed days (None stands
    for no day). All three leave out the other files before the scan. No drop gives
    no row. Widths are checked in a pass of its own; a load does so on what it stages.
    """
    if day is not None:
        days = [day] if days is None else [d for d in days if d == day]
    cells = parsed_lines(drop_lines(spark, folder, since=since, days=days))
    check_widths(cells)
    return drop_rows(cells)


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Cells of each line that is not blank, its ``width`` and whether it is a header.

    A mark behind the last cell shows where the line ends. A line that ends where none of
    the layouts does, or inside quotes, stops the job, and so does an unknown header.
    """
    marked = F.concat("value", F.lit("," + _END))
    read = lines.where("value <> ''").select("source_file", F.from_csv(marked, _CELL_SCHEMA, _QUOTING).alias("line"))
    cells = read.select("source_file", *[F.col("line")[name].alias(name) for name in _CELLS])
    width = F.coalesce(
        *[
            F.when(_null_safe(F.col(_CELLS[len(layout)]) == _END), F.lit(len(layout)))
            for layout in (S.NARROW_LAYOUT, S.WIDE_LAYOUT)
        ],
        _stop("line of unknown width").cast("int"),
    )
    names_columns = _null_safe(F.col(_CELLS[0]) == S.TRANSACTION_ID)
    known = reduce(
        lambda a, b: a | b,
        [F.array(*_CELLS[: len(layout) + 1]) == F.array(*map(F.lit, [*layout, _END])) for layout in (S.NARROW_LAYOUT, S.WIDE_LAYOUT)],
    )
    is_header = F.when(~names_columns, F.lit(False)).when(_null_safe(known), F.lit(True)).otherwise(
        _stop("unknown header line").cast("boolean")
    )
    return cells.withColumns({"is_header": is_header, "width": width})


def check_widths(cells: DataFrame) -> None:
    """Stop if a file has no header or a line of another width than its header has.

    A line can lie in another split than its file's header, so this is told from all
    lines of a file: a narrow line with a stray comma looks like a wide one.
    """
    files = cells.groupBy("source_file").agg(
        F.min("width").alias("narrowest"), F.max("width").alias("widest"), F.max("is_header").alias("headed")
    )
    odd = files.where("narrowest <> widest OR NOT headed").first()
    if odd:
        what = "a line of another width than its header" if odd["headed"] else "no header line"
        raise ValueError(f"{what} in {odd['source_file']}")


def drop_rows(cells: DataFrame, *, marked: bool = False) -> DataFrame:
    """Give the cells of each line their header names and leave the header lines out.

    ``marked`` keeps header lines, all cells NULL, and what ``check_widths`` needs.
    """
    wide, is_row = F.col("width") == len(S.WIDE_LAYOUT), ~F.col("is_header")

    def cell(header: str) -> Column:
        at_wide = F.col(_CELLS[S.WIDE_LAYOUT.index(header)])
        at_narrow = F.col(_CELLS[S.NARROW_LAYOUT.index(header)])
        if marked:
            return F.when(is_row & wide, at_wide).when(is_row, at_narrow).alias(header)
        return F.when(wide, at_wide).otherwise(at_narrow).alias(header)

    names = [cell(header) for header in S.NARROW_LAYOUT]
    if marked:
        return cells.select(*names, "source_file", "width", "is_header")
    return cells.where(is_row).select(*names, "source_file")


def _stop(what: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what} in "), F.col("source_file")))


def _null_safe(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# Files that a task may have open at once; beyond that it sorts its rows first.
_OPEN_DROPS = 200

# Input of a task that writes parts of many drops, at least, once all cores have a task.
_WRITER_BYTES = 128 << 20


def writing_tasks(spark: SparkSession, read: int) -> int:
    """Tasks that ``write_drops`` may have for so many bytes of input.

    Each of them writes a file of each drop, and the driver holds a list of all files.
    """
    return max(spark.sparkContext.defaultParallelism, -(-read // _WRITER_BYTES))


def write_drops(rows: DataFrame, folder: str, *, shuffled: bool = True, tasks: int | None = None) -> None:
    """Append drops: header-named columns plus ``drop``, the name of each drop.

    Each drop becomes a folder; a large one is split over several part files. Without the
    shuffle, for few large drops, each task writes a part of each drop, compressed; there are
    at most ``tasks`` of them.
    """
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, **_QUOTING}
    if shuffled:
        rows.hint("rebalance", "drop").write.mode("append").partitionBy("drop").options(**options).csv(folder)
        return
    rows = rows if tasks is None else rows.coalesce(tasks)
    with scoped_settings(rows.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(_OPEN_DROPS)}):
        rows.write.mode("append").partitionBy("drop").options(compression="gzip", **options).csv(folder)
