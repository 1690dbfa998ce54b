"""Table writes. Only this module and the jobs run Spark actions.

A table is never emptied before what replaces it is stored: the new rows go to a folder
of their own, and then the catalog is told of it. A write that fails leaves the old rows,
and the folder it had begun is taken away by the next one that succeeds.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketmart.operators.layout import clustered
from ticketmart.session import scoped_settings
from ticketmart.sources.catalog import list_partitions, table_exists, table_location, versions_folder
from ticketmart.sources.drops import LISTING_SETTINGS
from ticketmart.sources.files import delete_folder, list_folders

STAGED, PREVIOUS = "__staged", "__previous"

# Of the tables' files; a table keeps it, so partitions that are added later have it too.
COMPRESSION = "zstd"


def full_refresh(
    rows: DataFrame, table: str, partition_by: Sequence[str] = (), *, is_clustered: bool = False
) -> None:
    """Replace a Parquet table as a whole; when it fails, the table is as it was.

    Rows are written to a new version's folder first. A table without partitions and of
    the same columns then takes that folder as its location, in one step. Any other is
    staged as a table of its own, its partitions registered, and takes the old one's name;
    ``recovered`` puts the old one back if a run breaks off between the two renames.

    ``is_clustered`` says that the rows of a partition already lie together.
    """
    spark = rows.sparkSession
    recovered(spark, table)
    laid_out = rows if is_clustered else clustered(rows, partition_by)
    folder = _new_version(spark, table)
    if table_exists(spark, table) and not partition_by and _same_columns(spark, table, rows):
        laid_out.write.parquet(folder, compression=COMPRESSION)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    elif table_exists(spark, table):
        _create(laid_out, table + STAGED, folder, partition_by)
        _swap(spark, table)
    else:
        _create(laid_out, table, folder, partition_by)
    _delete_other_versions(spark, table)


def _create(rows: DataFrame, table: str, folder: str, partition_by: Sequence[str]) -> None:
    writer = rows.write.mode("overwrite").format("parquet").options(path=folder, compression=COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def _swap(spark: SparkSession, table: str) -> None:
    """Both tables name their folders, so the renames change the catalog only."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{PREVIOUS}")
    spark.sql(f"ALTER TABLE {table}{STAGED} RENAME TO {table}")
    spark.sql(f"DROP TABLE {table}{PREVIOUS}")


def recovered(spark: SparkSession, table: str) -> None:
    """Undo a refresh that broke off: a staged table goes, a renamed one gets its name back."""
    spark.sql(f"DROP TABLE IF EXISTS {table}{STAGED}")
    if not table_exists(spark, table + PREVIOUS):
        return
    if table_exists(spark, table):
        spark.sql(f"DROP TABLE {table}{PREVIOUS}")
    else:
        spark.sql(f"ALTER TABLE {table}{PREVIOUS} RENAME TO {table}")


def _new_version(spark: SparkSession, table: str) -> str:
    stamp = f"{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"
    return f"{versions_folder(spark, table)}/{stamp}-{uuid.uuid4().hex[:8]}"


def _delete_other_versions(spark: SparkSession, table: str) -> None:
    current = table_location(spark, table).rstrip("/")
    for folder in list_folders(spark, versions_folder(spark, table)):
        if folder.rsplit("/", 1)[-1] != current.rsplit("/", 1)[-1]:
            delete_folder(spark, folder)


def _same_columns(spark: SparkSession, table: str, rows: DataFrame) -> bool:
    def columns(schema: StructType) -> list[tuple[str, str]]:
        return [(field.name, field.dataType.simpleString()) for field in schema]

    partitioned = any(column.isPartition for column in spark.catalog.listColumns(table))
    return not partitioned and columns(spark.table(table).schema) == columns(rows.schema)


def upsert_partitions(
    rows: DataFrame, table: str, partition_by: Sequence[str], *, is_clustered: bool = False
) -> None:
    """Create the table, or replace just the partitions that ``rows`` has.

    Columns that the table lacks are added to it first; what it stores already reads them
    as NULL. ``insertInto`` matches by position, so columns are put into the table's order.
    It obeys the session setting only, which is set for this write alone.
    """
    spark = rows.sparkSession
    recovered(spark, table)
    if not table_exists(spark, table):
        full_refresh(rows, table, partition_by, is_clustered=is_clustered)
        return
    add_columns(rows, table, partition_by)
    laid_out = rows if is_clustered else clustered(rows, partition_by)
    ordered = laid_out.select(*spark.table(table).columns)
    with scoped_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        ordered.write.mode("overwrite").insertInto(table)


def add_columns(rows: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Add the columns of ``rows`` that the table lacks.

    A column that the table has and the rows lack, one of another type, or other
    partition columns than the table's are refused by name: storing such rows would lose
    or misread data.
    """
    spark = rows.sparkSession
    stored = {field.name.lower(): field for field in spark.table(table).schema}
    new = {field.name.lower(): field for field in rows.schema}
    partitions = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    if [name.lower() for name in partitions] != [name.lower() for name in partition_by]:
        raise ValueError(f"{table} is partitioned by {partitions}, not by {list(partition_by)}")
    missing = [stored[name].name for name in stored if name not in new]
    if missing:
        raise ValueError(f"rows for {table} lack its columns {missing}")
    retyped = [
        f"{field.name} {stored[name].dataType.simpleString()} -> {field.dataType.simpleString()}"
        for name, field in new.items()
        if name in stored and field.dataType.simpleString() != stored[name].dataType.simpleString()
    ]
    if retyped:
        raise ValueError(f"rows for {table} have columns of other types: {retyped}")
    added = [f"`{field.name}` {field.dataType.simpleString()}" for name, field in new.items() if name not in stored]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")



# A file of a partition that is to be read by one task.
FILE_BYTES = 128 << 20
# Partitions that one job rewrites.
_REWRITTEN_AT_ONCE = 100


def crowded_partitions(spark: SparkSession, table: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Files of the partitions that have more files than their size needs, with a bin for each.

    Told from names and sizes alone. The files of a partition are laid into bins of
    ``file_bytes`` in the order of their size; a partition is crowded if it has fewer bins
    than files. A file that is as large as a bin is left alone.
    """
    columns = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    types = {field.name: field.dataType for field in spark.table(table).schema}
    # Values are taken as text and cast to the table's types: 007 is not to become 7.
    with scoped_settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table_location(spark, table))
    small = listed.where(F.col("length") < file_bytes)
    named = small.select(
        *[F.col(name).cast(types[name]).alias(name) for name in columns],
        F.regexp_extract("path", "[^/]+$", 0).alias("file"),
        F.col("length").alias("bytes"),
    )
    in_partition = Window.partitionBy(*columns)
    by_size = in_partition.orderBy(F.col("bytes").desc(), "file")
    # A file belongs to the bin in which its middle lies, so none is split and none overflows by more than a half.
    middle = F.sum("bytes").over(by_size) - F.col("bytes") / 2
    binned = named.withColumn("bin", F.floor(middle / file_bytes))
    counted = binned.withColumns(
        {"files": F.count("*").over(in_partition), "bins": F.size(F.collect_set("bin").over(in_partition))}
    )
    return counted.where("files > bins").drop("files", "bins")


def compact(spark: SparkSession, table: str, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite crowded partitions with one file per bin; other partitions are not touched.

    Rows keep their partition, so their order in it and the number of files is all that
    changes. Gives the number of partitions rewritten.
    """
    recovered(spark, table)
    if list_partitions(spark, table).isEmpty():
        return 0
    columns = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    with scoped_settings(spark, LISTING_SETTINGS):
        # As many rows as there are partitions to rewrite.
        found = crowded_partitions(spark, table, file_bytes).select(*columns).distinct().collect()
    for at in range(0, len(found), _REWRITTEN_AT_ONCE):
        some = found[at : at + _REWRITTEN_AT_ONCE]
        wanted = _in_partitions(columns, some)
        bins = crowded_partitions(spark, table, file_bytes).where(wanted).alias("bins")
        with scoped_settings(spark, LISTING_SETTINGS):
            count = bins.select(*columns, "bin").distinct().count()
        rows = spark.table(table).where(wanted).withColumn("_file", F.col("_metadata.file_name")).alias("rows")
        # Tasks that write several partitions use one file name in all of them.
        same = F.col("rows._file") == F.col("bins.file")
        for name in columns:
            same = same & F.col(f"rows.`{name}`").eqNullSafe(F.col(f"bins.`{name}`"))
        # Files that are large enough have no bin and a task each.
        place = F.coalesce(F.col("bins.bin").cast("string"), F.col("rows._file"))
        laid_out = rows.join(bins, same, "left").select("rows.*", place.alias("_place"))
        laid_out = laid_out.repartition(max(count, 1), *columns, "_place")
        with scoped_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            laid_out.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    return len(found)


def _in_partitions(columns: Sequence[str], partitions: Sequence[Sequence[object]]) -> Column:
    wanted = F.lit(False)
    for values in partitions:
        same = F.lit(True)
        for name, value in zip(columns, values, strict=True):
            same = same & (F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
        wanted = wanted | same
    return wanted
