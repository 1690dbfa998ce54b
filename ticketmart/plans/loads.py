"""The loads. An initial load and a daily one differ in their lower bound only.

An error in any step goes through to the caller; later steps then do not run.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart import schemas as S
from ticketmart.functions import any_of
from ticketmart.operators.fingerprint import day_fingerprints, differing, sold_on
from ticketmart.operators.identity import contested_apart, last_deliveries
from ticketmart.operators.layout import clustered
from ticketmart.operators.own_sales import enrich_own_sales, sold_since
from ticketmart.operators.third_party import enrich_third_party, normalise
from ticketmart.operators.union import unite_sales
from ticketmart.operators.watermark import latest_sales_day
from ticketmart.plans.mart import Mart
from ticketmart.session import ENGINE_SETTINGS, scoped_settings
from ticketmart.sinks import COMPRESSION, compact, full_refresh, upsert_partitions
from ticketmart.sources.catalog import drop_partitions, folder_beside, list_partitions, partition_day, table_exists
from ticketmart.sources.drops import (
    LISTING_SETTINGS,
    check_widths,
    drop_lines,
    drop_rows,
    list_drops,
    of_days,
    parsed_lines,
    read_daily_sales,
)
from ticketmart.sources.files import delete_folder


def refresh_dimension(mart: Mart, name: str) -> None:
    full_refresh(mart.source(name), mart.name(name))


def refresh_dimensions(mart: Mart, names: Sequence[str] = S.DIMENSIONS) -> None:
    """The dimensions do not depend on each other, so their Spark jobs run side by side."""
    refresh = inheritable_thread_target(mart.spark)(lambda name: refresh_dimension(mart, name))
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        list(pool.map(refresh, names))


def third_party_rows(
    mart: Mart,
    day: dt.date | None = None,
    *,
    since: dt.date | None = None,
    days: Sequence[dt.date | None] | None = None,
) -> DataFrame:
    """Enriched rows of the drops, laid out for ``sales_csv``."""
    drops = read_daily_sales(mart.spark, mart.drops, day, since=since, days=days)
    return enriched_drops(mart, normalise(drops))


def enriched_drops(mart: Mart, rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    return enrich_third_party(
        rows,
        mart.dimensions(),
        S.THIRD_PARTY_PARTITIONS,
        in_force=mart.agreements_in_force,
        heavy_share=mart.heavy_share,
        files=files,
    )


CHANGES = "sales_csv_changes"
FILES = "sales_csv_files"
STAGED_DROPS = "sales_csv_staged"


def load_third_party(
    mart: Mart,
    day: dt.date | None = None,
    *,
    since: dt.date | None = None,
    days: Sequence[dt.date | None] | None = None,
) -> None:
    """Load drops into ``sales_csv``: all of them, or those of the given days.

    The table is partitioned by the day of the drop and the day of the sale. The
    drops of a day are read together, so a load replaces all that earlier ones stored
    for that day, down to nothing if its drops are gone, and leaves other days alone.

    The text is read once, into a staged copy; what a load has to know of all lines
    before it may publish any is told from that copy.

    What the load changes is noted first, in a partition of its own of ``CHANGES``, where
    the sales load finds it, also after a run that broke off. Files are noted last.
    """
    if day is not None:
        days = [day] if days is None else [d for d in days if d == day]
    spark, table, noted = mart.spark, mart.name("sales_csv"), mart.name(CHANGES)
    started = dt.datetime.now(dt.timezone.utc)
    load = f"{started:%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    with scoped_settings(spark, ENGINE_SETTINGS), staged_drops(mart, load, since, days) as drops:
        _note(drops.select("file_day", "sale_date").distinct(), noted, load)
        gone = _stale(mart, load, since, days)
        _note(gone, noted, load)
        rows = enriched_drops(mart, drops, drops.select("source_file").distinct())
        upsert_partitions(rows, table, S.THIRD_PARTY_PARTITIONS, is_clustered=True)
        # Partitions of loaded days, at most as many as days were taken away from them.
        drop_partitions(spark, table, [row.asDict() for row in gone.collect()])
        _note_files(mart, started, since, days)


@contextmanager
def staged_drops(
    mart: Mart, load: str, since: dt.date | None = None, days: Sequence[dt.date | None] | None = None
) -> Iterator[DataFrame]:
    """Normalised rows of the drops from a staged copy, which is deleted in the end.

    The copy holds the cells as text and header lines too. So widths are checked on its
    three columns for that, before any cell is taken for what its header says.
    """
    spark, root = mart.spark, folder_beside(mart.spark, mart.name(STAGED_DROPS))
    delete_folder(spark, root)  # of a load that broke off
    cells = parsed_lines(drop_lines(spark, mart.drops, since=since, days=days))
    rows = drop_rows(cells, marked=True)
    try:
        rows.write.parquet(f"{root}/{load}", compression=COMPRESSION)
        staged = spark.read.schema(rows.schema).parquet(f"{root}/{load}")
        check_widths(staged)
        yield normalise(staged.where("NOT is_header"))
    finally:
        delete_folder(spark, root)


def _note(pairs: DataFrame, table: str, load: str) -> None:
    rows = pairs.select("file_day", "sale_date", F.lit(load).alias("load")).coalesce(1)
    rows.write.mode("append").format("parquet").partitionBy("load").saveAsTable(table)


def _stale(mart: Mart, load: str, since: dt.date | None, days: Sequence[dt.date | None] | None) -> DataFrame:
    """Stored partitions (file_day, sale_date) of the loaded days that the load doesn't have."""
    if not table_exists(mart.spark, mart.name("sales_csv")):
        return mart.spark.createDataFrame([], "file_day date, sale_date date")
    partition = F.col("partition")
    stored = list_partitions(mart.spark, mart.name("sales_csv")).select(
        partition_day(partition, "file_day").alias("file_day"), partition_day(partition, "sale_date").alias("sale_date")
    )
    kept = mart.table(CHANGES).where(F.col("load") == load).select("file_day", "sale_date").alias("kept")
    asked = stored.where(of_days(F.col("file_day"), since, days)).alias("stored")
    same = F.col("stored.file_day").eqNullSafe(F.col("kept.file_day")) & F.col("stored.sale_date").eqNullSafe(F.col("kept.sale_date"))
    found = asked.join(kept, same, "left_anti").collect()  # only what is to be dropped
    return mart.spark.createDataFrame([tuple(row) for row in found], "file_day date, sale_date date")


def _note_files(mart: Mart, started: dt.datetime, since: dt.date | None, days: Sequence[dt.date | None] | None) -> None:
    """Note the files of the loaded days; one written after the start counts as not yet read.

    The notes are one compact table, in whose place the new notes are put as a whole.
    """
    table = mart.name(FILES)
    wanted = of_days(F.col("file_day"), since, days)
    seen = F.when(F.col("modified_at") < F.lit(started), F.col("modified_at"))
    files = list_drops(mart.spark, mart.drops, days).where(wanted)
    noted = files.select("source_file", seen.alias("modified_at"), "length", "file_day")
    if table_exists(mart.spark, table):
        noted = noted.unionByName(noted_files(mart).where(~wanted))
    with scoped_settings(mart.spark, LISTING_SETTINGS):
        full_refresh(noted.hint("rebalance"), table)


def noted_files(mart: Mart) -> DataFrame:
    """The files as they were when loaded; notes of earlier versions have no length."""
    noted = mart.table(FILES)
    length = F.col("length") if "length" in noted.columns else F.lit(None)
    return noted.select("source_file", "modified_at", length.cast("long").alias("length"), "file_day")


def changed_days(mart: Mart, *, loaded_only: bool = False) -> list[dt.date | None]:
    """Days of which a file has come, has been written again or has been taken away since
    their last load; with ``loaded_only`` new files do not count."""
    now = list_drops(mart.spark, mart.drops).select(
        "source_file", F.col("modified_at").alias("now_at"), F.col("length").alias("now_length"), F.col("file_day").alias("now_day")
    )
    both = noted_files(mart).join(now, "source_file", "left" if loaded_only else "full")
    same = F.coalesce(F.col("modified_at") == F.col("now_at"), F.lit(False)) & F.col("length").eqNullSafe(F.col("now_length"))
    changed = both.where(~same).select(F.coalesce("now_day", "file_day").alias("day")).distinct()
    # Bounded by the calendar.
    with scoped_settings(mart.spark, LISTING_SETTINGS):
        return [row["day"] for row in changed.collect()]


def load_redelivered(mart: Mart) -> None:
    """Load the days whose files were written again or taken away."""
    days = changed_days(mart, loaded_only=True)
    if days:
        load_third_party(mart, days=days)


def load_third_party_daily(mart: Mart) -> None:
    """Load the days whose drops are not as they were when loaded, late ones included."""
    if not table_exists(mart.spark, mart.name(FILES)):
        load_third_party(mart)
        return
    days = changed_days(mart)
    if days:
        load_third_party(mart, days=days)


def sales_rows(
    mart: Mart,
    own_since: dt.date | None = None,
    third_party_days: Sequence[dt.date | None] | None = None,
    own_days: Sequence[dt.date | None] | None = None,
) -> DataFrame:
    """United rows, laid out for ``sales``.

    Own sales are those of ``own_days`` or, without these, from ``own_since`` on; sales
    without a day cannot be told old from new and are then always taken whole.
    Only own sales are shuffled: third-party rows are stored by day already, and the
    files of a day are copied as they lie. If sales held by several drops are taken from
    the last, the rows of a reseller and a day that several drops have are shuffled too.
    """
    if own_days is None:
        own = sold_since(mart.source("sales"), own_since, keep_undated=True)
    else:
        own = sold_on(mart.source("sales"), own_days)
    third_party = mart.table("sales_csv")
    if third_party_days is not None:
        third_party = third_party.where(any_of(F.col("sale_date"), third_party_days))
    if mart.last_deliveries:
        # A sale's deliveries are all of its day, so the days that are read are enough.
        alone, contested = contested_apart(third_party)
        third_party = clustered(last_deliveries(contested, noted_files(mart)), ["sale_date"])
        if alone is not None:
            third_party = alone.unionByName(third_party)
    own = enrich_own_sales(
        own,
        mart.dimensions(),
        ["sale_date"],
        keep_time=mart.keep_sale_time,
        in_force=mart.agreements_in_force,
        heavy_share=mart.heavy_share,
    )
    return unite_sales(own, third_party)


def load_sales(mart: Mart) -> None:
    """Build ``sales`` anew from all own and all third-party sales."""
    pending = pending_loads(mart)
    with scoped_settings(mart.spark, ENGINE_SETTINGS):
        if mart.reconcile_sales:
            note_source_days(mart)
        full_refresh(sales_rows(mart), mart.name("sales"), S.SALES_PARTITIONS, is_clustered=True)
    _settle(mart, pending)
    if mart.reconcile_sales:
        settle_source_days(mart)


def pending_loads(mart: Mart) -> list[str]:
    """Third-party loads that ``sales`` has not taken over yet, from partition names."""
    if not table_exists(mart.spark, mart.name(CHANGES)):
        return []
    found = list_partitions(mart.spark, mart.name(CHANGES)).collect()
    return [row["partition"].removeprefix("load=") for row in found]


def _settle(mart: Mart, loads: Sequence[str]) -> None:
    if loads:
        drop_partitions(mart.spark, mart.name(CHANGES), [{"load": load} for load in loads])


def compact_sales(mart: Mart) -> None:
    """Bring the files of days that were written bit by bit down to what their size needs."""
    for name in ("sales_csv", "sales"):
        if table_exists(mart.spark, mart.name(name)):
            compact(mart.spark, mart.name(name))


LOADED_DAYS = "sales_days"
SOURCE_DAYS = "sales_days_now"


def note_source_days(mart: Mart) -> None:
    """Store the fingerprints of the source's days as they are before a load.

    What changes in the source while the load reads it differs from them, so the next load
    reads that day again.
    """
    aggregate = getattr(mart.source, "sales_fingerprints", None)
    found = aggregate() if aggregate else None
    full_refresh(day_fingerprints(mart.source("sales")) if found is None else found, mart.name(SOURCE_DAYS))


def settle_source_days(mart: Mart) -> None:
    """Take the noted fingerprints for loaded ones; a load that broke off does not come here."""
    full_refresh(mart.table(SOURCE_DAYS), mart.name(LOADED_DAYS))


def differing_days(mart: Mart) -> tuple[list[dt.date | None], list[dt.date | None]]:
    """Days of own sales that are not as they were loaded, and those of them that have no sales left."""
    found = differing(mart.table(SOURCE_DAYS), mart.table(LOADED_DAYS)).collect()  # bounded by the calendar
    return [row["sale_date"] for row in found], [row["sale_date"] for row in found if row["is_gone"]]


def load_sales_daily(mart: Mart) -> None:
    """Add to ``sales`` what is new.

    Own sales are taken from the start of their last day on or, if the mart reconciles
    them, for every day whose fingerprint in the source is not the loaded one: late,
    changed and removed sales of any day. Third-party sales are taken for every day that
    a load of ``sales_csv`` has noted since the last run that came to its end, old days
    with late drops included. A day that has no rows left is taken out. Origins have
    partitions of their own, so neither touches the other's rows. The rows that are
    written depend on what has changed, not on how many days are stored.
    """
    spark, table = mart.spark, mart.name("sales")
    known = not mart.reconcile_sales or table_exists(spark, mart.name(LOADED_DAYS))
    if not table_exists(spark, table) or not known:
        load_sales(mart)
        return
    pending = pending_loads(mart)
    # Bounded by the calendar.
    days = []
    if pending:
        changed = mart.table(CHANGES).where(F.col("load").isin(pending)).select("sale_date").distinct()
        days = [row["sale_date"] for row in changed.collect()]
    own_since, own_days, own_gone = None, None, []
    with scoped_settings(spark, ENGINE_SETTINGS):
        if mart.reconcile_sales:
            note_source_days(mart)
            own_days, own_gone = differing_days(mart)
        else:
            own_since = latest_sales_day(spark, table, S.OWN_ORIGIN)
        if own_days is None or own_days or days:
            rows = sales_rows(mart, own_since, days, own_days)
            upsert_partitions(rows, table, S.SALES_PARTITIONS, is_clustered=True)
    emptied = [(S.THIRD_PARTY_ORIGIN, day) for day in _emptied(mart, days)] + [(S.OWN_ORIGIN, day) for day in own_gone]
    drop_partitions(spark, table, [{"data_source": origin, "sale_date": day} for origin, day in emptied])
    _settle(mart, pending)
    if mart.reconcile_sales:
        settle_source_days(mart)


def _emptied(mart: Mart, days: Sequence[dt.date | None]) -> list[dt.date | None]:
    """Those of the days that no partition of ``sales_csv`` has."""
    if not days:
        return []
    partitions = list_partitions(mart.spark, mart.name("sales_csv"))
    stored = partitions.select(partition_day(F.col("partition"), "sale_date").alias("day")).where(any_of(F.col("day"), days))
    left = {row["day"] for row in stored.distinct().collect()}
    return [day for day in days if day not in left]
