"""Session construction, scoped settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs count on: adaptive execution splits the hot partitions of joins
# and of writes, and turns a shuffle join into a broadcast one when the measured
# size allows it.
ENGINE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Days are cut from timestamps and compared with them, so runs must agree on the zone.
# A caller may set another one.
ZONE_SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def build_session(name: str = "ticketmart", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_SETTINGS, **ZONE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _effective(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value is None:
        try:
            value = spark.conf.get(key)
        except Exception:  # no such setting, or one without a default
            return None
    return None if value is None or value.startswith("<") else value


@contextmanager
def scoped_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply session settings for one block and put the old ones back.

    A setting that was not made gets its default, where it has one, rather than being
    taken away: a thread of an earlier job may be reading it at that moment.
    """
    before = {key: _effective(spark, key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_local_scratch: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    local session gets a temporary folder and any other session its warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="ticketmart-"))
        atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
    return _local_scratch[0]
