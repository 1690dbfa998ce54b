"""Left lookups from a large fact table into a dimension.

No join here is hinted blindly: a dimension is broadcast if it is known to be small, stored
and unpacked, and shuffled otherwise. In the shuffled form adaptive execution splits the
partition of a hot key, which works for a left join as the fact table is on the left.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, TimestampNTZType, TimestampType

_SPREAD = "_spread"

# Stored bytes of a dimension that is looked at more closely. A shuffle of the facts, which a
# lower threshold of the session would ask for, costs many times as much as a broadcast. A
# threshold of -1 still turns broadcasts off.
DIMENSION_BYTES = 16 << 20

# What the rows, unpacked, of all dimensions that the lookups of one enrichment broadcast may take
# of the heap of the driver or, if that has less, of an executor; and the most of it. Stored bytes
# tell little: keys in order are packed to less than a hundredth. As tables of joins such rows take
# two to three times as much, on each executor and, while they are put together, on the driver.
BROADCAST_SHARE = 24
BROADCAST_BYTES = 256 << 20


def lookup(facts: DataFrame, dimension: DataFrame, *keys: str) -> DataFrame:
    return facts.join(dimension, on=list(keys), how="left")


def lookup_nullable(facts: DataFrame, dimension: DataFrame, *keys: str, spread_by: str) -> DataFrame:
    """As ``lookup``, for keys that are NULL in many facts.

    Facts with a NULL key match nothing, yet a plain shuffle would send all of
    them to one task. A second join key spreads them by ``spread_by``; it is 0 on
    both sides wherever the keys are set, so the matches stay the same.
    """
    spread_facts = facts.withColumn(_SPREAD, spread_key(any_null(facts, keys), spread_by))
    # Not a plain literal: the optimizer would fold it out of the join keys.
    flat_dimension = dimension.withColumn(_SPREAD, any_null(dimension, keys).cast("long"))
    return spread_facts.join(flat_dimension, on=[*keys, _SPREAD], how="left").drop(_SPREAD)


def spread_key(unmatched: Column, spread_by: str) -> Column:
    """Join key that is 0 for facts that may match and spreads the others."""
    return F.when(unmatched, F.xxhash64(spread_by)).otherwise(F.lit(0).cast("long"))


def any_null(frame: DataFrame, keys: Sequence[str]) -> Column:
    found = frame[keys[0]].isNull()
    for key in keys[1:]:
        found = found | frame[key].isNull()
    return found


def broadcast_limit(frame: DataFrame) -> int:
    """Stored bytes below which a dimension may be broadcast."""
    threshold = _threshold(frame)
    return max(threshold, DIMENSION_BYTES) if threshold >= 0 else threshold


def unpacked_limit(frame: DataFrame) -> int:
    """Bytes of unpacked rows below which dimensions may be broadcast together."""
    threshold = _threshold(frame)
    if threshold < 0:
        return threshold
    jvm, context = frame.sparkSession._jvm, frame.sparkSession.sparkContext
    heap = jvm.java.lang.Runtime.getRuntime().maxMemory()
    if not context.master.startswith("local["):
        executor = context.getConf().get("spark.executor.memory", "1g")
        heap = min(heap, jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(executor))
    return max(threshold, min(heap // BROADCAST_SHARE, BROADCAST_BYTES))


def _threshold(frame: DataFrame) -> int:
    return frame.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def planned_bytes(frame: DataFrame) -> int:
    """The planner's own estimate, which for stored tables comes from file sizes and for
    sources of unknown size is above any threshold."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


_FIXED = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def row_bytes(frame: DataFrame) -> Column:
    """Bytes that a row takes as Spark holds it in memory: eight a column, and texts by their length."""

    def size(name: str, kind: DataType) -> Column:
        if isinstance(kind, _FIXED):
            return F.lit(8)
        return F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 12

    sizes = [size(field.name, field.dataType) for field in frame.schema]
    return reduce(lambda a, b: a + b, sizes, F.lit(8)).cast("long")


def unpacked_bytes(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of all rows of each frame, in one small job."""
    sums = [
        frame.agg(F.lit(name).alias("name"), F.coalesce(F.sum(row_bytes(frame)), F.lit(0)).alias("bytes"))
        for name, frame in frames.items()
    ]
    if not sums:
        return {}
    return {row["name"]: row["bytes"] for row in reduce(DataFrame.unionAll, sums).collect()}


def small_dimensions(frames: Mapping[str, DataFrame], reduced: Collection[str] = ()) -> set[str]:
    """Names of the dimensions that can be broadcast together: the smallest, as long as all of them fit.

    Those that are too large as they are stored are not read for it, except for ``reduced``
    ones, which have but some of the stored rows.
    """
    asked = {name: frame for name, frame in frames.items() if name in reduced or planned_bytes(frame) <= broadcast_limit(frame)}
    sizes = unpacked_bytes(asked)
    small, taken = set(), 0
    for name in sorted(sizes, key=sizes.__getitem__):
        taken += sizes[name]
        if taken <= unpacked_limit(frames[name]):
            small.add(name)
    return small


def known_small(*frames: DataFrame) -> bool:
    """Whether all frames together are known to stay below both limits."""
    if sum(map(planned_bytes, frames)) > broadcast_limit(frames[0]):
        return False
    return sum(unpacked_bytes(dict(zip(map(str, range(len(frames))), frames))).values()) <= unpacked_limit(frames[0])


def sized(dimension: DataFrame, is_small: bool) -> DataFrame:
    """Hinted, as the planner would broadcast a large dimension whose files are small."""
    return F.broadcast(dimension) if is_small else dimension.hint("merge")
