"""Left lookups in large dimensions by keys that hold a large share of the facts.

Adaptive execution splits a hot partition of a join once its size is known. Where it is
off, or may not change a layout that a later step asks for, a heavy key still ends in one
task. Here a sketch of the facts' keys tells the heavy ones before the join: their facts
are dealt over many tasks by a second join key, and their rows of the dimension, no others,
are repeated for each of these. The facts are shuffled once and nothing is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.operators.lookup import any_null, lookup_nullable

_PART = "_part"


def _key(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(facts: DataFrame, keys: Sequence[str], share: float) -> list[int]:
    """Hashes of all keys that more than ``share`` of the facts have, and of few others.

    One pass over the key columns; each task keeps at most 1 / ``share`` candidates, and
    so does the result.
    """
    known = facts.where(~any_null(facts, keys)).select(_key(keys).alias("key"))
    found = known.stat.freqItems(["key"], share).first()
    return sorted(found["key_freqItems"] or []) if found else []


def lookup_heavy(facts: DataFrame, dimension: DataFrame, *keys: str, spread_by: str, share: float) -> DataFrame:
    """As ``lookup_nullable``, with each key of more than ``share`` of the facts dealt over many tasks."""
    heavy = heavy_keys(facts, keys, share)
    if not heavy:
        return lookup_nullable(facts, dimension, *keys, spread_by=spread_by)
    # As many parts that a part of the heaviest key there can be has no more rows than `share`.
    parts = math.ceil(1 / share)
    is_heavy = _key(keys).isin(heavy)
    part = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")
    dealt = facts.withColumn(_PART, F.when(is_heavy, part).otherwise(F.lit(0)))
    every = F.array(*[F.lit(i) for i in range(parts)])
    repeated = dimension.withColumn(_PART, F.explode(F.when(is_heavy, every).otherwise(F.array(F.lit(0)))))
    return lookup_nullable(dealt, repeated, *keys, _PART, spread_by=spread_by).select(
        *facts.columns, *[name for name in dimension.columns if name not in keys]
    )
