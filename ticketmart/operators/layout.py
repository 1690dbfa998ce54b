"""How rows lie in the tasks that write a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def clustered(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows with equal ``columns`` together, so that each partition gets few files.

    Adaptive execution splits what is too large for one task, such as a hot day,
    and merges what is small. Broadcast lookups that follow keep this layout.
    """
    return rows.hint("rebalance", *columns) if columns else rows
