"""Connected components by rounds of star contraction, on edges that stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node `a` to the smaller one `b`."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _to_least(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The least of each node and its neighbours, and the pairs with it.

    The least neighbour is aggregated first and written, so that the join that follows
    is a plain one whose hot keys adaptive execution can split.
    """
    least = stored(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return least, pairs.join(least, "a")


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root."""
    sizes = edges.agg(F.count("*").alias("n"), F.count_distinct("a").alias("children")).first()
    if sizes["n"] != sizes["children"]:
        return False
    return edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Columns `node` and `component`, its least member, for every node of an edge.

    `edges` has integer columns `a` and `b`; loops, repeats and an empty table are fine.
    The number of rounds grows with the logarithm of a component's size; what goes to
    the driver each round are two counts. No node is lost from round to round, as each
    keeps an edge to a lesser node of its component until it hangs on the least one.
    """
    now = stored(_downward(edges), "edges")
    while not _is_settled(now):
        # All larger neighbours of a node move to the least one of its neighbourhood,
        _, joined = _to_least(_both_ways(now))
        large = stored(_downward(joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))), "large")
        # then the smaller ones do, and the node itself.
        least, joined = _to_least(large)
        own = least.select("a", F.col("m").alias("b"))
        now = stored(_downward(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, component) after links (a, b) have joined components.

    A node without a label is a component of its own. Only components that a link
    touches are worked on.
    """
    of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    between = links.join(of_a, "a", "left").join(of_b, "b", "left")
    raised = stored(
        components(between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))), "raised"
    )
    moved = labels.join(raised.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    kept = moved.select("node", F.coalesce("to", "component").alias("component"))
    new = raised.join(labels.select("node"), "node", "left_anti")
    return stored(kept.unionByName(new.select("node", "component")), "labels")
