"""Connected components of an edge table, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table


def _jump(parent: DataFrame) -> DataFrame:
    """(id, root) of a forest (id, root) whose roots are below their ids."""
    while True:
        up = parent.select(F.col("id").alias("root"), F.col("root").alias("_up"))
        nxt = write_table(parent.join(up, "root", "left")
                          .select("id", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved")),
                          "forest")
        parent = nxt.select("id", "root")
        if nxt.filter("_moved").isEmpty():
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(id long, component long) for every id on an edge: the smallest id reachable.

    ``edges`` has columns a and b (long). Each round, every node with a smaller
    neighbour hooks on the smallest one, the forest is flattened by pointer
    jumping, and the edges are rewritten to the roots; loops vanish, so the
    table shrinks until it is empty. A hub's edges are pre-aggregated by min and
    its join partition can be split by AQE. Null ends and loops are ignored.
    """
    e = edges.filter("a is not null and b is not null and a <> b")
    e = write_table(e.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    found = None
    while not e.isEmpty():
        root = _jump(e.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("root")))
        if found is None:
            # smallest ends that never hooked are their own roots
            lows = e.select(F.col("lo").alias("id")).distinct().join(root, "id", "left_anti")
            found = root.unionByName(lows.select("id", F.col("id").alias("root")))
        else:
            r = root.select(F.col("id").alias("root"), F.col("root").alias("_up"))
            found = found.join(r, "root", "left").select("id", F.coalesce("_up", "root").alias("root"))
        found = write_table(found, "found")
        for end in ("hi", "lo"):
            r = root.select(F.col("id").alias(end), F.col("root").alias("_up"))
            e = e.join(r, end, "left").withColumn(end, F.coalesce("_up", end)).drop("_up")
        e = write_table(e.filter("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"))
                        .distinct(), "edges")
    if found is None:
        return edges.sparkSession.createDataFrame([], "id long, component long")
    return found.select("id", F.col("root").alias("component"))
