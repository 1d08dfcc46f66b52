"""Connected components of links between rows, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import store


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node with links.

    In each round every node joins the neighbour of the least random rank, or itself,
    takes over what that one joined, and links are redrawn between what they joined; a
    constant share of the nodes goes in each round, whatever the shape, and a node
    with a great many links is one aggregated row. Links stay in tables throughout.
    """
    edges = first = store(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps = []
    while not edges.isEmpty():
        salt = len(steps)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Ranks are of one salt, so the order is one for all nodes of a round.
        rank = lambda c: F.struct(F.xxhash64(F.lit(salt), c).alias("rank"), F.col(c).alias("node"))  # noqa: B023, E731
        hooked = both.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a"))).alias("to")).select(F.col("a").alias("from"), F.col("to.node").alias("to"))
        onward = hooked.select(F.col("from").alias("to"), F.col("to").alias("next"))
        step = store(hooked.join(onward, "to").select("from", F.col("next").alias("to")))
        steps.append(step)
        left = edges.join(step.select(F.col("from").alias("a"), F.col("to").alias("to_a")), "a")
        moved = left.join(step.select(F.col("from").alias("b"), F.col("to").alias("to_b")), "b").filter("to_a <> to_b")
        edges = store(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    # Steps are put together from the last one back, each a constant share of the one before it.
    onward = None
    for step in reversed(steps):
        if onward is not None:
            later = onward.select(F.col("from").alias("over"), F.col("to").alias("end"))
            step = step.join(later, step["to"] == later["over"], "left").select("from", F.coalesce("end", "to").alias("to"))
        onward = step
    if onward is None:
        return first.select(F.col("a").alias("node"), F.col("b").alias("component"))  # no links
    reached = store(onward.select(F.col("from").alias("node"), F.col("to").alias("at")))
    least = reached.groupBy("at").agg(F.min("node").alias("component"))
    return reached.join(least, "at").select("node", "component")
