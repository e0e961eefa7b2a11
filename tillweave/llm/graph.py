"""Connected components of a link table by shrinking stars, every round stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node it is connected to.

    Each round hooks the root of every tree to the smallest root that a link leads to, then halves the paths, so the number
    of rounds grows with the logarithm of the longest path.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = frames.store(both.where("a <> b").distinct(), "links")
    roots = frames.store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root"))
                         .select("node", "root"), "roots")
    while True:
        at = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        hooks = (
            both.join(at("a"), "a").join(at("b"), "b").where(F.col("root_b") < F.col("root_a"))
            .groupBy(F.col("root_a").alias("root")).agg(F.min("root_b").alias("to"))
        )
        hooks = frames.store(hooks, "hooks")
        parents = frames.store(
            roots.join(hooks, "root", "left").select("node", F.least(F.coalesce("to", "root"), "root").alias("root")), "parents")
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        jumped = parents.join(above, "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
        jumped = frames.store(jumped, "roots")
        moved = jumped.join(roots.withColumnRenamed("root", "before"), "node").where("root <> before").limit(1).count()
        roots = jumped
        if not moved:
            return roots.select("node", F.col("root").alias("component"))
