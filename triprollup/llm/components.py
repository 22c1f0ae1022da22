"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triprollup.llm.tables import stored


def connected(edges: DataFrame) -> DataFrame:
    """vertex and root for each end of an edge (a, b bigint); the root is its least vertex.

    Every vertex hooks onto its least neighbour, if that is less; the chains are followed by
    doubling; edges then join what is left, the roots, until none remains. Each round is
    written to the shared folder. Nothing but counts reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    roots = stored(both.select(F.col("a").alias("vertex"), F.col("a").alias("root")).distinct(), "roots")
    while not both.isEmpty():
        hooks = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        hooks = stored(hooks, "hooks")
        while True:
            above = hooks.select(F.col("a").alias("p"), F.col("p").alias("next"))
            further = stored(hooks.join(above, "p").select("a", "p", "next"), "hooks")
            moved = further.filter("next <> p").isEmpty()
            hooks = further.select("a", F.col("next").alias("p"))
            if moved:
                break
        to_root = hooks.select(F.col("a").alias("root"), "p")
        roots = roots.join(to_root, "root", "left")
        roots = stored(roots.select("vertex", F.coalesce("p", "root").alias("root")), "roots")
        both = both.join(hooks, "a").select(F.col("p").alias("ra"), F.col("b").alias("a"))
        both = both.join(hooks, "a").select(F.col("ra").alias("a"), F.col("p").alias("b"))
        both = stored(both.filter("a <> b").distinct(), "edges")
    return roots
