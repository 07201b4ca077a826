"""Connected components by randomised contraction, on tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.llm.workspace import Workspace


def contracted(work: Workspace, links: DataFrame, name: str) -> DataFrame | None:
    """Map of ``node`` to ``root`` for all nodes of the links ``a``, ``b``; None without links.

    In each pass every node moves to that neighbour, or itself, which comes first in an
    order drawn anew, and links between moved nodes remain. A third of the nodes or more
    goes in each pass on average whatever the shape, so chains take few passes too. Each
    component ends with one root.
    """
    edges = links.filter(F.col("a") != F.col("b")).select("a", "b").distinct()
    edges = work.table(f"{name}-links-0", edges)
    roots, step = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(step)), F.col(c))  # noqa: E731, B023
        moved = both.groupBy("a").agg(F.min(order("b")).alias("near"))
        moved = moved.select(
            F.col("a").alias("node"),
            F.when(F.col("near") < order("a"), F.col("near.b")).otherwise(F.col("a")).alias("to"),
        )
        moved = work.table(f"{name}-moved-{step}", moved)
        left = moved.select(F.col("node").alias("a"), F.col("to").alias("u"))
        right = moved.select(F.col("node").alias("b"), F.col("to").alias("v"))
        kept = edges.join(left, "a").join(right, "b").filter(F.col("u") != F.col("v"))
        kept = kept.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        following = work.table(f"{name}-links-{step + 1}", kept)
        if roots is None:
            renamed = moved.withColumnRenamed("to", "root")
        else:
            hop = moved.select(F.col("node").alias("root"), "to")
            renamed = roots.join(hop, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        written = work.table(f"{name}-roots-{step}", renamed)
        work.drop(f"{name}-links-{step}", f"{name}-moved-{step}")
        if step:
            work.drop(f"{name}-roots-{step - 1}")
        edges, roots, step = following, written, step + 1
    work.drop(f"{name}-links-{step}")
    return roots
