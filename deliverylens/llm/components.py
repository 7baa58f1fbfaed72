"""Connected components of an undirected graph, by joins and aggregations.

Rounds of hooking every vertex to its smallest neighbour, jumping pointers and
contracting the edges. Edges at least halve in vertices each round, so the
rounds grow with the logarithm of the graph. The driver learns one number a
round (are edges left?); each round's tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each vertex of ``edges`` (a, b) with the smallest vertex it reaches.

    Loops and repeated edges change nothing; without edges there are no rows.
    """
    edges = staged(edges.select("a", "b").distinct(), "edges")
    found = staged(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                   .select("node", F.col("node").alias("root")), "roots")
    edges = edges.where("a <> b")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        hook = staged(both.groupBy("node").agg(F.min("other").alias("up"))
                      .select("node", F.least("node", "up").alias("up")), "hooks")
        for _ in range(2):  # pointers point down in value, so jumping ends
            above = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = staged(hook.join(above, "up").select("node", F.col("top").alias("up")), "hooks")
        found = staged(found.join(hook.select(F.col("node").alias("root"), "up"), "root", "left")
                       .select("node", F.coalesce("up", "root").alias("root")), "roots")
        to_a, to_b = (hook.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        edges = staged(edges.join(to_a, "a").join(to_b, "b")
                       .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
                       .where("a <> b").distinct(), "edges")
    return found
