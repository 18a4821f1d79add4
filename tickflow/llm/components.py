"""Connected components of a graph given as edges, by alternating large and small stars.

Each round moves every neighbour to the smallest node that a node sees; the rounds needed grow with the
logarithm of the graph. Minima are pre-aggregated, joins have one row per node on one side (AQE splits
a hot node on the other), and the edges, each large star and each round are written to the shared folder:
a step reads its input several times, so what is not stored would stand as often in the driver's plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import shared_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge and is not itself the smallest of its component.

    ``edges``: (u, v), any direction, loops and repeats allowed.
    """
    now = shared_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = shared_table(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        now = shared_table(small.union(low.select("u", "m")).distinct(), "star")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
