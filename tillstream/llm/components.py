"""Connected components of a graph given as edges, by alternating star contraction.

Large stars hook every larger neighbour of a node to the smallest of its neighbourhood, small stars
the smaller ones; after a logarithmic number of rounds each component is a star around its smallest
node. Rounds are joins and aggregates over written tables; no component is ever gathered. They run in as
many tasks as there are edges for, so that a small graph doesn't leave a file per task and round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import few, settled


def _stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest node `m` among u and its v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("m", "u"))


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """`node` and `component`, its smallest reachable node, for all nodes with an edge.

    `edges` has long columns `u` and `v`; order, repeats, loops and nulls don't matter.
    """
    clean = edges.filter("u is not null and v is not null and u <> v")
    clean = clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    count = clean.count()
    current = settled(few(few(clean, count).distinct(), count), "edges")
    before = None
    for _ in range(most_rounds):
        # Neither step makes more edges than there are, in both directions.
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = few(_stars(few(both, 2 * count)), 2 * count)
        large = large.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = few(large.filter("u <> v").distinct(), 2 * count)
        small = few(_stars(large), 2 * count)
        hooked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        own = small.select("u", F.col("m").alias("v"))
        current = settled(few(few(hooked.union(own), 2 * count).distinct(), 2 * count), "edges")
        # A star around each smallest node stays as it is under both steps.
        now = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are not finished after {most_rounds} rounds")
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
