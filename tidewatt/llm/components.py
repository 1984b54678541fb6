"""Connected components of a graph given as edges, by alternating star operations.

Large-star links every larger neighbour of a node to the least node around it, small-star every
smaller one; both are one aggregation and one equi-join, so a node with very many edges is split
by the skew join. No edge or label reaches the driver; only counts do. Each round is written to the
shared folder, and its predecessor deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.lasting import forget, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: u > v. Each is replaced by an edge to the least node seen from one end."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("_m", "u").alias("_m"))
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("_m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("_m").alias("v")))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge to another node; root is its component's least
    node. Edges with a null end or to themselves count for nothing. Raises if the rounds don't
    suffice; they grow as the logarithm of the number of nodes."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    edges = written(edges)
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    before = edges.agg(mark.alias("m")).first()["m"]
    if before["n"]:
        for _ in range(most_rounds):
            last, edges = edges, written(_star(_star(edges, large=True), large=False))
            forget(last)
            now = edges.agg(mark.alias("m")).first()["m"]
            if now == before:
                break
            before = now
        else:
            raise RuntimeError("components: the rounds did not suffice")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
