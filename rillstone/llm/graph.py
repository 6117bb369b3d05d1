"""Connected components of a graph of any shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.shared import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    """A count and a checksum of the edges, in whatever order they come."""
    return tuple(
        edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    )


#: Edges that a task works on, about. What few tasks hold is shuffled by few tasks.
EDGES = 100_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the edges ``u``, ``v`` but the roots.

    The root is the smallest node that can be reached. Large and small stars alternate:
    each node's larger neighbours, then its smaller ones, are hung on the smallest node
    it knows, until nothing moves. A round is a few aggregations and joins over the edges;
    lineage is cut after each. Loops and repeated edges do no harm; nulls are left out.
    """
    edges = cut(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _state(edges)
    while before[0]:
        tasks = -(-before[0] // EDGES)
        edges = edges.coalesce(tasks)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).coalesce(tasks)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(tasks).union(least.where("m < u").select("u", F.col("m").alias("v")))
        large = large.where("u > v").distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.coalesce(tasks).union(least.select("u", F.col("m").alias("v")))
        edges = cut(small.distinct().coalesce(tasks))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
