"""Connected components of links that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topup_analytics.llm.common import Scratch

#: Links that a task takes.
ROWS = 500_000


def components(links: DataFrame, scratch: Scratch, most: int | None = None) -> DataFrame:
    """Rows ``node, root`` for every node of the links ``a, b`` that is not the smallest of its component.

    Alternates two steps until nothing changes. In the large star each node
    links its larger neighbours to its smallest neighbour, in the small star its
    smaller ones; both keep the components and shrink every path, so the number of
    rounds grows with the logarithm of the nodes. Each round's links are written to
    ``scratch``, where the result lies too. The smallest neighbours are stored before they are joined,
    so a node with very many links is one Spark can split. ``most`` is a bound of the links, if there is one.
    """
    a, b = F.col("a"), F.col("b")
    first = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, n = scratch.counted(first, most, ROWS)
    before = None
    while (now := _mark(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = scratch.stored(least, 2 * n, ROWS)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, n = scratch.counted(large, 2 * n, ROWS)
        least = scratch.stored(large.groupBy("u").agg(F.min("v").alias("m")), n, ROWS)
        others = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, n = scratch.counted(others.union(least.select("u", F.col("m").alias("v"))).distinct(), 2 * n, ROWS)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20)"))
    return tuple(edges.agg(F.count("*"), total).first())
