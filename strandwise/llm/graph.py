"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import written


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, root)`` for every row of ``nodes`` (one column); root is its component's least node.

    ``links`` has two columns of nodes. Large-star and small-star steps alternate until the
    links no longer change: each hangs a node's neighbours on the least one of them, so a
    round needs two shuffles and the number of rounds is logarithmic in practice. The links
    of a round are written out; a round's partial minima are taken before the shuffle, and
    a node with very many links is split by the adaptive skew join.
    """
    name = nodes.columns[0]
    a, b = links.columns
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    edges, before = written(edges), None
    while True:
        edges = written(_small_star(_large_star(edges)))
        # hash sums tell whether two rounds hold the same links
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before or now.n == 0:
            break
        before = now
    roots = edges.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(roots, F.col(name) == F.col("u"), "left").select(name, F.coalesce("v", name).alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours move to the least of a node's neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours and the node itself move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
