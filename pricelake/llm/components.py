"""Connected components of an edge list by alternating star contraction, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import stored

#: Rounds after which something must be wrong; contraction needs a number logarithmic in the nodes.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it knows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each node's component, for every node of ``edges`` (a, b).

    Loops (a = b) are ignored. Each round's edges are stored, so lineage stays
    short and a lost executor costs one round at most.
    """
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = stored(_small_star(_large_star(now)), "edges")
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = tuple(found)
    raise RuntimeError("components did not settle")
