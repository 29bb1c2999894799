"""Connected components of a graph held as a table of links."""

from pyspark.sql import DataFrame, functions as F

from tickermood.llm.common import saved

MAX_ROUNDS = 60


def _star_forest(links: DataFrame) -> bool:
    """Whether every node is either a root or linked to one root only."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("lo"), F.lit(0), F.lit(1))
    )
    uses = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return uses.where("up > 1 or (up = 1 and down > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` that is not the smallest of its component.

    Large-star and small-star steps alternate (Kiveris et al., "Connected Components
    in MapReduce and Beyond"): every node links its larger neighbours, then its
    smaller ones, to the smallest it knows, until each component is a star around
    its smallest node. A step is one grouped minimum and one join, so no group of
    neighbours is ever gathered; each step is written to the shared folder. The
    rounds needed grow with the logarithm of the longest path.
    """
    current = saved(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    for _ in range(MAX_ROUNDS):
        if _star_forest(current):
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        both = current.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(
            current.select("lo", "hi")
        )
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        least = least.select(F.col("node").alias("hub"), F.least("node", "least").alias("least"))
        large = (
            both.where("other > node").join(least, F.col("node") == F.col("hub"))
            .select(F.col("other").alias("hi"), F.col("least").alias("lo"))
            .distinct()
        )
        large = saved(large, "large-star")
        low = large.groupBy(F.col("hi").alias("hub")).agg(F.min("lo").alias("least"))
        small = (
            large.join(low, F.col("hi") == F.col("hub"))
            .where("lo <> least")
            .select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
            .union(low.select("hub", "least"))
            .distinct()
        )
        current = saved(small, "small-star")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
