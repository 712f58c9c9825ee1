"""Connected components over edges, distributed, in a few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 30) -> DataFrame:
    """``(id, component)`` of every node: the least id it is linked to, itself if it has no link.

    ``nodes`` has a column ``id``, ``edges`` the columns ``a`` and ``b``; links may repeat and point either way;
    links with a null end or from a node to itself are ignored.  Alternating large-star and small-star
    rounds (logarithmic in the diameter); each round is written to the checkpoint folder, and nothing
    but a counter reaches the driver.
    """
    links = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    links = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _summary(links)
    if not before[0]:
        return nodes.select("id").distinct().select("id", F.col("id").alias("component"))
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        after = cut(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        )
        now = _summary(after)
        # Equal sums are all but certain to be equal links; whether they are is asked only then.
        same = now == before and after.join(links, ["u", "v"], "left_anti").isEmpty()
        links, before = after, now
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.select("id").distinct().join(roots.withColumnRenamed("u", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _summary(links: DataFrame) -> tuple:
    """The number of links and the sum of their hashes."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
