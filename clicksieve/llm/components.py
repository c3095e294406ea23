"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import functions as F

from clicksieve.llm.common import saved


def _large_star(links):
    """Each node's greater neighbours are linked to its least neighbour."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "components-least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links):
    """Each node and its lesser neighbours are linked to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = saved(down.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(links):
    """``node, component`` of all linked nodes: the least node that can be reached.

    ``links`` has ``u, v``. The links are rewritten until they are stars around
    the least node of each component, which takes a number of rounds that grows
    with the logarithm of the nodes. No node's links meet in one task: least
    neighbours are aggregated before they are shuffled, and joined back with
    inputs that Spark can split.
    """
    links = saved(links.select("u", "v").where("u <> v").distinct(), "components-links")
    state = None
    while True:
        links = saved(_large_star(links), "components-links")
        links = saved(_small_star(links), "components-links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
