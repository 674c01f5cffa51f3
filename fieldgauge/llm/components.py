"""Connected components over a table of links, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.session import materialise



def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest reachable node) for every node in a link.

    Alternating stars: every node links its larger neighbours to the smallest one it knows, then
    its smaller neighbours likewise.  The links become stars in a number of rounds that grows
    with the logarithm of the longest chain.  Minima are aggregated before the shuffle, so a
    node with very many links costs one row per task.  Each round is written to the shared
    folder, which cuts the lineage.  Links with a null end and self links are ignored.
    """
    edges = materialise(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull())
        .distinct(),
        "links",
    )
    seen = None
    while True:
        # large star: the larger neighbours of n go to the smallest of n and its neighbours
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionAll(
            edges.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("l"))
        large = (
            both.where(F.col("m") > F.col("n")).join(least, "n")
            .select(F.col("m").alias("hi"), F.col("l").alias("lo")).distinct()
        )
        # small star: the smaller neighbours of n, and n, go to the smallest of them
        lowest = large.groupBy("hi").agg(F.min("lo").alias("l"))
        small = (
            large.join(lowest, "hi")
            .select(F.col("lo").alias("hi"), F.col("l").alias("lo"))
            .where(F.col("hi") != F.col("lo"))
            .unionAll(lowest.select("hi", F.col("l").alias("lo")))
            .distinct()
        )
        edges = materialise(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return nodes.unionAll(roots.select("node", F.col("node").alias("component")))
