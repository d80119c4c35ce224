"""Connected components of an edge table by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.shared import shared_folder


def _signature(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) for every node that has an edge to another.

    Each round hangs neighbours on the smallest node around (Kiveris et al. 2014), which ends after
    a number of rounds that grows with the logarithm of a component's size. Both steps are a
    minimum per node, which combines before the shuffle, and an equi-join, so a node with very many
    edges is no single task. Every round is checkpointed in the shared folder; only a count and a
    checksum come to the driver. Rows with a null and loops link nothing; repeated edges and both
    directions count once; no edges give an empty table.
    """
    shared_folder(edges.sparkSession)
    pairs = (edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).alias("x"), F.col(b).alias("y"))
             .where("x is not null and y is not null and hi != lo").select("hi", "lo").distinct())
    pairs = pairs.checkpoint()
    seen = _signature(pairs)
    while True:
        # Large star: the neighbours of u that are above u go to the smallest node around u.
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u")
                 .select("v", "m").distinct())
        # Small star: the neighbours of v that are below v, and v itself, go to the smallest of them.
        below = large.groupBy("v").agg(F.min("m").alias("k"))
        moved = large.join(below, "v").where("m != k").select(F.col("m").alias("hi"), F.col("k").alias("lo"))
        pairs = moved.union(below.select(F.col("v").alias("hi"), F.col("k").alias("lo"))).distinct().checkpoint()
        now = _signature(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("lo").alias("node")).distinct()
    return (pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
