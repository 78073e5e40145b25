"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.scratch import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half round on edges with u > v, which gives such edges again.
    Large: every node sends its larger neighbours to its smallest neighbour
    (or itself). Small: it sends itself and its smaller ones there. Both sides
    of an edge come from one row, so a step is not run once for each side."""
    pairs = lambda *x: F.explode(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in x))).alias("e")
    if large:
        least = edges.select(pairs(("u", "v"), ("v", "u"))).select("e.*").groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(pairs(("v", "m"), ("u", "m"))).select("e.*")
    return out.where("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long) that is
    not itself the smallest of its component. Alternating large and small
    stars; the number of rounds grows with the logarithm of the diameter.
    Every round is written, so a lost executor repeats one round at most."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    mark = None
    while True:
        edges = materialise(_stars(_stars(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)
