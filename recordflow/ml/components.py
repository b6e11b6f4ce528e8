"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordflow.operators.lookups import BROADCAST_ROWS, lookup, saved, saved_rows


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for all nodes; ``edges`` has columns ``a`` and ``b``.

    Every round each node points at its neighbour of lowest hash, unless its own hash is lower;
    edges are then redrawn between the nodes pointed at. With fresh hashes every round the chains
    are short and the number of nodes with edges shrinks by a constant factor, so the rounds grow
    with the logarithm of the graph. Minima are combined before the shuffle, and hot nodes only
    occur on the probing side of a split lookup.
    """
    edges, left = saved_rows(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    hops = []
    while left:
        ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seed = F.lit(len(hops))

        def ranked(column: str):
            return F.struct(F.xxhash64(F.col(column), seed).alias("h"), F.col(column).alias("n"))

        lowest = ends.groupBy("a").agg(F.min(ranked("b")).alias("best"))
        own = ranked("a")
        hop, size = saved_rows(
            lowest.select(
                F.col("a").alias("node"),
                F.when(F.col("best") < own, F.col("best.n")).otherwise(F.col("a")).alias("next"),
            ),
            "hop",
        )
        # One doubling step: the next of the next.
        further = hop.select(F.col("node").alias("next"), F.col("next").alias("after"))
        twice = lookup(hop, further, ["next"], entries=size)
        hop = saved(twice.select("node", F.col("after").alias("next")), "hop")
        hops.append((hop, size))
        for end in ("a", "b"):
            step = hop.select(F.col("node").alias(end), "next")
            edges = lookup(edges, step, [end], entries=size).drop(end).withColumnRenamed("next", end)
        edges, left = saved_rows(edges.filter("a <> b").select("a", "b").distinct(), "edges")

    result = nodes.select("node", F.col("node").alias("root"))
    for hop, size in hops:
        step = hop.select(F.col("node").alias("root"), "next")
        result = lookup(result, step, ["root"], entries=size).select("node", F.coalesce("next", "root").alias("root"))
        if size > BROADCAST_ROWS:  # a split lookup names its input three times
            result = saved(result, "roots")
    return saved(result, "components")
