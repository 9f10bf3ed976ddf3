"""Connected components of a table of links, by alternating stars.

A large star hangs every larger neighbour of a node on the smallest node next to it, a
small star every smaller one; both only aggregate and join, so a node with very many
links needs no list of them. What is aggregated is written before it is joined back: made in
the tasks of the join it would tie a node's links to one task, which Spark could not
split. The two alternate until the links no longer change: each
component is then one star around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import write_shared


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = write_shared(both.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
    joined = both.filter("v > u").join(least.withColumn("m", F.least("u", "m")), "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = write_shared(edges.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
    hung = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every linked node but the smallest of its component, which is v.

    ``links``: u and v of one orderable type, u != v; direction and repeats don't matter.
    """
    edges = write_shared(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        edges = write_shared(_large_star(edges), "large-star")
        edges = write_shared(_small_star(edges), "small-star")
        state, before = _state(edges), state
        if state == before:
            break
    return edges
