"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a few joins and aggregations over narrow rows, written to the shared folder, so lineage stays short and a
lost executor costs one step. Nothing is collected but two numbers that tell whether a step changed the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def star_labels(links: DataFrame) -> DataFrame:
    """(node, center) of every linked node but the centers: the smallest node it reaches. ``links`` has columns a and b.

    Steps go on until one changes nothing; their number grows with the logarithm of the nodes.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if (state["n"], state["x"]) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("center"))
        before = (state["n"], state["x"])
        # large star: larger neighbours go to the smallest neighbour of a node
        lowest = written(_both_ways(edges).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-star")
        large = _both_ways(edges).join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = written(large, "links")
        # small star: smaller neighbours and the node itself go to the smallest of them
        lowest = written(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        joined = edges.join(lowest, "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
