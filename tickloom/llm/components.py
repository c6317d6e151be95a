"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import staged


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node it can reach, ``component``, for each node of ``links``
    (a, b: not null).

    Large-star and small-star steps by turns, until the links no longer change: every node then
    hangs on its component's smallest. A step is a minimum per node, combined before the shuffle,
    and an equi-join of two written tables, which Spark can split at a node with very many links.
    Steps are written to the shared folder, so lineage stays short.
    """
    ends = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(links.where("a <> b").select(ends.alias("e")).select("e.*").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        lowest = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "lowest")
        large = staged(both.where("v > u").join(lowest, "u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lowest = staged(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        moved = large.join(lowest, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(moved.union(lowest.select("u", "m")).distinct(), "links")
        # The links are a set, so equal counts and combined hashes mean equal links, for ids of any
        # type and size.
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                              F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
