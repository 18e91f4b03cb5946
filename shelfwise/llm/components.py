"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import stored


def _with_least(links: DataFrame) -> DataFrame:
    """Each link (u, v) of a written table with the least of u and its neighbours.

    A merge join of two fresh shuffles, so that adaptive execution can split a node that a
    third of all links have.
    """
    least = stored(links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return links.hint("merge").join(least.hint("merge"), "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links(a, b)`` with the smallest node it can reach.

    Alternating star contraction: a large-star round hangs larger neighbours on the
    least one, a small-star round hangs the smaller ones. The number of links never
    grows, and rounds grow with the logarithm of the longest chain. Each round is
    written to the shared folder. It ends when a round changes nothing.
    """
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    links = stored(links, "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        met = _with_least(large)
        small = (
            met.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(met.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = stored(small, "links")
        state = links.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
