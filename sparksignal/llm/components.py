"""Connected components of a link table, by alternating large-star and small-star rounds.

Links stay distributed; the driver sees two numbers a round.  Each round is written to the
shared folder, so lost executors repeat one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksignal.llm.chunks import write_table


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Every node hands its neighbours (the larger ones, or the smaller ones and itself) to the smallest of them."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = both.join(low, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` in any order, repeats and self-links allowed -> ``node, root`` (smallest node
    reachable) for every node of a link between different nodes."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    seen = None
    while True:
        links = write_table(_star(_star(links, True), False), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
