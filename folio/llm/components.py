"""Connected components of a distributed graph, by alternating large and small stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt_join, table

#: Links in one file of a round; rounds of a small graph then are a few files, whatever the number of shuffle partitions.
ROWS_A_FILE = 200_000


def components(edges: DataFrame, most_rounds: int = 60, sent: int | None = None) -> DataFrame:
    """(node, root) for every node of edges(a, b), two long columns: root is the least node that node is linked with.

    Each round replaces a node's links by links with its least neighbour, with larger ones only and then with smaller
    ones, until nothing changes; rounds grow with the logarithm of a component's size. Minima are pre-aggregated, links
    are repeated rows dropped early, and each round is written, so that no lineage builds up. A hub's links needn't be
    together: they are joined with its minimum where they are, or spread if there are too many nodes to send. Nothing is
    collected but a few numbers a round. Loops only name nodes; an empty graph gives no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    alone = e.filter("u = v").select("u").distinct()
    e = table(e.filter("u <> v").distinct(), "links")
    last = None
    for _ in range(most_rounds):
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == last or not now[0]:
            break
        last = now
        files = math.ceil(now[0] / ROWS_A_FILE)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("links")).coalesce(files), "least")
        e = dealt_join(both.filter("v > u"), least, ["u"], "links", sent=sent).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        e = table(e.coalesce(files), "links")
        least = table(e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links")).coalesce(files), "least")
        e = dealt_join(e, least, ["u"], "links", sent=sent).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = table(e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().coalesce(files), "links")
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    linked = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    return linked.unionByName(alone.join(linked, alone["u"] == linked["node"], "left_anti").select(F.col("u").alias("node"), F.col("u").alias("root")))
