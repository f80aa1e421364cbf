"""Connected components of an edge table, by large-star and small-star rounds in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, durable


def _large(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to the least of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the edges (``a``, ``b``), root being the least node of its component.

    Loops, repeated and reversed edges are allowed; edges with a null end are left out; no edges give no rows. The
    rounds grow with the logarithm of the longest path, and no group is ever gathered in one row. Each round is
    written to the shared folder, so a lost executor costs no earlier round.
    """
    now = durable(edges.filter("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen, before = state, now
        now = durable(_small(_large(now)), "stars")
        discard(before)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
