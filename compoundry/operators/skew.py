"""Joins that survive a key holding a large part of all rows.

Equi-joins in this package run under adaptive execution, which splits a large partition of a
sort-merge join. ``split_hot_join`` is the explicit form for keys that are known to repeat
(query text, compound id): it counts keys, and spreads only the hot ones over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 2_000_000
MAX_SPLITS = 1024
MAX_HOT_KEYS = 10_000
#: Rows of a result that one share of a key makes at most, in joins where both sides repeat their keys.
PAIRS_PER_SHARE = 20_000_000


def _hash(on: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in on])


def hot_keys(left: DataFrame, right: DataFrame | None, on: list[str], rows_per_split: int) -> DataFrame:
    """Hashes of keys above the split size, with the number of splits of each side; at most MAX_HOT_KEYS rows.

    Keys are counted by their hash, so keys of any length take eight bytes here; two keys of one hash are split
    alike. Keys beyond the limit only stay unsplit, so neither changes a join result.
    """
    counts = left.groupBy(_hash(on).alias("_hot")).agg(F.count(F.lit(1)).alias("_l"), F.lit(0).cast("long").alias("_r"))
    if right is not None:
        counts = counts.unionByName(
            right.groupBy(_hash(on).alias("_hot")).agg(F.lit(0).cast("long").alias("_l"), F.count(F.lit(1)).alias("_r"))
        ).groupBy("_hot").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))

    def splits(n: str) -> Column:
        return F.least(F.ceil(F.col(n) / rows_per_split), F.lit(MAX_SPLITS)).cast("int")

    return (
        counts.filter((F.col("_l") > rows_per_split) | (F.col("_r") > rows_per_split))
        .orderBy(F.greatest("_l", "_r").desc(), "_hot")  # a total order: both sides must see the same list
        .limit(MAX_HOT_KEYS)
        .select("_hot", F.greatest(splits("_l"), F.lit(1)).alias("_ls"), F.greatest(splits("_r"), F.lit(1)).alias("_rs"))
    )


def split_hot_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    rows_per_split: int = ROWS_PER_SPLIT,
    unique_right: bool = False,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` with hot keys spread over several tasks.

    A row of the hot side keeps one share of its key, chosen by the task that reads it (so exact
    copies spread too, and a repeated task chooses the same); the other side is repeated per share.
    Inner joins split both sides; other joins, and joins whose right side has one row per key, split the
    left side only. ``count_from`` names a cheaper frame to count the keys of the left side in.
    """
    both = how == "inner" and not unique_right
    counted = left if count_from is None else count_from
    hot = F.broadcast(hot_keys(counted, right if both else None, on, rows_per_split))
    share = F.xxhash64(*[F.col(k) for k in on], F.spark_partition_id())

    def one(n: str) -> Column:
        return F.when(F.col(n) > 1, F.pmod(share, F.col(n)).cast("int")).otherwise(0)

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))

    marked_l = left.withColumn("_hot", _hash(on)).join(hot, "_hot", "left").select(*left.columns, "_ls", "_rs")
    marked_l = marked_l.select(left.columns + ["_rs"] + [one("_ls").alias("_lsalt")])
    marked_r = right.withColumn("_hot", _hash(on)).join(hot, "_hot", "left").select(*right.columns, "_ls", "_rs")
    marked_r = marked_r.select(right.columns + ["_ls"] + [one("_rs").alias("_rsalt")])
    keys = on + ["_lsalt"]
    if both:
        keys = keys + ["_rsalt"]
        marked_l = marked_l.select(*left.columns, "_lsalt", each("_rs").alias("_rsalt"))
        marked_r = marked_r.select(*right.columns, "_rsalt", each("_ls").alias("_lsalt"))
    else:
        marked_l = marked_l.drop("_rs")
        marked_r = marked_r.select(*right.columns, each("_ls").alias("_lsalt"))
    return marked_l.join(marked_r, keys, how).drop("_lsalt", "_rsalt")


def pair_join(left: DataFrame, right: DataFrame, on: str, pairs_per_share: int = PAIRS_PER_SHARE) -> DataFrame:
    """``left.join(right, on)`` where a key may make far more rows than either side has.

    What counts is the product of a key's rows on both sides: a key that makes more than ``pairs_per_share`` rows is cut
    into a grid of shares, so that both sides are repeated as little as they can, and sorted shares are merged, because a
    broadcast would leave all rows of the result to the few tasks that read the other side. Both frames must be written
    tables: a row's share is its place in them. Keys beyond the bounded list of the largest only stay whole.
    """
    sides = [df.groupBy(on).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
    pairs = F.col("_l").cast("double") * F.col("_r")
    shares = F.ceil(pairs / pairs_per_share)
    high = F.least(F.lit(MAX_SPLITS), F.greatest(F.lit(1), F.ceil(F.sqrt(shares * F.col("_l") / F.col("_r"))))).cast("int")
    hot = (
        sides[0].join(sides[1], on).filter(pairs > pairs_per_share).orderBy(pairs.desc(), on).limit(MAX_HOT_KEYS)
        .select(on, high.alias("_ls"), shares.alias("_n"))
        .select(on, "_ls", F.least(F.lit(MAX_SPLITS), F.ceil(F.col("_n") / F.col("_ls"))).cast("int").alias("_rs"))
    )

    def marked(df: DataFrame, own: str, other: str) -> DataFrame:
        place = df.withColumn("_place", F.monotonically_increasing_id())
        known = place.join(F.broadcast(hot), on, "left")
        mine = F.pmod(F.xxhash64("_place"), F.coalesce(F.col(own), F.lit(1))).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return known.select(*df.columns, mine.alias(own + "alt"), theirs.alias(other + "alt"))

    keys = [on, "_lsalt", "_rsalt"]
    return marked(left, "_ls", "_rs").hint("merge").join(marked(right, "_rs", "_ls"), keys).drop("_lsalt", "_rsalt")
