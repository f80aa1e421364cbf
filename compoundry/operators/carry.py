"""Carry the last known value along an ordered group, without one task per group.

A window over a whole group would put a very large group (one document with a third of all pages)
into one task. Here the group is cut into ranges of its order column: a window runs inside each
range, and a small second window runs over one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE = 1024


def carry(
    df: DataFrame, group: str, order: str, value: str, out: str, backward: bool = False, width: int = RANGE
) -> DataFrame:
    """Add ``out``: the last non-NULL ``value`` strictly before the row (after it, when ``backward``).

    ``order`` is an integer, unique per group. The result keeps ``_range``, so that a second carry over
    the same rows finds them partitioned already.
    """
    ranged = df if "_range" in df.columns else df.withColumn("_range", F.floor(F.col(order) / width))

    def ordered(w, c: str):
        return w.orderBy(F.col(c).desc() if backward else F.col(c).asc()).rowsBetween(
            W.unboundedPreceding, -1
        )

    def last(c: str):
        return F.last(c, ignorenulls=True)

    inside = ranged.withColumn("_near", last(value).over(ordered(W.partitionBy(group, "_range"), order)))
    pick = F.min_by if backward else F.max_by
    ends = (
        ranged.groupBy(group, "_range")
        .agg(pick(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
        .withColumn("_far", last("_end").over(ordered(W.partitionBy(group), "_range")))
        .select(group, "_range", "_far")
    )
    return inside.join(ends, [group, "_range"], "left").select(
        *ranged.columns, F.coalesce("_near", "_far").alias(out)
    )
