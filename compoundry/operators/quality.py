"""Integrity checks as violation queries: C01-C10.

A check that yields NULL passes, and keys that contain NULL are never duplicates, as in SQL constraints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import split_hot_join


def check(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which ``rule`` is false."""
    return df.filter(~F.coalesce(rule, F.lit(True)))


def check_non_blank(df: DataFrame, column: str) -> DataFrame:
    """C01."""
    return check(df, F.length(F.trim(F.col(column))) > 0)


def check_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """C02."""
    return check(df, F.col(column).rlike(pattern))


def check_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """C03."""
    return check(df, F.col(column).isin(allowed))


def check_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """C04."""
    return check(df, F.col(column).between(low, high))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Duplicate keys with their number of rows; counted in every task before the shuffle."""
    counted = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > 1)


def check_unique_expr(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The same on expressions."""
    return check_unique(df.select(*[c.alias(n) for n, c in keys.items()]), list(keys))


def check_reference(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows that point to no parent; a NULL reference passes."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return split_hot_join(child.filter(F.col(column).isNotNull()), keys, [column], "left_anti")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """C08."""
    return df.filter(F.col(column).isNull())


def json_column_repair(df: DataFrame, column: str) -> DataFrame:
    """A text column as JSON; text that does not parse becomes NULL."""
    ok = F.try_parse_json(F.col(column)).isNotNull()
    return df.withColumn(column, F.when(ok, F.col(column)))


def json_repair_counts(df: DataFrame, column: str) -> DataFrame:
    """C09 report: values that parse and values that do not (NULL is neither)."""
    ok = F.try_parse_json(F.col(column)).isNotNull()
    present = F.col(column).isNotNull()
    return df.agg(F.count(F.when(present & ok, 1)).alias("ok"), F.count(F.when(present & ~ok, 1)).alias("bad"))


def cascade_delete(child: DataFrame, column: str, surviving: DataFrame, parent_column: str) -> DataFrame:
    """Children whose parent is still there."""
    keys = surviving.select(F.col(parent_column).alias(column)).distinct()
    return split_hot_join(child, keys, [column], "left_semi")
