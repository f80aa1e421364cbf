"""Stage source tables: S01-S04, M15."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.jsons import json_text, row_json
from ..functions.text import first_non_empty


def read_text_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file or folder as text columns. Columns are matched by the header of each file, absent ones are NULL.

    Files with the same header line are read together; only names and header lines reach the driver. A value may hold line
    breaks: a file with a line of unpaired quotes, which every such value begins with, is read by one task, all others are
    split between tasks.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = F.when(F.col("file_block_start") == 0, F.monotonically_increasing_id())
    unpaired = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    heads = lines.select("file_path", "value", first.alias("line"), unpaired.alias("unpaired")).groupBy("file_path").agg(
        F.min_by("value", "line").alias("head"), F.max("unpaired").alias("broken"), F.min_by("unpaired", "line").alias("open"))
    groups: dict[tuple, list[str]] = {}
    for r in heads.orderBy("file_path").collect():
        # a header that goes on in the next line is known in full by its own file only
        groups.setdefault((r["broken"], r["head"], r["file_path"] if r["open"] else None), []).append(r["file_path"])
    reader = spark.read.option("header", True).option("escape", '"').option("inferSchema", False)
    parts = [reader.option("multiLine", broken).csv(files) for (broken, _, _), files in groups.items()]
    if not parts:
        names = columns or P.RESULT_COLUMNS
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in names))
    if columns:
        parts = [df.select(*[_or_null(df, c) for c in columns]) for df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _or_null(df: DataFrame, column: str):
    present = column in df.columns
    return (F.col(f"`{column}`") if present else F.lit(None).cast("string")).alias(column)


def raw_row_json(df: DataFrame, out: str = "raw") -> DataFrame:
    """The whole row as one JSON value."""
    return df.withColumn(out, row_json(df))


def mapped_stage(df: DataFrame, mapping: dict[str, str], **extra: Column) -> DataFrame:
    """Target columns from their source columns, absent ones NULL, plus the raw row and ``extra`` columns."""
    return df.select(
        *[c.alias(name) for name, c in extra.items()],
        *[
            (F.col(f"`{src}`") if src in df.columns else F.lit(None).cast("string")).alias(target)
            for target, src in mapping.items()
        ],
        row_json(df).alias("raw"),
    )


def numeric_coerce(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers, bad text as NULL."""
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in columns else F.col(c) for c in df.columns])


def expected_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The expected columns in their order, absent ones NULL."""
    return df.select(*[_or_null(df, c) for c in columns or P.RESULT_COLUMNS])


def read_compound_results(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, P.RESULT_COLUMNS)


def backfill_columns(staging: DataFrame) -> DataFrame:
    """Fill empty columns of staged items from the raw row."""
    filled = {
        c: F.coalesce(first_non_empty(F.col(c), *[json_text(F.col("raw"), k) for k in keys]), F.col(c))
        for c, keys in P.BACKFILL_KEYS.items()
        if c in staging.columns
    }
    return staging.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in staging.columns])
