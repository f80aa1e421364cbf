"""What the operators share: reading the given tables, Arrow batches of bounded size, and bounded caches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, durable

__all__ = ["discard", "documents", "durable", "flagged", "map_batches", "may_match", "table", "ascii_lower", "ROWS_PER_BATCH", "BYTES_PER_BATCH"]

#: An Arrow batch given to Python holds at most so many rows, and about so many bytes.
ROWS_PER_BATCH = 1_000
BYTES_PER_BATCH = 16 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers get small batches, and look for this package where the driver has it."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], add: str, keep: list[str],
) -> DataFrame:
    """The columns ``keep`` of ``df`` and, row by row, the columns of the schema string ``add`` that ``fn`` makes."""
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    new = [part.strip().split(" ")[0] for part in add.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(batch)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, *made], names=[*keep, *new])

    return df.mapInArrow(run, f"{kept}, {add}" if kept else add)


_holder: tuple[str, Callable[[], None]] | None = None


def claim(owner: str, clear: Callable[[], None]) -> None:
    """Python workers serve one operator after another: what the last one remembers goes when the next one starts."""
    global _holder
    if _holder is not None and _holder[0] != owner:
        _holder[1]()
        pa.default_memory_pool().release_unused()
    _holder = (owner, clear)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


#: Bits of a prefilter: so many eighths of bytes are broadcast, whatever the size of the tables.
FILTER_BITS = 1 << 26
_BITS_A_ROW = 1 << 15  # of the bitmap functions


def flagged(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` with ``_may``: whether the 64-bit ``key`` may be among the wanted ones. True for all that are, and a few others.

    The wanted keys become a bitmap of FILTER_BITS bits by a partial aggregation, which is broadcast; so of a large
    table with few wanted rows only these are shuffled by the join that follows. Where the wanted keys are as many as
    the bits, most rows pass, and that join does all the work.
    """
    def place(k: Column) -> Column:
        return F.pmod(k, F.lit(FILTER_BITS)) + 1

    bits = wanted.select(place(wanted_key).alias("k")).groupBy(F.bitmap_bucket_number("k").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("_bits"))
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumn("_place", place(key)).withColumn("_part", F.bitmap_bucket_number("_place"))
    held = marked.join(F.broadcast(bits), "_part", "left")
    return held.select(*rows.columns, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias("_may"))


def may_match(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """The rows that ``flagged`` flags."""
    return flagged(rows, key, wanted, wanted_key).filter("_may").drop("_may")


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as a list, null as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]
