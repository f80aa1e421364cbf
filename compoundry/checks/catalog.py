"""Registry of checked queries: a name, a Spark callable over the fixtures, and an oracle in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import RUNTIME
from . import fixtures as fx

ENTRIES: dict[str, tuple[Callable[[fx.Tables], DataFrame], str | None]] = {}


def entry(name: str, sql: str | None = None):
    def register(fn: Callable[[fx.Tables], DataFrame]):
        ENTRIES[name] = (fn, sql)
        return fn

    return register


def now():
    return F.lit(fx.NOW).cast("timestamp")


def stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def num(column: str, alias: str | None = None):
    return F.round(F.col(column).cast("double"), 6).alias(alias or column)


def load() -> None:
    from . import entries_batch, entries_integrity, entries_published, entries_scalar, entries_stream, entries_text  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()

    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in RUNTIME.items():
                spark.conf.set(key, value)
            return fn(fx.Tables(spark, sf_dir))

        return run

    return {name: bind(fn) for name, (fn, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    load()
    return {name: fx.sql("duckdb", sql) for name, (_, sql) in ENTRIES.items() if sql}
