"""The request worker: T01-T06, T08, T09, M06, M07.

Every message ends in exactly one of two places: a result, or a dead letter with the step that refused
it. A micro-batch writes under its own batch number and overwrites on replay, so a restart from the
checkpoint changes nothing. Tables are kept as change logs (one folder per batch), and the cost of a
batch follows the batch, not the table; ``latest`` or an upsert folds the log.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import patterns as P
from ..operators.predicates import quality_error, request_error
from ..operators.upsert import COMPOUND_KEYS, XREF_KEYS, reduce_latest
from ..sources.messages import dead_letter_rows, dead_letters, decode_requests, lookup_log, result_messages
from .lookup import enrich_lookup


def validate_route(decoded: DataFrame) -> DataFrame:
    """Refused requests get stage ``validate`` and 0 attempts. Undecodable ones pass through."""
    error = F.coalesce("error", request_error(F.col("query"), F.col("hint")))
    bad_json = F.col("error") == "BAD_JSON"
    return decoded.select(
        *[c for c in decoded.columns if c != "error"],
        error.alias("error"),
        F.when(error.isNotNull() & ~F.coalesce(bad_json, F.lit(False)), "validate").alias("stage"),
        F.when(error.isNotNull() & ~F.coalesce(bad_json, F.lit(False)), 0).alias("attempts"),
    )


def enrich_route(validated: DataFrame, index: DataFrame) -> DataFrame:
    """Look up what is still in the race; refused rows ask nothing and get empty facts."""
    asking = validated.withColumn("_ask", F.when(F.col("error").isNull(), F.col("query")))
    return enrich_lookup(asking, index, "_ask").drop("_ask")


def gate_route(enriched: DataFrame) -> DataFrame:
    """Quality gate on looked-up rows; stage ``scrape``, 1 attempt."""
    gate = quality_error(F.col("cid"), F.col("molecular_formula"), F.col("iupac_name"), F.col("molecular_weight"))
    fresh = F.col("error").isNull() & gate.isNotNull()
    return enriched.select(
        *[c for c in enriched.columns if c not in ("error", "stage", "attempts")],
        F.coalesce("error", gate).alias("error"),
        F.when(fresh, "scrape").otherwise(F.col("stage")).alias("stage"),
        F.when(fresh, 1).otherwise(F.col("attempts")).alias("attempts"),
    )


def route(messages: DataFrame, index: DataFrame) -> DataFrame:
    """T01 to T04 over any frame of (key, value, …)."""
    return gate_route(enrich_route(validate_route(decode_requests(messages)), index))


def properties_json() -> Column:
    """The stored property set of a looked-up compound."""
    return F.to_json(
        F.struct(
            F.col("cid").alias("CID"), F.col("molecular_formula").alias("MolecularFormula"),
            F.col("molecular_weight").alias("MolecularWeight"), F.col("iupac_name").alias("IUPACName"),
        ),
        {"ignoreNullFields": "false"},
    )


def compounds_latest(accepted: DataFrame, order: Column) -> DataFrame:
    """M07 source: one row per compound, the last request wins."""
    rows = accepted.select(
        "query", F.lit(P.SOURCE_COMPOUND).alias("source"), F.col("cid").cast("string").alias("external_id"),
        properties_json().alias("properties"), order.alias("_order"),
    )
    return reduce_latest(rows, COMPOUND_KEYS, F.col("_order"))


def xref_from_stream(accepted: DataFrame, order: Column) -> DataFrame:
    """M06 source: one row per (product, compound); requests without product make no link."""
    rows = accepted.filter(F.col("source_item_id").isNotNull()).select(
        F.col("source_item_id").alias("product_id"), F.lit(P.SOURCE_COMPOUND).alias("source"),
        F.col("cid").cast("string").alias("external_id"), F.lit(None).cast("string").alias("cas"),
        F.lit(P.CONF_STREAM).alias("match_confidence"), properties_json().alias("properties_ref"), order.alias("_order"),
    )
    return reduce_latest(rows, XREF_KEYS, F.col("_order"))


def stream_metrics(routed: DataFrame, started_at: float) -> Column:
    """Wall time of the batch so far, in milliseconds."""
    return F.lit(round((time.time() - started_at) * 1000, 2))


#: The order in which messages count as sent; an offset alone says nothing across partitions.
ORDER = ("timestamp", "partition", "offset")
#: A sink: it gets a frame, the name of the output and the number of the batch, and must overwrite on replay.
Sink = Callable[[DataFrame, str, int], None]


def ordered_by(messages: DataFrame, order: str | Sequence[str]) -> Column:
    """The columns of ``order`` that the messages have, as one value."""
    names = [order] if isinstance(order, str) else [c for c in order if c in messages.columns]
    if not names:
        raise ValueError(f"messages have none of the columns {list(order)}")
    return F.struct(*names) if len(names) > 1 else F.col(names[0])


def persist_batch(
    batch: DataFrame, batch_id: int, index: DataFrame | Callable[[], DataFrame], out: str, order: str | Sequence[str] = ORDER,
    now: Column | None = None, sink: Sink | None = None,
) -> None:
    """Route one micro-batch and write its results, dead letters, changes and log.

    ``sink`` takes results and dead letters; without one they are Parquet folders like the tables. ``index`` may be a
    function that gives the index as it is now (``lookup.current_index``), so that it can change while the worker runs.
    """
    spark = batch.sparkSession
    started = time.time()
    stamp = now if now is not None else F.current_timestamp()

    def write(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{table}/batch={batch_id}")

    routed = route(batch, index() if callable(index) else index)
    write(routed, "routed")
    routed = spark.read.schema(routed.schema).parquet(f"{out}/routed/batch={batch_id}")
    accepted = routed.filter(F.col("error").isNull())
    by = ordered_by(accepted, order)
    write(compounds_latest(accepted, by), "compounds")
    write(xref_from_stream(accepted, by), "xref")
    looked_up = F.col("error").isNull() | (F.col("stage") == "scrape")
    write(lookup_log(routed.filter(looked_up), stamp), "lookup_log")
    send = (lambda df, name: sink(df, name, batch_id)) if sink else write
    send(result_messages(accepted, stamp, stream_metrics(routed, started)), "results")
    send(dead_letters(routed), "dead_letters")
    write(dead_letter_rows(routed, stamp), "dead_letter_rows")


def run_worker(
    messages: DataFrame, index: DataFrame | Callable[[], DataFrame], out: str, checkpoint: str, order: str | Sequence[str] = ORDER,
    now: Column | None = None, continuous: str | None = None, sink: Sink | None = None,
) -> StreamingQuery:
    """L3: start the worker. Without ``continuous`` (a trigger interval) it works off what is there and ends.

    T06: the checkpoint holds the offsets; batch size is an option of the source
    (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: persist_batch(df, batch_id, index, out, order, now, sink)
    )
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def read_log(spark: SparkSession, out: str, table: str) -> DataFrame:
    """All batches of one output."""
    return spark.read.option("basePath", f"{out}/{table}").parquet(f"{out}/{table}")


def _folders(spark: SparkSession, path: str, prefix: str) -> dict[int, object]:
    """The numbered folders (``prefix=number``) of a path that are complete, by number; none where the path doesn't exist."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith(prefix + "=")]
    found = [f for f in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return {int(f.getName().split("=")[1]): f for f in found}


def latest(spark: SparkSession, out: str, table: str, keys: list[str], order: str | None = None) -> DataFrame:
    """A change log as a table: per key the row of the last batch (then ``order``). Batches that ``fold`` has taken in
    are read as its one state."""
    states = _folders(spark, f"{out}/{table}_state", "batch")
    log = read_log(spark, out, table) if _folders(spark, f"{out}/{table}", "batch") else None
    if states:
        newest = max(states)
        state = spark.read.parquet(f"{out}/{table}_state/batch={newest}").withColumn("batch", F.lit(newest))
        log = state if log is None else log.filter(F.col("batch") > newest).unionByName(state)
    by = F.struct("batch", order) if order else F.col("batch")
    return reduce_latest(log, keys, by).drop("batch")


def fold(spark: SparkSession, out: str, table: str, keys: list[str], order: str | None = None) -> None:
    """Write the table of a change log as one state, and drop what the fold before it had replaced.

    To be run between batches. A state is complete before it counts, so a run that is cut off can simply be repeated. What
    this fold replaces stays until the next one, so that a reader that was opened before can finish.
    """
    batches, states = _folders(spark, f"{out}/{table}", "batch"), _folders(spark, f"{out}/{table}_state", "batch")
    before = max(states, default=-1)
    newest = max(batches, default=-1)
    if newest <= before:
        return
    latest(spark, out, table, keys, order).write.mode("overwrite").parquet(f"{out}/{table}_state/batch={newest}")
    old = [f for n, f in batches.items() if n <= before] + [f for n, f in states.items() if n < before]
    for folder in old:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def once(sink: Sink, ledger: str) -> Sink:
    """``sink`` with a ledger of the batches it has taken, for sinks that can't overwrite.

    A batch that is replayed because the run ended between the sink and the checkpoint adds nothing. Only a run that
    ends between the sink's own end and the entry in the ledger gives a batch twice. ``ledger`` is a folder that the
    driver sees again after a restart; it gets one empty file for every output and batch.
    """
    def send(df: DataFrame, name: str, batch_id: int) -> None:
        spark = df.sparkSession
        entry = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{name}/{batch_id}")
        fs = entry.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(entry):
            sink(df, name, batch_id)
            fs.create(entry, False).close()

    return send


def activity_stream(events: DataFrame, kind: str, ts: str, window: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts per kind and event-time window; rows later than ``late`` are left to the watermark."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.window(ts, window), kind)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), kind, "n")
    )
