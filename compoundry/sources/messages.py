"""Messages: S07-S12. A message is a key and a JSON value; the carrier is any Spark source or sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.jsons import is_json_object
from ..functions.text import hint_normalize, request_key, strip_ws

_JSON = {"ignoreNullFields": "false"}
REQUEST_FIELDS = "struct<query:string,hint:string,source:string,source_item_id:string,ts:string>"


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def request_messages(queries: DataFrame, now: Column, requested_by: str | None = None) -> DataFrame:
    """Keyed requests; blank queries are skipped. ``requested_by`` gives the form keyed by the query."""
    q = strip_ws(F.coalesce("query", F.lit("")))
    hint = hint_normalize(F.col("hint"), "name")
    fields = [q.alias("query"), hint.alias("hint"), F.lit(P.SOURCE_COMPOUND).alias("source")]
    if requested_by:
        fields.append(F.lit(requested_by).alias("requested_by"))
    fields += [F.col("source_item_id"), iso_time(now).alias("ts")]
    key = q if requested_by else request_key(F.col("hint"), F.col("source_item_id"), F.col("query"))
    return queries.filter(q != "").select(key.alias("key"), F.to_json(F.struct(*fields), _JSON).alias("value"))


def request_stream(spark: SparkSession, source: dict[str, str], schema: str | None = None) -> DataFrame:
    """A stream of (key, value) text from the earliest message on.

    ``source`` holds the format and its options, e.g. ``{"format": "kafka", "subscribe": …}`` or a
    file format with ``path``; file formats need ``schema``.
    """
    options = dict(source)
    fmt = options.pop("format")
    path = options.pop("path", None)
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return df.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp", "partition", "offset")
    return df


def decode_requests(messages: DataFrame) -> DataFrame:
    """Request fields next to the message; ``error`` is BAD_JSON for anything but one JSON object."""
    ok = is_json_object(F.col("value"))
    req = F.from_json("value", REQUEST_FIELDS)
    return messages.select(
        *messages.columns,
        F.when(ok, req["query"]).alias("query"),
        F.when(ok, req["hint"]).alias("hint"),
        F.when(ok, req["source_item_id"].try_cast("bigint")).alias("source_item_id"),
        F.when(~ok, "BAD_JSON").alias("error"),
    )


def result_messages(persisted: DataFrame, now: Column, latency_ms: Column | None = None) -> DataFrame:
    """S08."""
    latency = latency_ms if latency_ms is not None else F.lit(None).cast("double")
    return persisted.select(
        "key",
        F.to_json(
            F.struct(
                "query", F.lit(P.SOURCE_COMPOUND).alias("source"), F.col("cid").cast("string").alias("cid"),
                "molecular_formula", "molecular_weight", "iupac_name", iso_time(now).alias("ts"),
                latency.alias("latency_ms"),
            ),
            _JSON,
        ).alias("value"),
    )


def dead_letters(rejected: DataFrame) -> DataFrame:
    """The request as it came, with error, stage and attempts added; undecodable text is wrapped.

    The added fields are spliced into the JSON text, so fields this package does not know are kept.
    """
    added = F.to_json(F.struct("error", "stage", "attempts"))
    body = F.regexp_replace("value", r"\}" + P.WS + r"*\z", "")
    comma = F.when(strip_ws(body) == "{", "").otherwise(", ")
    spliced = F.concat(body, comma, F.substring(added, 2, 1 << 30))
    wrapped = F.to_json(F.struct("error", F.col("value").alias("raw")), _JSON)
    return rejected.filter(F.col("error").isNotNull()).select(
        "key", F.when(F.col("error") == "BAD_JSON", wrapped).otherwise(spliced).alias("value")
    )


def dead_letter_rows(rejected: DataFrame, now: Column) -> DataFrame:
    """S09 as table rows."""
    return rejected.filter(F.col("error").isNotNull()).select(
        "query", F.col("error").alias("reason"), "stage", F.col("attempts").cast("int").alias("attempts"),
        F.when(F.col("error") == "BAD_JSON", F.to_json(F.struct(F.col("value").alias("raw")))).otherwise(F.col("value")).alias("payload_json"),
        now.alias("created_at"),
    )


def topic_peek(messages: DataFrame, n: int = 20, order: str | None = None) -> DataFrame:
    """The first messages (by ``order``, e.g. the offset), JSON indented, other text as it is. Nothing is committed."""
    pretty = F.when(is_json_object(F.col("value")), F.to_json(F.from_json("value", "map<string,variant>"), {"pretty": "true"}))
    first = messages.orderBy(order).limit(n) if order else messages.limit(n)
    return first.select("key", F.coalesce(pretty, F.col("value")).alias("value"))


def lookup_log(looked_up: DataFrame, now: Column) -> DataFrame:
    """One log row per lookup."""
    hit = F.col("cid").isNotNull()
    return looked_up.select(
        F.lit("compound_lookup").alias("job_type"),
        "query",
        F.lit(P.SOURCE_COMPOUND).alias("source"),
        F.when(hit, "success").otherwise("error").alias("status"),
        F.when(hit, F.concat(F.lit("CID="), F.col("cid").cast("string"))).otherwise("No result from PubChem").alias("message"),
        F.lit(1).alias("attempt"),
        now.alias("created_at"),
    )
