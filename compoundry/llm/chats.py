"""Chat formatting: tool calls and their results, linked, ordered, validated and written as canonical JSON.

Calls and results are hash-joined by identifier. A call may name the call whose result it uses; depths of these
chains are found by pointer doubling, so the number of rounds is the logarithm of the longest chain. Arguments are
parsed as variants and held against a schema for each tool. Canonical JSON has sorted keys and no blanks. All work is
DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: For each tool its arguments: the types they may have (as Spark names a variant's type), and if they are required.
Schema = Mapping[str, Mapping[str, tuple[tuple[str, ...], bool]]]

STRING, WHOLE, NUMBER, TRUTH = ("STRING",), ("BIGINT",), ("BIGINT", "DOUBLE", "DECIMAL"), ("BOOLEAN",)


def keyed_left_join(rows: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """A left join in which rows with a null key are not shuffled (they would all go to one task)."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    found = rows.filter(F.col(key).isNotNull()).join(other, F.col(key) == F.col(other_key), "left")
    return found.unionByName(rows.filter(F.col(key).isNull()).select("*", *none))


def depths(calls: DataFrame) -> DataFrame:
    """(``id``, ``depth``) of calls (``id`` once each, ``after``): 0 without a known predecessor, null in a cycle."""
    known = calls.select(F.col("id").alias("_known"))
    now = keyed_left_join(calls, "after", known, "_known").select(
        "id", F.col("_known").alias("to"), F.when(F.col("_known").isNotNull(), 1).otherwise(0).cast("long").alias("depth"))
    now = durable(now, "depths")
    open_ = now.filter("to is not null").count()
    rounds = open_.bit_length() + 1  # a chain without a cycle is no longer than its calls
    while open_ and rounds:
        far = now.select(F.col("id").alias("_id"), F.col("to").alias("_to"), F.col("depth").alias("_depth"))
        now = durable(keyed_left_join(now, "to", far, "_id").select(
            "id", F.col("_to").alias("to"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")), "depths")
        open_, rounds = now.filter("to is not null").count(), rounds - 1
    return now.select("id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def faults(name: Column, arguments: Column, schema: Schema) -> Column:
    """Sorted faults of a call's arguments (a variant): ``unknown tool``, ``no object``, ``missing x``, ``type x``,
    ``extra x``; an empty array if there is none."""
    kind = F.schema_of_variant(arguments)
    keys = F.map_keys(F.from_json(F.to_json(arguments), "map<string,string>"))
    out = F.array(F.lit("unknown tool"))
    for tool, fields in schema.items():
        tests = []
        for field, (kinds, required) in fields.items():
            value = F.try_variant_get(arguments, F.lit(f"$['{field}']"), "variant")
            own = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
            wrong = F.when(own.isin(*kinds), None).otherwise(F.lit(f"type {field}"))
            tests.append(F.when(F.array_contains(keys, field), wrong).otherwise(F.lit(f"missing {field}") if required else F.lit(None)))
        extra = F.transform(F.array_except(keys, F.array(*map(F.lit, fields))), lambda k: F.concat(F.lit("extra "), k))
        found = F.when(arguments.isNull() | ~kind.startswith("OBJECT"), F.array(F.lit("no object"))).otherwise(
            F.array_sort(F.concat(F.filter(F.array(*tests), lambda x: x.isNotNull()), extra)))
        out = F.when(name == tool, found).otherwise(out)
    return out


def link(calls: DataFrame, results: DataFrame, schema: Schema) -> DataFrame:
    """Calls (``conv_id, turn, call_id, after, name, arguments``) and results (``conv_id, turn, call_id, content``) as
    one row each: ``conv_id``, ``turn``, ``kind``, ``call_id``, ``level``, ``linked``, ``faults``, ``json``.

    Rows sorted by (``conv_id``, ``level``, ``turn``, ``kind``, ``call_id``) stand after all they depend on; a level
    is null in a cycle, which sorts last. A call is linked if it has a result, a result if it has a call. Of calls
    with the same identifier the earliest counts for order. Null identifiers are linked with nothing; arguments that
    are null or no JSON are a fault and are left out of the JSON. Repeated rows stay. Other columns are not read.
    """
    calls = calls.select("conv_id", "turn", "call_id", "after", "name", "arguments")
    results = results.select("conv_id", "turn", "call_id", "content")
    nodes = calls.filter("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "after")).alias("_first"))
    depth = depths(nodes.select(F.col("call_id").alias("id"), F.col("_first.after").alias("after")))
    depth = depth.select(F.col("id").alias("_id"), "depth", F.lit(True).alias("_there"))
    answered = results.filter("call_id is not null").select(F.col("call_id").alias("_answer")).distinct()
    a = keyed_left_join(keyed_left_join(calls, "call_id", depth, "_id"), "call_id", answered, "_answer").withColumn(
        "_args", F.try_parse_json("arguments"))
    a = a.withColumn("faults", faults(F.col("name"), F.col("_args"), schema))
    made = a.select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id",
        F.when(F.col("call_id").isNull(), 0).otherwise(2 * F.col("depth")).alias("level"),
        F.col("_answer").isNotNull().alias("linked"), "faults",
        F.to_json(F.struct(F.col("_args").alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("call").alias("type"))).alias("json"))
    b = keyed_left_join(results, "call_id", depth, "_id")
    given = b.select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id",
        F.when(F.col("_there"), 2 * F.col("depth") + 1).otherwise(1).alias("level"),
        F.coalesce("_there", F.lit(False)).alias("linked"),
        F.when(F.col("_there"), F.array().cast("array<string>")).otherwise(F.array(F.lit("no call"))).alias("faults"),
        F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("type"))).alias("json"))
    return made.unionByName(given)


def messages(turns: DataFrame) -> DataFrame:
    """Turns that are neither call nor result (``conv_id, turn, role, content``) as rows like those of ``link``.

    They hang on nothing: ``level`` 0, so that ``turn`` places them. Null roles and contents are left out of the JSON,
    empty ones and repeated rows stay, texts of any length stay whole. Other columns are not read.
    """
    return turns.select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit(0).cast("long").alias("level"), F.lit(False).alias("linked"), F.array().cast("array<string>").alias("faults"),
        F.to_json(F.struct("content", "role", F.lit("message").alias("type"))).alias("json"))
