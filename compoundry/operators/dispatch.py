"""Choose which queries to send: J02, J03, J17, W01, W06, W07, U03, T07."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import hint_normalize, priority_class, strip_ws
from .seed import unlinked
from .skew import split_hot_join
from .upsert import reduce_first

_KEY = ["source_item_id", "_q", "_h"]


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("_q", strip_ws(F.col("query"))).withColumn("_h", hint_normalize(F.col("hint"), "name"))


def unsent(queries: DataFrame, log: DataFrame) -> DataFrame:
    """Queries not in the log, any hint case, outer blanks ignored. Without item id: always unsent."""
    sent = _keyed(log).select(*_KEY).distinct()
    return _keyed(queries).join(sent, _KEY, "left_anti").withColumn("hint", F.col("_h")).drop("_q", "_h").select(*queries.columns)


def unsent_unlinked(queries: DataFrame, items: DataFrame, xref: DataFrame, log: DataFrame) -> DataFrame:
    """Unsent queries of items that have no compound link."""
    open_items = unlinked(items, xref).select("source_item_id")
    # an item has few queries, so its id is nearly unique here: no counting of keys
    return unsent(queries.join(open_items, "source_item_id", "left_semi"), log)


def clear_log(log: DataFrame, items: DataFrame, xref: DataFrame) -> DataFrame:
    """The log without the rows of unlinked products, so that they are sent again."""
    return split_hot_join(log, unlinked(items, xref).select("source_item_id"), ["source_item_id"], "left_anti")


def cap_topn(queries: DataFrame, n: int = 3, order: list[Column] | None = None) -> DataFrame:
    """The ``n`` best queries per item by (priority, order of discovery); 0 keeps all.

    The filter on the row number is pushed below the shuffle as a group limit, so an item with very
    many queries sends at most ``n`` rows per task.
    """
    by = order or [F.col("seq").asc(), F.col("query").asc(), F.col("hint").asc()]
    ranked = queries.withColumn("priority", priority_class(F.col("query")))
    if n <= 0:
        return ranked
    w = W.partitionBy("source_item_id").orderBy(F.col("priority"), *by)
    return ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def keyset_page(df: DataFrame, key: str, after: int, limit: int) -> DataFrame:
    """The next page by ascending key; top rows per task, then one merge of ``limit`` rows per task."""
    return df.filter(F.col(key) > after).orderBy(key).limit(limit)


def ordered_limit(df: DataFrame, key: str, limit: int) -> DataFrame:
    """W07."""
    return df.orderBy(key).limit(limit)


def pick_mode(choices: list[Callable[[], DataFrame]]) -> DataFrame:
    """The first source that has a row. Each is asked for one row only; later ones are not run."""
    last = None
    for choice in choices:
        last = choice()
        if not last.isEmpty():
            return last
    if last is None:
        raise ValueError("no choices given")
    return last


def dedupe_requests(messages: DataFrame, order: str = "value", event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """One message per key, the first by ``order`` (then by value).

    On a stream the first to arrive stays, also after a restart from the checkpoint: a key is remembered until the
    watermark (the latest ``event_time`` less ``delay``) has passed it by ``delay``, so state is bounded by what arrives in
    that time. A stream that has a watermark already needs neither. Messages older than the watermark are left out.
    """
    if messages.isStreaming:
        marked = messages.withWatermark(event_time, delay) if event_time else messages
        return marked.dropDuplicatesWithinWatermark(["key"])
    return reduce_first(messages, ["key"], F.struct(order, "value") if order != "value" else F.col("value")).select(*messages.columns)
