"""The request worker run as a stream to its end: S07, T01-T09, M06, M07, L3."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import dispatch
from ..operators import upsert as up
from ..session import scratch_path
from ..sources import messages
from ..streaming import worker
from .catalog import entry, now
from .entries_batch import _XREF_OUT, _xref_out
from .entries_scalar import reference_index
from .fixtures import NOW, ORACLES, RELATIONS, _expand

_RUNS: dict[tuple[str, str], str] = {}


def _stream(t, files=1):
    """The event table as a stream of files; with several ``files`` it comes in as many micro-batches."""
    source = {"format": "parquet", "path": t.dir, "pathGlobFilter": "events.parquet", "maxFilesPerTrigger": "1"}
    if files > 1:
        source = {"format": "parquet", "path": scratch_path(t.spark, "events"), "maxFilesPerTrigger": "1"}
        t.events.repartitionByRange(files, "event_id").write.parquet(source["path"])
    return messages.request_stream(t.spark, source, schema=t.events.schema)


def _requests(t, files=1):
    """The request messages of ``fx_requests``, derived from the event stream."""
    view = "events_" + uuid.uuid4().hex
    _stream(t, files).createOrReplaceTempView(view)
    body = RELATIONS["fx_requests"].replace("{events}", view)
    return t.spark.sql(_expand(body, "spark", t.dir))


def run_once(t):
    """One full run of the worker; its outputs feed several queries."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _RUNS:
        out = scratch_path(t.spark, "worker")
        _run(t, out)
        _RUNS[key] = out
    return _RUNS[key]


def _run(t, out, requests=None):
    q = worker.run_worker(requests or _requests(t), reference_index(t), out, out + "-checkpoint", order="msg_no", now=now())
    q.awaitTermination()


def _read(t, table):
    return worker.read_log(t.spark, run_once(t), table)


@entry("S07_request_stream", "select msg_no, key, value from fx_requests")
def _(t):
    return _read(t, "routed").select("msg_no", "key", "value")


@entry("T01_decode_route", "select msg_no, value raw from o_routed where error='BAD_JSON'")
def _(t):
    return _read(t, "routed").filter("error='BAD_JSON'").select("msg_no", F.col("value").alias("raw"))


@entry("T02_validate_route", "select msg_no, error, attempts::int attempts from o_routed where stage='validate'")
def _(t):
    return _read(t, "routed").filter("stage='validate'").select("msg_no", "error", "attempts")


@entry("T03_enrich_route", "select msg_no, cid, molecular_formula, iupac_name from o_routed where verr is null")
def _(t):
    looked = _read(t, "routed").filter("error is null or stage='scrape'")
    return looked.select("msg_no", "cid", "molecular_formula", "iupac_name")


@entry("T04_gate_route", "select msg_no, error, stage, attempts::int attempts from o_routed where verr is null")
def _(t):
    return _read(t, "routed").filter("error is null or stage='scrape'").select("msg_no", "error", "stage", "attempts")


ORACLES["o_acc_compounds"] = "select query, cast(cid as varchar) external_id from (select *, row_number() over (partition by cid order by msg_no desc) rn from o_routed where error is null) where rn=1"
ORACLES["o_acc_xref"] = """
select product_id, external_id, formula from (select source_item_id product_id, cast(cid as varchar) external_id, molecular_formula formula, row_number() over (partition by source_item_id, cid order by msg_no desc) rn
 from o_routed where error is null and source_item_id is not null) where rn=1
"""


@entry("T05_persist_batch", "select key, error, stage, query from o_dead")
def _(t):
    def g(k):
        return F.get_json_object("value", "$." + k).alias(k)

    return _read(t, "dead_letters").select("key", g("error"), g("stage"), g("query"))


@entry("M07_compounds_latest", "select * from o_acc_compounds")
def _(t):
    return worker.latest(t.spark, run_once(t), "compounds", up.COMPOUND_KEYS, "_order").select("query", "external_id")


@entry(
    "M06_xref_from_stream",
    f"select {_XREF_OUT}, formula from (select coalesce(t.product_id,s.product_id) product_id, coalesce(t.source,'pubchem') source, coalesce(t.external_id,s.external_id) external_id, t.cas, "
    f"case when t.product_id is null then 0.95::double else t.match_confidence end match_confidence, t.chem_id, case when s.product_id is not null then timestamp '{NOW}' else t.updated_at end updated_at, s.formula "
    "from fx_xref t full join o_acc_xref s on t.product_id=s.product_id and t.source='pubchem' and t.external_id=s.external_id)",
)
def _(t):
    changes = worker.latest(t.spark, run_once(t), "xref", up.XREF_KEYS, "_order")
    out = up.upsert(t.fx_xref, changes, up.XREF_KEYS, up.XREF_FROM_STREAM, now(), delta=True)
    formula = F.get_json_object("properties_ref", "$.MolecularFormula").alias("formula")
    return _xref_out(out).join(out.select(*up.XREF_KEYS, formula), up.XREF_KEYS)


@entry("T06_progress", "select key, query, cast(cid as varchar) cid from o_routed where error is null")
def _(t):
    # three micro-batches, run twice from one checkpoint: the second run finds nothing to do
    out = scratch_path(t.spark, "worker")
    requests = _requests(t, files=3)
    _run(t, out, requests)
    _run(t, out, requests)
    return worker.read_log(t.spark, out, "results").select(
        "key", F.get_json_object("value", "$.query").alias("query"), F.get_json_object("value", "$.cid").alias("cid")
    )


@entry("T07_request_dedupe", "select key, min(value) as value from fx_requests group by key")
def _(t):
    return dispatch.dedupe_requests(t.fx_requests.select("key", "value"))


@entry("T08_activity_stream", "select strftime(time_bucket(interval '30 minutes', ts),'%Y-%m-%d %H:%M:%S') window_start, event_type, count(*)::bigint n from events group by 1,2")
def _(t):
    events = _stream(t).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = worker.activity_stream(events, "event_type", "ts")
    out = scratch_path(t.spark, "activity")

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/counts/batch={batch_id}")

    q = counts.writeStream.outputMode("update").option("checkpointLocation", out + "-checkpoint").foreachBatch(write)
    q.trigger(availableNow=True).start().awaitTermination()
    last = worker.latest(t.spark, out, "counts", ["window_start", "event_type"])
    return last.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@entry("T09_stream_metrics", "select key, true timed from o_routed where error is null")
def _(t):
    ms = F.get_json_object("value", "$.latency_ms").cast("double")
    return _read(t, "results").select("key", (ms >= 0).alias("timed"))


@entry("L3_stream_enrich", "select key, error from o_routed")
def _(t):
    ok = _read(t, "results").select("key", F.lit(None).cast("string").alias("error"))
    bad = _read(t, "dead_letters").select("key", F.get_json_object("value", "$.error").alias("error"))
    return ok.unionByName(bad)
