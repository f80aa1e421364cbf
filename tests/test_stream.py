"""The worker as a stream: equal to the batch form, every message once, restartable."""

import json

from pyspark.sql import functions as F

from compoundry.operators.dispatch import dedupe_requests
from compoundry.sources import messages
from compoundry.streaming import worker
from compoundry.streaming.lookup import lookup_index

COMPOUNDS = [
    (1, "Acetone", "67-64-1", "C3H6O", "58.08", "propan-2-one"),
    (2, "67-64-1", None, "X", "10", "decoy"),
    (3, "Heavy", None, "U9", "9000", None),
    (4, "Bare", None, "", "5", ""),
    (5, "Odd", None, "Y", "n/a", None),
]
REQUESTS = [
    ("a", '{"query":"acetone","hint":"name","source_item_id":7,"extra":[1]}'), ("b", '{"query":"67-64-1","hint":"CAS","source_item_id":7}'),
    ("c", '{"query":"heavy"}'), ("d", '{"query":"bare"}'), ("e", '{"query":"odd"}'), ("f", '{"query":"nothing"}'), ("g", "{bad"), ("h", "[1]"),
    ("i", '{"query":" "}'), ("j", '{"query":"ab"}'), ("k", '{"query":"12-3","hint":"cas"}'), ("l", "{}"), ("m", '{"query":"acetone"} x'),
    ("n", None),
]
WANT = {
    "a": None, "b": None, "c": "BAD_PROPERTY_RANGE", "d": "MISSING_CORE_PROPS", "e": None, "f": "NO_RESULT", "g": "BAD_JSON", "h": "BAD_JSON",
    "i": "EMPTY_QUERY", "j": "BAD_QUERY_LENGTH", "k": "INVALID_CAS", "l": "EMPTY_QUERY", "m": "BAD_JSON", "n": "BAD_JSON",
}


def index(spark):
    schema = "cid long, title string, cas string, molecular_formula string, molecular_weight string, iupac_name string"
    return lookup_index(spark.createDataFrame(COMPOUNDS, schema))


def feed(spark, path, rows, start=0):
    df = spark.createDataFrame([(start + i, k, v) for i, (k, v) in enumerate(rows)], "offset long, key string, value string")
    df.coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out):
    s = messages.request_stream(spark, {"format": "parquet", "path": path, "maxFilesPerTrigger": "1"}, "offset long, key string, value string")
    worker.run_worker(s, index(spark), out, out + "-cp", now=F.lit("2024-01-01").cast("timestamp")).awaitTermination()


def test_stream(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, path, REQUESTS)
    run(spark, path, out)
    read = lambda t: worker.read_log(spark, out, t)
    ends = {r.key: json.loads(r.value).get("error") for r in read("dead_letters").collect()}
    done = {r.key: json.loads(r.value) for r in read("results").collect()}
    assert {**ends, **dict.fromkeys(done)} == WANT and not set(ends) & set(done)
    assert done["b"]["cid"] == "1"  # the number wins over the name
    dead = {r.key: json.loads(r.value) for r in read("dead_letters").collect()}
    assert dead["f"] == {"query": "nothing", "error": "NO_RESULT", "stage": "scrape", "attempts": 1}
    assert dead["l"] == {"error": "EMPTY_QUERY", "stage": "validate", "attempts": 0}
    assert dead["g"] == {"error": "BAD_JSON", "raw": "{bad"}
    batch = worker.route(spark.createDataFrame([(i, *r) for i, r in enumerate(REQUESTS)], "offset long, key string, value string"), index(spark))
    assert {r.key: r.error for r in batch.collect()} == WANT
    # a restart changes nothing; new input goes to a new batch, and the last query of a compound stays
    run(spark, path, out)
    assert read("results").count() == len(done)
    feed(spark, path, [("z", '{"query":"ACETONE","source_item_id":8}')], 100)
    run(spark, path, out)
    latest = worker.latest(spark, out, "compounds", ["source", "external_id"], "_order")
    assert {r.external_id: r.query for r in latest.collect()} == {"1": "ACETONE", "5": "odd"}
    links = worker.latest(spark, out, "xref", ["product_id", "source", "external_id"], "_order")
    assert {(r.product_id, r.external_id) for r in links.collect()} == {(7, "1"), (8, "1")}
    assert read("lookup_log").filter("status='error'").count() == 1


def test_replayed_batch_overwrites(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.createDataFrame([(i, *r) for i, r in enumerate(REQUESTS)], "offset long, key string, value string")
    for _ in range(2):
        worker.persist_batch(batch, 0, index(spark), out, "offset")
    assert worker.read_log(spark, out, "results").count() + worker.read_log(spark, out, "dead_letters").count() == len(REQUESTS)


def test_dedupe_on_a_stream(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.sql("select timestamp'2024-01-01 00:00:00' ts, key from values ('a'),('a'),('b') t(key)").write.parquet(path)
    s = spark.readStream.schema("ts timestamp, key string").parquet(path).withWatermark("ts", "1 hour")
    q = dedupe_requests(s).writeStream.format("parquet").option("checkpointLocation", out + "-cp").trigger(availableNow=True).start(out)
    q.awaitTermination()
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_fold_keeps_what_latest_shows(spark, tmp_path):
    out = str(tmp_path)

    def batch(n, rows):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.parquet(f"{out}/t/batch={n}")

    def now():
        return sorted(map(tuple, worker.latest(spark, out, "t", ["k"]).select("k", "v").collect()))

    worker.fold(spark, out, "t", ["k"])
    batch(0, [("a", 1), ("b", 1)])
    batch(1, [("b", 2), ("c", 2)])
    before = now()
    reader = worker.latest(spark, out, "t", ["k"]).select("k", "v")
    worker.fold(spark, out, "t", ["k"])
    assert now() == before == [("a", 1), ("b", 2), ("c", 2)]
    assert sorted(map(tuple, reader.collect())) == before  # opened before the fold
    batch(2, [("a", 3)])
    assert now() == [("a", 3), ("b", 2), ("c", 2)]
    reader = worker.latest(spark, out, "t", ["k"]).select("k", "v")
    worker.fold(spark, out, "t", ["k"])
    assert now() == [("a", 3), ("b", 2), ("c", 2)] == sorted(map(tuple, reader.collect()))
    assert {p.name for p in (tmp_path / "t").iterdir()} == {"batch=2"}
    worker.fold(spark, out, "t", ["k"])  # nothing new
    (tmp_path / "t_state" / "batch=7").mkdir()  # of a fold that was cut off
    assert now() == [("a", 3), ("b", 2), ("c", 2)]


def test_worker_order_and_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3)], "offset long, partition int, timestamp long")
    assert df.select(worker.ordered_by(df, worker.ORDER).alias("o")).first().o == (3, 2, 1)
    assert df.select(worker.ordered_by(df, "offset").alias("o")).first().o == 1


def test_append_only_sink_gets_a_replayed_batch_once(spark, tmp_path):
    """The run ends between sink and checkpoint; the batch comes again and adds nothing."""
    path, out, sent = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "sent")
    feed(spark, path, REQUESTS)
    feed(spark, path, [("x", '{"query":"acetone"}')], start=50)

    def append(df, name, batch_id):
        df.write.mode("append").parquet(f"{sent}/{name}")

    def work(sink):
        s = messages.request_stream(spark, {"format": "parquet", "path": path, "maxFilesPerTrigger": "1"}, "offset long, key string, value string")
        worker.run_worker(s, index(spark), out, out + "-cp", now=F.lit("2024-01-01").cast("timestamp"), sink=sink).awaitTermination()

    safe = worker.once(append, str(tmp_path / "ledger"))

    def lost(df, name, batch_id):
        safe(df, name, batch_id)
        if name == "dead_letters" and batch_id == 1:
            raise RuntimeError("the run ends here")

    try:
        work(lost)
    except Exception as error:
        assert "the run ends here" in str(error)
    assert len(list((tmp_path / "out-cp" / "commits").glob("[0-9]*"))) == 1  # the second batch isn't committed
    work(safe)
    work(safe)
    got = sorted(r.key for t in ("results", "dead_letters") for r in spark.read.parquet(f"{sent}/{t}").collect())
    assert got == sorted([k for k, _ in REQUESTS] + ["x"])


def test_requests_are_deduplicated_across_batches_and_restarts(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def feed_at(second, *keys):
        rows = [(f"2024-01-01 00:00:{second:02d}", k, f"{k}{second}") for k in keys]
        spark.createDataFrame(rows, "ts string, key string, value string").selectExpr(
            "cast(ts as timestamp) ts", "key", "value").coalesce(1).write.mode("append").parquet(path)

    def work():
        s = messages.request_stream(spark, {"format": "parquet", "path": path, "maxFilesPerTrigger": "1"}, "ts timestamp, key string, value string")
        q = dedupe_requests(s.withWatermark("ts", "1 hour")).writeStream.format("parquet").option("checkpointLocation", out + "-cp")
        q.trigger(availableNow=True).start(out).awaitTermination()

    feed_at(1, "a", "b", "a")
    feed_at(2, "a", "c")
    feed_at(3, "b", "d")
    work()
    feed_at(4, "a", "d", "e")
    work()
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d", "e"]
