"""Gates on write, deletes along references, pattern tables that grow, requests once on a stream,
a reference that changes: C01-C08, C10, M08, T07, J18."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import patterns as P
from ..operators import dispatch, families, integrity, seed
from ..plans import flows
from ..schemas import CONSTRAINTS, Constraints
from ..session import scratch_path
from ..sources import messages
from ..sources.versions import Versions
from ..streaming import lookup, worker
from .catalog import entry, now
from .entries_published import published
from .fixtures import ORACLES, RELATIONS

RELATIONS["fx_relations"] = """
select cast(l_orderkey*10+l_linenumber as bigint) relationship_id,
 case when l_quantity=50 then cast(-1 as bigint) else cast(l_suppkey as bigint) end company_id,
 case when l_quantity=1 then cast(null as bigint) else cast(l_partkey as bigint) end product_id,
 case l_returnflag when 'N' then 'supplier' when 'A' then 'manufacturer' else 'reseller' end relationship_type
from {lineitem}
"""
ORACLES["o_gate_products"] = r"""
select *, concat_ws(',', case when not regexp_full_match(cas_number,'[0-9]{2,7}-[0-9]{2}-[0-9]') then 'cas_form' end,
 case when length(trim(name))=0 then 'name_text' end) rules from fx_products
"""
ORACLES["o_gate_relations"] = """
select relationship_id, company_id, product_id, relationship_type, concat_ws(',', company, product, absent, case when clean and n>1 then 'relationship_unique' end, kind) rules
from (select *, row_number() over (partition by company_id, product_id, relationship_type, clean order by relationship_id) n
 from (select *, coalesce(company, product, absent, kind) is null clean
  from (select r.*, case when company_id not in (select s_suppkey from supplier) then 'company_id_known' end company,
   case when product_id not in (select product_id from o_gate_products where rules='') then 'product_id_known' end product,
   case when product_id is null then 'product_id_present' end absent, case when relationship_type='reseller' then 'type_known' end kind from fx_relations r) a) b) c
"""


def _products(t):
    return integrity.gate(t.fx_products, CONSTRAINTS["products"], order=["product_id"])


def _relations(t):
    companies = t.supplier.select(F.col("s_suppkey").cast("bigint").alias("company_id"))
    parents = {"companies": companies, "products": _products(t)[0]}
    return integrity.gate(t.fx_relations, CONSTRAINTS["company_product_relationships"], parents, order=["relationship_id"])


def _named(df):
    return df.withColumn("rules", F.array_join("rules", ","))


@entry("C01_C06_gate_products", "select * from o_gate_products")
def _(t):
    accepted, violations = _products(t)
    return accepted.withColumn("rules", F.lit("")).unionByName(_named(violations))


@entry("C01_C08_gate_accepted", "select * exclude (rules) from o_gate_relations where rules=''")
def _(t):
    return _relations(t)[0]


@entry("C01_C08_gate_violations", "select * from o_gate_relations where rules<>''")
def _(t):
    return _named(_relations(t)[1])


_GONE = "doc_id % 6 = 2"
_OF_DOCUMENTS = {"sds_document": "fx_sds_docs", "sds_page": "fx_sds_pages", "sds_entity": "o_entities", "sds_component": "o_components",
                 "sds_hazard": "o_hazards", "sds_section": "o_sections"}


@entry("C10_cascade_documents", " union all ".join(
    f"select '{t}' tab, doc_id, count(*)::bigint n from {o} where not ({_GONE}) group by doc_id" for t, o in _OF_DOCUMENTS.items()))
def _(t):
    store = published(t, *[n for n in _OF_DOCUMENTS if n != "sds_page"])  # pages are always kept
    tables = {n: flows.current_pages(store) if n == "sds_page" else store.table(n) for n in _OF_DOCUMENTS}
    left = integrity.cascade(tables, {"sds_document": tables["sds_document"].filter(_GONE)})
    counts = [df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("tab"), "doc_id", "n") for n, df in left.items()]
    return integrity.union(counts)


#: Four levels, with two ways down to the last table.
_LEVELS = {
    "region": Constraints(key="r_regionkey"),
    "nation": Constraints(references={"n_regionkey": ("region", "r_regionkey")}, key="n_nationkey"),
    "customer": Constraints(references={"c_nationkey": ("nation", "n_nationkey")}, key="c_custkey"),
    "supplier": Constraints(references={"s_nationkey": ("nation", "n_nationkey")}, key="s_suppkey"),
    "orders": Constraints(references={"o_custkey": ("customer", "c_custkey")}, key="o_orderkey"),
    "lineitem": Constraints(references={"l_orderkey": ("orders", "o_orderkey"), "l_suppkey": ("supplier", "s_suppkey")}),
}


@entry(
    "C10_cascade_levels",
    "with lost as (select n_nationkey from nation where n_regionkey=1) select l_orderkey, l_linenumber, l_suppkey from lineitem where l_orderkey not in "
    "(select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_nationkey in (select n_nationkey from lost)) or o_orderstatus='P') "
    "and l_suppkey not in (select s_suppkey from supplier where s_nationkey in (select n_nationkey from lost))",
)
def _(t):
    tables = {n: getattr(t, n) for n in ("lineitem", "orders", "supplier", "customer", "nation", "region")}
    gone = {"region": t.region.filter("r_regionkey = 1"), "orders": t.orders.filter("o_orderstatus = 'P'")}
    return integrity.cascade(tables, gone, _LEVELS)["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")


def _text(value):
    return "'" + value.replace("'", "''") + "'"


RELATIONS["fx_family"] = "select cast(10+row_number() over (order by p_type) as int) family_id, case when p_type='PROMO' then 'Bases' else p_type end name, p_type pattern, cast(null as string) note from (select distinct p_type from {part}) x"


@entry(
    "M08_alias_insert",
    "with stored as (select distinct case when p_size<=9 then " + _text(P.ALIASES[0][0]) + " else '^'||p_name||'$' end pattern from part), "
    "fixed(pattern, replacement, hint) as (values " + ", ".join(f"({_text(a)}, {_text(b)}, {_text(c)})" for a, b, c, _ in P.ALIASES) + ") "
    "select pattern, 'own' replacement, 'name' hint from stored union all select * from fixed where pattern not in (select pattern from stored)",
)
def _(t):
    pattern = F.when(F.col("p_size") <= 9, P.ALIASES[0][0]).otherwise(F.concat(F.lit("^"), "p_name", F.lit("$"))).alias("pattern")
    stored = t.part.select(pattern).distinct().select("pattern", F.lit("own").alias("replacement"), F.lit("name").alias("hint"), F.lit(None).cast("string").alias("note"))
    return seed.with_fixed_aliases(stored).drop("note")


@entry(
    "M08_family_insert",
    "with fixed(i, name, pattern) as (values " + ", ".join(f"({i}, {_text(n)}, {_text(p)})" for i, n, p, _ in P.FAMILIES) + ") "
    "select family_id, name, pattern from fx_family union all select (row_number() over (order by i) + (select max(family_id) from fx_family))::int, name, pattern "
    "from fixed where name not in (select name from fx_family)",
)
def _(t):
    return families.with_fixed_families(t.fx_family).drop("note")


@entry(
    "J18_changing_reference",
    "select key, cid::varchar cid from o_routed where error is null and (msg_no % 2 = 1 or cid % 2 = 0)",
)
def _(t):
    """Compounds with an odd id are published between the two batches of one run."""
    source, out = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "answers")
    store = Versions(t.spark, scratch_path(t.spark, "reference"))
    requests = t.fx_requests.select("msg_no", F.col("ts").cast("timestamp").alias("ts"), "key", "value")
    for k in (0, 1):
        requests.filter(F.col("msg_no") % 2 == k).coalesce(1).write.mode("append").parquet(source)
    lookup.publish_index(store, t.fx_reference.filter("cid % 2 = 0"))

    def sink(df, name, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/sent/{name}/batch={batch_id}")
        if name == "dead_letters" and batch_id == 0:
            lookup.publish_index(store, t.fx_reference)

    stream = messages.request_stream(
        t.spark, {"format": "parquet", "path": source, "maxFilesPerTrigger": "1"}, schema=requests.schema)
    query = worker.run_worker(stream, lookup.current_index(store), out, out + "-checkpoint", order="msg_no", now=now(), sink=sink)
    query.awaitTermination()
    return t.spark.read.parquet(f"{out}/sent/results").select("key", F.get_json_object("value", "$.cid").alias("cid"))


@entry("T07_stream_dedupe", "select key, 1::bigint n, min(msg_no % 3)::bigint batch from fx_requests where key is not null group by key")
def _(t):
    """Three arrivals with repeated keys; the run stops after two of them and goes on from its checkpoint."""
    source, out = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "once")
    requests = t.fx_requests.filter("key is not null").select("msg_no", F.col("ts").cast("timestamp").alias("ts"), "key", "value")

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def arrive(k):
        requests.filter(F.col("msg_no") % 3 == k).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = messages.request_stream(
            t.spark, {"format": "parquet", "path": source, "maxFilesPerTrigger": "1"}, schema=requests.schema)
        once = dispatch.dedupe_requests(stream, event_time="ts", delay="400 days")
        query = once.writeStream.option("checkpointLocation", out + "-checkpoint").foreachBatch(write)
        query.trigger(availableNow=True).start().awaitTermination()

    arrive(0)
    arrive(1)
    run()
    arrive(2)
    run()
    seen = t.spark.read.parquet(out)
    return seen.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("msg_no") % 3).alias("batch"))
