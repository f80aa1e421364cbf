"""Safety-sheet mining and what is stored from it: X01-X05, W03, W04, A03, A07, A08, A11, A12, J14, J15, M03, M05, M09-M14, L5."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import patterns as P
from ..operators import registry, report, sheets
from ..operators import upsert as up
from ..plans import flows
from ..session import durable
from .catalog import entry, now
from .entries_batch import _XREF_OUT, _xref_out
from .entries_scalar import CAS, conc_sql, norm_sql
from .fixtures import NOW, ORACLES

BREAKS = r"(?:\r\n|[\n\x0B\x0C\r\x1C-\x1E\x{85}\x{2028}\x{2029}])"
ORACLES["o_lines"] = """
select doc_id, page_no, i line_no, l[i] line from (select doc_id, page_no, string_split(text,chr(10)) l from fx_sds_pages), unnest(range(1,len(l)+1)) t(i)
"""
ORACLES["o_carried"] = r"""
select *, last_value(tag ignore nulls) over (partition by doc_id order by page_no, line_no rows between unbounded preceding and current row) section
from (select *, upper(nullif(regexp_extract(line,'(?i)\bSECTION\s*[0-9]+\b'),'')) tag from o_lines)
"""
ORACLES["o_cas_hits"] = f"""
select doc_id, page_no, line_no, section, line, i ord, hits[i] value, {norm_sql('hits[i]')} norm
from (select *, regexp_extract_all(line,'(?:^|[^0-9])({CAS})(?:[^0-9]|$)',1) hits from o_carried), unnest(range(1,len(hits)+1)) t(i)
"""
ORACLES["o_signal_hits"] = r"""
select doc_id, page_no, line_no, section, i ord, upper(hits[i]) value
from (select *, regexp_extract_all(line,'(?i)\b(DANGER|WARNING)\b') hits from o_carried), unnest(range(1,len(hits)+1)) t(i)
"""
ORACLES["o_entities"] = """
with k as (
 select doc_id, page_no, section, 'CAS' entity_type, value, norm norm_value, line_no, ord from o_cas_hits
 union all select doc_id, page_no, section, 'SIGNAL', value, value, line_no, ord from o_signal_hits)
select doc_id, page_no, section, entity_type, value, norm_value from k where norm_value is null
union all select doc_id, page_no, section, entity_type, value, norm_value from (
 select *, row_number() over (partition by doc_id, entity_type, norm_value order by page_no, line_no, ord) rn from k where norm_value is not null) where rn=1
"""
ORACLES["o_components"] = f"""
select doc_id, page_no, nullif(nm,'') "name", value cas, cas_norm, name_key, conc_low, conc_high, conc_units from (
 select *, row_number() over (partition by doc_id, cas_norm, name_key order by page_no, line_no, ord) rn from (
  select *, coalesce(norm,'') cas_norm, lower(nm) name_key from (
   select *, regexp_replace(split_part(line,value,1),'^[ ,;:-]+|[ ,;:-]+$','','g') nm, {conc_sql('line')} from o_cas_hits))) where rn=1
"""
ORACLES["o_hazard_hits"] = r"""
select doc_id, page_no, line_no, section, trim(line) line, i ord, codes[i] code from (
 select *, list_concat(regexp_extract_all(line,'\bH[0-9]{3}[A-Z]?\b'), regexp_extract_all(line,'\bP[0-9]{3}[A-Z]?(?:\+P[0-9]{3}[A-Z]?)?\b')) codes from o_carried), unnest(range(1,len(codes)+1)) t(i)
"""
ORACLES["o_hazards"] = """
select f.doc_id, f.page_no, f.section, f.code, l.line statement from
 (select *, row_number() over (partition by doc_id, code order by page_no, line_no, ord) rn from o_hazard_hits) f join
 (select *, row_number() over (partition by doc_id, code order by page_no desc, line_no desc, ord desc) rn from o_hazard_hits) l
 on f.doc_id=l.doc_id and f.code=l.code and f.rn=1 and l.rn=1
"""
ORACLES["o_sections"] = r"""
with h as (select *, sum(case when regexp_matches(line,'(?i)^\s*(?:SECTION|SEC\.)\s*[0-9]{1,2}\s*[:.-]?\s*\S') then 1 else 0 end) over (partition by doc_id order by page_no, line_no) n from o_lines),
b as (select doc_id, n, arg_min(line, page_no*100000+line_no) head, string_agg(line, chr(10) order by page_no, line_no) body from h where n>0 group by 1,2),
s as (select doc_id, n, cast(regexp_extract(head,'(?i)(?:SECTION|SEC\.)\s*([0-9]{1,2})',1) as int) section_no, nullif(trim(regexp_extract(head,'(?i)^\s*(?:SECTION|SEC\.)\s*[0-9]{1,2}\s*[:.-]?\s*(.*)$',1)),'') title, trim(body) text from b)
select doc_id, section_no, arg_max(title, n) title, arg_max(text, n) text from s where section_no between 1 and 16 group by 1,2
"""


def lines_of(t, tagged=True, numbers=False):
    return sheets.mined_lines(t.fx_sds_pages, tagged=tagged, numbers=numbers)


@entry("X01_explode_lines", "select doc_id, page_no, line_no::int line_no, line from o_lines")
def _(t):
    return sheets.explode_lines(t.fx_sds_pages)


@entry(
    "X01_explode_lines_prose",
    f"select doc_id, i::int line_no, l[i] line from (select doc_id, regexp_split_to_array(regexp_replace(text,'{BREAKS}$',''),'{BREAKS}') l from documents where text<>''), unnest(range(1,len(l)+1)) t(i)",
)
def _(t):
    return sheets.explode_lines(t.documents.select("doc_id", F.lit(1).alias("page_no"), "text")).drop("page_no")


@entry("W04_carry_section", "select doc_id, page_no, section, line from o_carried")
def _(t):
    return sheets.carry_section(t.fx_sds_pages).select("doc_id", "page_no", "section", "line")


@entry("X02_extract_entities", "select * from o_entities")
def _(t):
    return sheets.extract_entities(lines_of(t))


@entry("X03_extract_components", "select * from o_components")
def _(t):
    return sheets.extract_components(lines_of(t, tagged=False, numbers=True))


@entry("X04_extract_hazards", "select * from o_hazards")
def _(t):
    return sheets.extract_hazards(lines_of(t))


@entry("X05_split_sections", "select * from o_sections")
def _(t):
    return sheets.split_sections(t.fx_sds_pages)


_PIVOT = ", ".join(f"max(case when s.section_no={i + 1} then s.text end) {c}" for i, c in enumerate(P.SECTION_COLUMNS))


@entry("A03_section_pivot", f"select d.doc_id, d.filename, {_PIVOT} from fx_sds_docs d left join o_sections s on s.doc_id=d.doc_id group by 1,2")
def _(t):
    return sheets.section_pivot(t.fx_sds_docs, sheets.split_sections(t.fx_sds_pages))


@entry(
    "A07_sds_summary",
    "select (select count(*) from fx_sds_docs)::bigint docs, (select count(*) from o_entities where entity_type='CAS')::bigint cas_rows, (select count(*) from o_components)::bigint components, "
    "(select count(*) from o_hazards)::bigint hazards, (select count(*) from fx_xref where source in ('cas','pubchem'))::bigint linked_products",
)
def _(t):
    lines = durable(lines_of(t, tagged=False), "lines")  # three readers, none of which asks for sections
    return report.sds_summary(
        t.fx_sds_docs, sheets.extract_entities(lines), sheets.extract_components(lines), sheets.extract_hazards(lines), t.fx_xref
    )


ORACLES["o_doc_cas"] = "select distinct d.product_id, e.norm_value cas from fx_sds_docs d join o_entities e using (doc_id) where d.product_id is not null and e.entity_type='CAS' and e.norm_value is not null"


@entry("A08_distinct_doc_cas", "select product_id, cas from o_doc_cas union all select null, cas from (select distinct norm_value cas from o_entities where entity_type='CAS' and norm_value is not null)")
def _(t):
    found = sheets.extract_entities(lines_of(t, tagged=False)).select("doc_id", "entity_type", "norm_value")
    entities = durable(found, "entities")  # two readers
    only = registry.distinct_cas(entities).select(F.lit(None).cast("bigint").alias("product_id"), "cas")
    return registry.distinct_doc_cas(t.fx_sds_docs, entities).unionByName(only)


@entry("A11_page_count", "select doc_id, count(*)::bigint pages from fx_sds_pages group by 1")
def _(t):
    return sheets.page_count(t.fx_sds_pages)


@entry("A12_document_text", "select doc_id, string_agg(text, chr(10) order by page_no) text from fx_sds_pages group by 1")
def _(t):
    return sheets.document_text(t.fx_sds_pages)


@entry("J14_unparsed_docs", "select o_orderkey+1 doc_id from orders where o_orderkey+1 not in (select doc_id from o_entities)")
def _(t):
    docs = t.orders.select((F.col("o_orderkey") + 1).alias("doc_id"))
    return sheets.unparsed_docs(docs, sheets.extract_entities(lines_of(t, tagged=False)))


ORACLES["o_main"] = """
select doc_id, cas_norm cas, "name", pct from (select *, coalesce(conc_high,conc_low,100) pct, row_number() over (partition by doc_id order by coalesce(conc_high,conc_low,100) desc, lower("name") nulls last, cas_norm) rn
 from o_components where cas_norm<>'') where rn=1
"""


@entry("W03_main_component", "select doc_id, cas, \"name\", pct from o_main")
def _(t):
    return sheets.main_component(sheets.extract_components(lines_of(t, tagged=False, numbers=True)))


@entry(
    "J15_backfill_cas",
    "select i.source_item_id, i.sku, coalesce(nullif(i.cas,''), m.cas, i.cas) cas from fx_items i left join (select product_id, cas from (select d.product_id, m.cas, row_number() over (partition by d.product_id order by m.pct desc, d.doc_id) rn "
    "from fx_sds_docs d join o_main m using (doc_id) where d.product_id is not null) where rn=1) m on m.product_id=i.source_item_id",
)
def _(t):
    main = sheets.main_component(sheets.extract_components(lines_of(t, tagged=False, numbers=True)))
    return sheets.backfill_cas(t.fx_items, t.fx_sds_docs, main).select("source_item_id", "sku", "cas")


ORACLES["o_cas_known"] = "select source, external_id, canonical_name from fx_registry union all select 'cas', cas, null from (select distinct norm_value cas from o_entities where entity_type='CAS' and norm_value is not null) e where not exists (select 1 from fx_registry r where r.source='cas' and r.external_id=e.cas)"


@entry("M03_registry_ensure_cas", "select * from o_cas_known")
def _(t):
    out = up.insert_only(t.fx_registry, registry.registry_for_numbers(sheets.extract_entities(lines_of(t))), up.REGISTRY_KEYS)
    return out.select("source", "external_id", "canonical_name")


ORACLES["o_xref_docs"] = f"""
select coalesce(t.product_id,s.product_id) product_id, coalesce(t.source,'cas') source, coalesce(t.external_id,s.cas) external_id, case when s.cas is not null then s.cas else t.cas end cas,
 greatest(t.match_confidence, case when s.cas is not null then 0.97::double end) match_confidence, t.chem_id, case when s.cas is not null then timestamp '{NOW}' else t.updated_at end updated_at
from fx_xref t full join o_doc_cas s on t.product_id=s.product_id and t.source='cas' and t.external_id=s.cas
"""


@entry("M05_xref_from_documents", f"select {_XREF_OUT} from o_xref_docs")
def _(t):
    src = registry.xref_from_documents(t.fx_sds_docs, sheets.extract_entities(lines_of(t)))
    return _xref_out(up.upsert(t.fx_xref, src, up.XREF_KEYS, up.XREF_FROM_DOCUMENTS, now()))


@entry(
    "M09_document_by_digest",
    "select coalesce(t.p_partkey,s.p_partkey) digest, case when s.p_partkey is not null then s.p_name else 'old' end title, case when t.p_partkey is not null then 'old.pdf' else s.p_name||'.pdf' end filename "
    "from (select * from part where p_size<=30) t full join (select * from part where p_type<>'PROMO') s on s.p_partkey=t.p_partkey",
)
def _(t):
    digest = F.sha2(F.col("p_partkey").cast("string"), 256).alias("file_sha256")
    target = t.part.filter("p_size<=30").select(digest, F.lit("old").alias("title"), F.lit("old.pdf").alias("filename"))
    source = t.part.filter("p_type<>'PROMO'").select(digest, F.col("p_name").alias("title"), F.concat("p_name", F.lit(".pdf")).alias("filename"))
    out = up.upsert(target, source, up.DOCUMENT_KEYS, up.DOCUMENT_BY_DIGEST)
    keys = t.part.select(digest, F.col("p_partkey").alias("digest"))
    return out.join(keys, "file_sha256").select("digest", "title", "filename")


@entry("M10_page_replace", "select doc_id, page_no, text, true has_text from fx_sds_pages union all select doc_id, 9, 'kept', false from fx_sds_docs")
def _(t):
    def page(df, no, text, has):
        return df.select("doc_id", no.cast("int").alias("page_no"), F.lit(has).alias("has_text"), F.lit(False).alias("ocr_used"), F.lit(None).cast("double").alias("ocr_conf"), text.alias("text"))

    target = page(t.fx_sds_docs, F.lit(9), F.lit("kept"), False).unionByName(
        page(t.fx_sds_pages.filter("page_no=1"), F.col("page_no"), F.lit("old"), False)
    )
    source = page(t.fx_sds_pages, F.col("page_no"), F.col("text"), True)
    return up.upsert(target, source, up.PAGE_KEYS, up.PAGE_REPLACE).select("doc_id", "page_no", "text", "has_text")


@entry(
    "M11_section_replace",
    "select coalesce(t.doc_id,s.doc_id) doc_id, coalesce(t.section_no,s.section_no)::int section_no, coalesce(case when s.section_no=1 then null else s.title end, t.title) title, coalesce(s.text,t.text) text "
    "from (select doc_id, unnest([1,16]) section_no, 'old' title, 'old' text from fx_sds_docs) t full join o_sections s on s.doc_id=t.doc_id and s.section_no=t.section_no",
)
def _(t):
    target = t.fx_sds_docs.select("doc_id", F.explode(F.array(F.lit(1), F.lit(16))).alias("section_no"), F.lit("old").alias("title"), F.lit("old").alias("text"))
    source = sheets.split_sections(t.fx_sds_pages).withColumn("title", F.when(F.col("section_no") != 1, F.col("title")))
    return up.upsert(target, source, up.SECTION_KEYS, up.SECTION_REPLACE)




@entry(
    "M12_entity_first",
    "with s as (select doc_id, 1 page_no, 'old' section, 'SIGNAL' entity_type, 'DANGER' value, 'DANGER' norm_value from (select distinct doc_id from fx_sds_src)) select * from s union all select e.* from o_entities e where not exists "
    "(select 1 from s where s.doc_id=e.doc_id and s.entity_type=e.entity_type and s.norm_value=e.norm_value)",
)
def _(t):
    stored = t.fx_sds_docs.select(
        "doc_id", F.lit(1).alias("page_no"), F.lit("old").alias("section"), F.lit("SIGNAL").alias("entity_type"), F.lit("DANGER").alias("value"), F.lit("DANGER").alias("norm_value")
    )
    return up.insert_only(stored, sheets.extract_entities(lines_of(t)), up.ENTITY_KEYS)


@entry(
    "M13_component_first",
    "with s as (select distinct doc_id, cas_norm, name_key from o_components where name_key like '%impurity%') select doc_id, cas_norm, name_key, 'old' origin from s union all "
    "select doc_id, cas_norm, name_key, 'new' from o_components c where not exists (select 1 from s where s.doc_id=c.doc_id and s.cas_norm=c.cas_norm and s.name_key=c.name_key)",
)
def _(t):
    found = durable(sheets.extract_components(lines_of(t, tagged=False, numbers=True)).select("doc_id", "cas_norm", "name_key"), "components")  # three readers
    stored = found.filter(F.col("name_key").contains("impurity")).withColumn("origin", F.lit("old"))
    return up.insert_only(stored, found.withColumn("origin", F.lit("new")), up.COMPONENT_KEYS)


@entry(
    "M14_hazard_last_statement",
    "with s as (select doc_id, 'P301+P310' code from (select distinct doc_id from fx_sds_src)) select coalesce(s.doc_id,h.doc_id) doc_id, coalesce(s.code,h.code) code, "
    "case when s.code is not null then 77 else h.page_no end::int page_no, case when s.code is not null then 'old' else h.section end section, coalesce(h.statement,'old') statement from s full join o_hazards h on h.doc_id=s.doc_id and h.code=s.code",
)
def _(t):
    stored = t.fx_sds_docs.select("doc_id", F.lit(77).alias("page_no"), F.lit("old").alias("section"), F.lit("P301+P310").alias("code"), F.lit("old").alias("statement"))
    out = up.upsert(stored, sheets.extract_hazards(lines_of(t)), up.HAZARD_KEYS, up.HAZARD_LAST_STATEMENT)
    return out.select("doc_id", "code", "page_no", "section", "statement")




def mined(t):
    # sheets named after numbers resemble no item, so documents keep the product they came with
    pages = durable(t.fx_sds_pages, "pages")  # stored tables in use; several steps read them
    docs = durable(t.fx_sds_docs, "docs")
    return flows.sds_mine(docs, pages, t.fx_items.drop("raw"), t.fx_xref, t.fx_registry, now())


@entry(
    "L5_sds_mine",
    "select x.product_id, x.source, x.external_id, x.cas, x.match_confidence, case when r.external_id is not null then 'cas:'||r.external_id else x.chem_id end chem_id "
    "from o_xref_docs x left join o_cas_known r on x.source='cas' and r.source='cas' and r.external_id=x.external_id",
)
def _(t):
    return mined(t)["product_chem_xref"].select("product_id", "source", "external_id", "cas", "match_confidence", "chem_id")


@entry(
    "L5_sds_mine_summary",
    "select (select count(*) from fx_sds_docs)::bigint docs, (select count(*) from o_entities where entity_type='CAS')::bigint cas_rows, (select count(*) from o_components)::bigint components, "
    "(select count(*) from o_hazards)::bigint hazards, (select count(*) from o_xref_docs)::bigint linked_products",
)
def _(t):
    return mined(t)["summary"]
