"""Sources, sinks, scalar functions and row filters: S01-S12, F01-F27, P01-P07."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import patterns as P
from ..functions import cas, jsons, sheets, text, trigram
from ..operators import predicates, seed
from ..session import scratch_path
from ..sources import documents, messages, staging
from ..streaming.lookup import enrich_lookup, lookup_index
from ..streaming.worker import route
from .catalog import entry, now
from .fixtures import ORACLES

CAS = "[0-9]{2,7}-[0-9]{2}-[0-9]"
SHAPE = f"^{CAS}$"
# Words and marks that say nothing about the substance, as the oracles read them.
NOISE = (
    r"\b[0-9]{1,3}\s*%(?:\s*(?:w/v|v/v))?\b|\b(?:ml|l|kg|g|lb|gal|drum|tote|pail|bottle|case|kit|refill|cartridge)s?\b"
    r"|\b(?:acs|tech(?:nical)?|reagent|usp|nf|bp|fcc|food|industrial|anhydrous|solution|aq\.?|conc(?:entrated)?)\b|[®™]"
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, {q(NOISE)}, ' ', 'gi'), '\\s+', ' ', 'g'))"


def digits_sql(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


def hyphen_sql(c: str) -> str:
    g = digits_sql(c)
    return f"left({g}, length({g})-3) || '-' || substr({g}, length({g})-2, 2) || '-' || right({g}, 1)"


def check_sql(c: str) -> str:
    g = digits_sql(c)
    return (
        f"(length({g}) between 5 and 10 and list_sum(list_transform(range(1, length({g})), "
        f"lambda k_: k_ * cast(substr(reverse(left({g}, length({g})-1)), k_, 1) as int))) % 10 = cast(right({g}, 1) as int))"
    )


def norm_sql(c: str) -> str:
    return f"case when length({digits_sql(c)}) between 5 and 10 then case when {check_sql(c)} then {hyphen_sql(c)} end end"


def title_sql(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def grams_sql(c: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return (
        f"list_distinct(flatten(list_transform({words}, lambda w: list_transform(range(1, length(w)+2), "
        "lambda i: substr('  ' || w || ' ', i, 3)))))"
    )


def sim_sql(a: str, b: str) -> str:
    inter = f"len(list_intersect({a}, {b}))"
    return f"case when len({a})+len({b})={inter} then 0.0 else cast({inter} as double)/(len({a})+len({b})-{inter}) end"


# F-functions over the item table -------------------------------------------------------------------

ITEM = "select source_item_id"
ITEM_TAIL = " from fx_items"


def _item(t, *cols):
    return t.fx_items.select("source_item_id", *cols)


@entry("F01_normalize_name", f"{ITEM}, case when name<>'' then {clean_sql('name')} end v{ITEM_TAIL}")
def _(t):
    return _item(t, text.normalize_name(F.col("name")).alias("v"))


@entry("F02_strip_noise_name", f"{ITEM}, case when name<>'' then {clean_sql('lower(name)')} end v{ITEM_TAIL}")
def _(t):
    return _item(t, text.strip_noise_name(F.col("name")).alias("v"))


@entry(
    "F03_normalize_cas",
    f"{ITEM}, case when length({digits_sql('sku')}) between 5 and 10 then {hyphen_sql('sku')} end a, "
    f"case when length({digits_sql('cas')}) between 5 and 10 then {hyphen_sql('cas')} end b{ITEM_TAIL}",
)
def _(t):
    return _item(t, cas.normalize_cas(F.col("sku")).alias("a"), cas.normalize_cas(F.col("cas")).alias("b"))


@entry(
    "F04_cas_is_valid",
    f"select p_partkey, coalesce(case when length({digits_sql('x')}) between 5 and 10 then {check_sql('x')} end, false) ok "
    "from (select p_partkey, case when p_size<40 then cast(p_partkey*37 as varchar)||'-'||lpad(cast(p_size as varchar),2,'0')||'-'||cast(p_partkey%10 as varchar) end x from part)",
)
def _(t):
    x = F.when(
        F.col("p_size") < 40,
        F.concat((F.col("p_partkey") * 37).cast("string"), F.lit("-"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("-"), (F.col("p_partkey") % 10).cast("string")),
    )
    return t.part.select("p_partkey", cas.cas_is_valid(x).alias("ok"))


@entry(
    "F05_cas_normalize",
    f"select doc_id, l_linenumber, {norm_sql('a')} a, {norm_sql('b')} b from (select doc_id, l_linenumber, CAS[pk] a, "
    "'x '||cast(10+pk%90 as varchar)||'11'||cast(sk%10 as varchar) b from fx_sds_src)",
)
def _(t):
    src = t.spark.sql(_sds_cas(t))
    return src.select("doc_id", "l_linenumber", cas.cas_normalize(F.col("a")).alias("a"), cas.cas_normalize(F.col("b")).alias("b"))


def _sds_cas(t):
    from .fixtures import sql

    return sql(
        "spark",
        "select doc_id, l_linenumber, CAS[pk] a, concat('x ',cast(10+pk%90 as string),'11',cast(sk%10 as string)) b from fx_sds_src",
        t.dir,
    )


@entry(
    "F06_is_cas_shaped",
    f"{ITEM}, regexp_matches(cas, {q(SHAPE)}) a, regexp_matches(sku, {q(SHAPE)}) b{ITEM_TAIL}",
)
def _(t):
    return _item(t, cas.is_cas_shaped(F.col("cas")).alias("a"), cas.is_cas_shaped(F.col("sku")).alias("b"))


@entry(
    "F07_extract_cas_bounded",
    f"select doc_id, page_no, array_to_string(regexp_extract_all(text, '(?:^|[^0-9])({CAS})(?:[^0-9]|$)', 1), ';') v from fx_sds_pages",
)
def _(t):
    return t.fx_sds_pages.select("doc_id", "page_no", F.array_join(cas.extract_cas_bounded(F.col("text")), ";").alias("v"))


@entry("F08_extract_cas_loose", f"{ITEM}, array_to_string(regexp_extract_all(raw, '{CAS}'), ';') v{ITEM_TAIL}")
def _(t):
    return _item(t, F.array_join(cas.extract_cas_loose(F.col("raw")), ";").alias("v"))


CONC = r"(?:([0-9]+(?:\.[0-9]+)?)\s*(?:-|to|–)\s*([0-9]+(?:\.[0-9]+)?))\s*%|\b([0-9]+(?:\.[0-9]+)?)\s*%"


def conc_sql(c: str) -> str:
    def g(i):
        return f"cast(nullif(regexp_extract({c}, {q(CONC)}, {i}), '') as double)"

    return (
        f"coalesce({g(1)},{g(3)}) conc_low, coalesce({g(2)},{g(3)}) conc_high, "
        f"case when coalesce({g(1)},{g(3)}) is not null then '%' end conc_units"
    )


@entry("F09_parse_concentration", f"select doc_id, l_linenumber, {conc_sql('txt')} from fx_sds_parts")
def _(t):
    c = sheets.parse_concentration(F.col("txt"))
    return t.fx_sds_parts.select("doc_id", "l_linenumber", c.alias("c")).select(
        "doc_id", "l_linenumber", F.col("c.low").alias("conc_low"), F.col("c.high").alias("conc_high"), F.col("c.unit").alias("conc_units")
    )


@entry("F09_parse_concentration_prose", f"select doc_id, {conc_sql('text')} from documents")
def _(t):
    c = sheets.parse_concentration(F.col("text"))
    return t.documents.select("doc_id", c.alias("c")).select(
        "doc_id", F.col("c.low").alias("conc_low"), F.col("c.high").alias("conc_high"), F.col("c.unit").alias("conc_units")
    )


@entry("F10_section_tag", r"select doc_id, l_linenumber, upper(nullif(regexp_extract(txt, '(?i)\bSECTION\s*[0-9]+\b'), '')) v from fx_sds_parts")
def _(t):
    return t.fx_sds_parts.select("doc_id", "l_linenumber", sheets.section_tag(F.col("txt")).alias("v"))


@entry("F11_h_codes", r"select doc_id, page_no, array_to_string(regexp_extract_all(text, '\bH[0-9]{3}[A-Z]?\b'), ';') v from fx_sds_pages")
def _(t):
    return t.fx_sds_pages.select("doc_id", "page_no", F.array_join(sheets.h_codes(F.col("text")), ";").alias("v"))


@entry("F12_p_codes", r"select doc_id, page_no, array_to_string(regexp_extract_all(text, '\bP[0-9]{3}[A-Z]?(?:\+P[0-9]{3}[A-Z]?)?\b'), ';') v from fx_sds_pages")
def _(t):
    return t.fx_sds_pages.select("doc_id", "page_no", F.array_join(sheets.p_codes(F.col("text")), ";").alias("v"))


@entry("F13_signal_words", r"select doc_id, page_no, upper(array_to_string(regexp_extract_all(text, '(?i)\b(DANGER|WARNING)\b'), ';')) v from fx_sds_pages")
def _(t):
    return t.fx_sds_pages.select("doc_id", "page_no", F.array_join(sheets.signal_words(F.col("text")), ";").alias("v"))


@entry(
    "F14_component_name",
    rf"select doc_id, l_linenumber, regexp_replace(split_part(txt, regexp_extract(txt, '{CAS}'), 1), '^[ ,;:-]+|[ ,;:-]+$', '', 'g') v from fx_sds_parts",
)
def _(t):
    number = F.regexp_extract("txt", P.CAS_TOKEN, 0)
    return t.fx_sds_parts.select("doc_id", "l_linenumber", sheets.component_name(F.col("txt"), number).alias("v"))


@entry(
    "F15_trigram_similarity",
    f"select doc_id, round({sim_sql('a', 'b')}, 6) v from (select doc_id, {grams_sql('title')} a, {grams_sql('filename')} b from fx_docs)",
)
def _(t):
    return t.fx_docs.select("doc_id", F.round(trigram.trigram_similarity(F.col("title"), F.col("filename")), 6).alias("v"))


@entry(
    "F16_request_key",
    "select source_item_id, query, hint, 'pubchem|'||lower(coalesce(nullif(hint,''),'name'))||'|'||coalesce(cast(source_item_id as varchar),'None')||'|'||lower(trim(query)) k from fx_log",
)
def _(t):
    return t.fx_log.select(
        "source_item_id", "query", "hint", text.request_key(F.col("hint"), F.col("source_item_id"), F.col("query")).alias("k")
    )


@entry(
    "F17_sanitize_json",
    "select event_id, case when event_type='error' then null when event_type='view' then null else round(value,6) end a, "
    "strftime(ts,'%Y-%m-%dT%H:%M:%S')||case when strftime(ts,'%f')='000000' then '' else '.'||strftime(ts,'%f') end b from events",
)
def _(t):
    bad = F.when(F.col("event_type") == "error", float("nan")).when(F.col("event_type") == "view", float("inf")).otherwise(F.col("value"))
    df = t.events.select("event_id", bad.alias("a"), F.col("ts").alias("b"))
    js = jsons.row_json(df)
    return df.select(
        "event_id", F.round(F.get_json_object(js, "$.a").cast("double"), 6).alias("a"), F.get_json_object(js, "$.b").alias("b")
    )


@entry(
    "F18_clean_text",
    "select Title t, CID c, nullif(trim(query_name),'') a, lower(nullif(trim(query_hint),'')) b from fx_results",
)
def _(t):
    return t.fx_results.select(
        F.col("Title").alias("t"), F.col("CID").alias("c"),
        text.clean_text(F.col("query_name")).alias("a"), text.clean_text(F.col("query_hint"), lower=True).alias("b"),
    )


@entry("F19_first_non_empty", f"{ITEM}, coalesce(nullif(cas,''), nullif(name,''), nullif(sku,'')) v{ITEM_TAIL}")
def _(t):
    return _item(t, text.first_non_empty(F.col("cas"), F.col("name"), F.col("sku")).alias("v"))


@entry(
    "F20_json_text",
    "select external_id, try_cast(nullif(json_extract_string(properties,'$.CID'),'') as bigint) cid, nullif(json_extract_string(properties,'$.Title'),'') title, "
    "nullif(json_extract_string(properties,'$.MolecularFormula'),'') formula, try_cast(nullif(json_extract_string(properties,'$.MolecularWeight'),'') as double) weight from fx_compounds",
)
def _(t):
    p = F.col("properties")
    return t.fx_compounds.select(
        "external_id", jsons.json_text(p, "CID", "bigint").alias("cid"), jsons.json_text(p, "Title").alias("title"),
        jsons.json_text(p, "MolecularFormula").alias("formula"), jsons.json_text(p, "MolecularWeight", "double").alias("weight"),
    )


@entry(
    "F21_json_text_array",
    "select external_id, coalesce(array_to_string(json_extract_string(properties,'$.Synonyms[*]'),';'),'') v, coalesce(len(json_extract_string(properties,'$.Synonyms[*]')),0)::int n from fx_compounds",
)
def _(t):
    a = jsons.json_text_array(F.col("properties"), "Synonyms")
    return t.fx_compounds.select("external_id", F.array_join(a, ";").alias("v"), F.size(a).alias("n"))


@entry(
    "F22_json_each_text",
    "select source_item_id, k as key, json_extract_string(raw, '$.\"'||k||'\"') as value from (select source_item_id, raw, unnest(json_keys(raw)) k from fx_items)",
)
def _(t):
    return jsons.json_each_text(t.fx_items.select("source_item_id", "raw"), "raw").drop("raw")


@entry("F23_pg_initcap", f"{ITEM}, {title_sql('name')} v{ITEM_TAIL}")
def _(t):
    return _item(t, text.title_case(F.col("name")).alias("v"))


@entry(
    "F24_first_property",
    "select external_id, cast(json_extract_string(b,'$.PropertyTable.Properties[0].CID') as bigint) cid, json_extract_string(b,'$.PropertyTable.Properties[0].MolecularFormula') formula, "
    "case when json_extract(b,'$.PropertyTable.Properties[0]') is not null then b end raw from (select external_id, case when source='other' then '{\"PropertyTable\":{\"Properties\":[]}}' "
    "else '{\"PropertyTable\":{\"Properties\":[{\"CID\":'||external_id||',\"MolecularFormula\":\"H2O\"},{\"CID\":1}]}}' end b from fx_compounds)",
)
def _(t):
    body = F.when(F.col("source") == "other", '{"PropertyTable":{"Properties":[]}}').otherwise(
        F.concat(F.lit('{"PropertyTable":{"Properties":[{"CID":'), "external_id", F.lit(',"MolecularFormula":"H2O"},{"CID":1}]}}'))
    )
    return t.fx_compounds.select("external_id", jsons.first_property(body).alias("p")).select(
        "external_id", F.col("p.CID").alias("cid"), F.col("p.MolecularFormula").alias("formula"), F.col("p._raw").alias("raw")
    )


COMMON = ",".join(q(n) for n in P.COMMON_NAMES)
PRIORITY = "case when regexp_matches({q}, '" + SHAPE + "') then 1 when lower({q}) in (" + COMMON + ") then 2 else 3 end"


@entry("F25_priority_class", f"select source_item_id, query, {PRIORITY.replace('{q}', 'query')} v from (select source_item_id, query from fx_log union all select source_item_id, name from fx_items)")
def _(t):
    both = t.fx_log.select("source_item_id", "query").union(t.fx_items.select("source_item_id", "name"))
    return both.select("source_item_id", "query", text.priority_class(F.col("query")).alias("v"))


@entry("F26_hint_normalize", "select source_item_id, query, lower(coalesce(nullif(hint,''),'name')) a, lower(coalesce(nullif(nullif(hint,'Name'),''),'auto')) b from fx_log")
def _(t):
    return t.fx_log.select(
        "source_item_id", "query", text.hint_normalize(F.col("hint"), "name").alias("a"),
        text.hint_normalize(F.nullif("hint", F.lit("Name")), "auto").alias("b"),
    )


@entry(
    "F27_seed_query_hint",
    f"select id source_item_id, coalesce(nullif(cas,''),nullif(name,'')) query, case when regexp_matches(cas,'{SHAPE}') then 'cas' else 'name' end hint "
    "from fx_staging where coalesce(nullif(cas,''),nullif(name,'')) is not null",
)
def _(t):
    return seed.seed_query_hint(t.fx_staging)


# P: filters ----------------------------------------------------------------------------------------

ORACLES["o_clean"] = f"select source_item_id, sku, name, cas, raw, case when name<>'' then {clean_sql('lower(name)')} end clean from fx_items"
CHEM = q(P.CHEMICAL_WORDS)


@entry("P01_chemical_like", f"select source_item_id, clean from o_clean where length(clean)>=3 and regexp_matches(clean, {CHEM}, 'i')")
def _(t):
    return predicates.chemical_like(t.fx_items).select("source_item_id", F.col("clean_name").alias("clean"))


@entry("P02_wide_name", "select source_item_id, clean from o_clean where length(clean)>=3")
def _(t):
    return predicates.wide_name(t.fx_items).select("source_item_id", F.col("clean_name").alias("clean"))


@entry(
    "P03_include_exclude",
    f"select source_item_id, name from fx_items where name<>'' and not regexp_matches(name, {q(P.NON_CHEMICAL_WORDS)}, 'i') and regexp_matches(name, {CHEM}, 'i')",
)
def _(t):
    return predicates.include_exclude(t.fx_items).select("source_item_id", "name")


ORACLES["o_decoded"] = """
select msg_no, key, value, json_valid(value) and starts_with(value,'{') ok,
 case when json_valid(value) and starts_with(value,'{') then json_extract_string(value,'$.query') end query,
 case when json_valid(value) and starts_with(value,'{') then json_extract_string(value,'$.hint') end hint,
 case when json_valid(value) and starts_with(value,'{') then try_cast(json_extract_string(value,'$.source_item_id') as bigint) end source_item_id
from fx_requests
"""
ORACLES["o_validated"] = f"""
select *, case when not ok then 'BAD_JSON' when trim(coalesce(query,''))='' then 'EMPTY_QUERY'
 when length(trim(query)) not between 3 and 200 then 'BAD_QUERY_LENGTH'
 when lower(coalesce(nullif(hint,''),'auto'))='cas' and not regexp_matches(trim(query),'{SHAPE}') then 'INVALID_CAS' end verr
from o_decoded
"""


@entry("P04_validate_request", "select msg_no, verr error from o_validated where ok")
def _(t):
    decoded = messages.decode_requests(t.fx_requests).filter(F.col("error").isNull()).drop("error")
    return predicates.validate_request(decoded).select("msg_no", "error")


ORACLES["o_gate"] = """
select cid, title, cas, molecular_formula, iupac_name, molecular_weight, case when cid is null then 'NO_RESULT'
 when coalesce(molecular_formula,'')='' and coalesce(iupac_name,'')='' then 'MISSING_CORE_PROPS'
 when try_cast(molecular_weight as double) not between 1 and 2000 then 'BAD_PROPERTY_RANGE' end error from fx_reference
"""


@entry("P05_quality_gate", "select cid, title, cas, error from o_gate")
def _(t):
    return predicates.quality_gate(t.fx_reference).select("cid", "title", "cas", "error")


@entry("P06_incomplete_rows", "select product_id, pubchem_cid, cas, name from o_staged where product_id is null or pubchem_cid is null "
       "order by product_id nulls last, pubchem_cid nulls last, cas nulls last, name nulls last, iupac_name nulls last, molecular_formula nulls last, molecular_weight nulls last limit 10")
def _(t):
    from .entries_batch import matched

    return predicates.incomplete_rows(matched(t).staged()).select("product_id", "pubchem_cid", "cas", "name")


@entry(
    "P07_cas_and_named_items",
    f"select source_item_id, cas query, 'cas' hint from fx_items where regexp_matches(cas,'{SHAPE}') union all select source_item_id, name, 'name' from fx_items where name<>''",
)
def _(t):
    return predicates.cas_items(t.fx_items).unionByName(predicates.named_items(t.fx_items))


# S: sources and sinks ------------------------------------------------------------------------------


def _written_csv(t, df, label):
    path = scratch_path(t.spark, label)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@entry(
    "S01_mapped_stage",
    "select 'SKU'||cast(p_partkey as varchar) sku, p_name as name, p_brand brand, null::varchar cas, json_extract_string(r,'$.ItemNo') raw_no, json_extract_string(r,'$.Extra') raw_extra "
    "from (select *, json_object('ItemNo','SKU'||cast(p_partkey as varchar),'Extra',p_type) r from part)",
)
def _(t):
    sheet = t.part.select(
        F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("ItemNo"), F.col("p_name").alias("ItemName"),
        F.col("p_brand").alias("Brand"), F.col("p_type").alias("Extra"),
    )
    back = staging.read_text_table(t.spark, _written_csv(t, sheet, "sheet"), [])
    return staging.mapped_stage(back, P.ITEM_COLUMNS).select(
        "sku", "name", "brand", "cas", F.get_json_object("raw", "$.ItemNo").alias("raw_no"), F.get_json_object("raw", "$.Extra").alias("raw_extra")
    )


@entry("S02_raw_row_json", "select s_suppkey k, s_name a, cast(s_nationkey as varchar) b, 3::int n from supplier")
def _(t):
    df = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    raw = staging.raw_row_json(df)
    return raw.select(
        F.col("s_suppkey").alias("k"), F.get_json_object("raw", "$.s_name").alias("a"), F.get_json_object("raw", "$.s_nationkey").alias("b"),
        F.size(F.json_object_keys("raw")).alias("n"),
    )


@entry("S03_numeric_coerce", "select CID, Title, try_cast(MolecularWeight as double) w from fx_results")
def _(t):
    return staging.numeric_coerce(t.fx_results.select("CID", "Title", F.col("MolecularWeight").alias("w")), ["w"])


@entry(
    "S04_expected_columns",
    "select query_name, cast(source_item_id as varchar) source_item_id, CID, MolecularWeight, null::varchar InChI, null::varchar Synonyms from (select case when trim(query_name)<>'' then query_name else 'blank' end query_name, source_item_id, nullif(CID,'') CID, MolecularWeight from fx_results)",
)
def _(t):
    q_name = F.when(F.trim("query_name") != "", F.col("query_name")).otherwise("blank")
    df = t.fx_results.select("MolecularWeight", "CID", "source_item_id", q_name.alias("query_name"))
    back = staging.read_compound_results(t.spark, _written_csv(t, df, "results"))
    assert back.columns == P.RESULT_COLUMNS
    return back.select("query_name", "source_item_id", "CID", "MolecularWeight", "InChI", "Synonyms")


@entry(
    "S05_file_digest_load",
    "select sha256(text) file_sha256, arg_max(stem, path) title, arg_min(stem || '.pdf', path) filename from (select text, "
    "'doc ' || doc_id || '.v' || length(text) % 3 stem, '/in/' || source || '/doc ' || doc_id || '.v' || length(text) % 3 || '.pdf' path "
    "from documents where text is not null) group by 1",
)
def _(t):
    stem = F.concat(F.lit("doc "), F.col("doc_id"), F.lit(".v"), F.length("text") % 3)
    files = t.documents.filter(F.col("text").isNotNull()).select(
        F.concat(F.lit("/in/"), F.col("source"), F.lit("/"), stem, F.lit(".pdf")).alias("path"),
        F.col("text").cast("binary").alias("content"),
    )
    return documents.documents_of(files)


@entry(
    "S06_page_triage",
    r"select doc_id, tx<>'' has_text, length(tx)<30 needs_ocr, length(tx)::int n from (select doc_id, "
    r"regexp_replace(coalesce(text,''), '^[\s\x1C-\x1F\x{85}\p{Z}]+|[\s\x1C-\x1F\x{85}\p{Z}]+$', '', 'g') tx from documents)",
)
def _(t):
    return documents.page_triage(t.documents.select("doc_id", "text")).select("doc_id", "has_text", "needs_ocr", F.length("text").alias("n"))


ORACLES["o_index"] = """
select kind, key, cid, molecular_formula, molecular_weight, iupac_name from (
 select *, row_number() over (partition by kind, key order by cid, molecular_formula nulls last, molecular_weight nulls last, iupac_name nulls last) rn from (
  select 'name' kind, lower(trim(title)) key, cid, molecular_formula, molecular_weight, iupac_name from fx_reference where cid is not null and trim(title)<>''
  union all select 'cas', cas, cid, molecular_formula, molecular_weight, iupac_name from fx_reference where cid is not null and cas is not null)) where rn=1
"""
ORACLES["o_enriched"] = f"""
select v.*, coalesce(c.cid, n.cid) cid, case when c.cid is not null then c.molecular_formula else n.molecular_formula end molecular_formula,
 case when c.cid is not null then c.molecular_weight else n.molecular_weight end molecular_weight,
 case when c.cid is not null then c.iupac_name else n.iupac_name end iupac_name
from o_validated v left join o_index n on n.kind='name' and n.key=lower(trim(v.query)) and v.verr is null
 left join o_index c on c.kind='cas' and c.key=trim(v.query) and regexp_matches(trim(v.query),'{SHAPE}') and v.verr is null
"""
ORACLES["o_routed"] = """
select *, coalesce(verr, gerr) error, case when verr is not null and verr<>'BAD_JSON' then 'validate' when gerr is not null then 'scrape' end stage,
 case when verr is not null and verr<>'BAD_JSON' then 0 when gerr is not null then 1 end attempts
from (select *, case when verr is not null then null when cid is null then 'NO_RESULT'
 when coalesce(molecular_formula,'')='' and coalesce(iupac_name,'')='' then 'MISSING_CORE_PROPS'
 when try_cast(molecular_weight as double) not between 1 and 2000 then 'BAD_PROPERTY_RANGE' end gerr from o_enriched)
"""


def reference_index(t):
    return lookup_index(t.fx_reference)


def routed(t):
    return route(t.fx_requests, reference_index(t))


@entry("J18_enrich_lookup", "select msg_no, cid, molecular_formula, molecular_weight, iupac_name from o_enriched where verr is null")
def _(t):
    ok = messages.decode_requests(t.fx_requests).filter(F.col("error").isNull())
    ok = predicates.validate_request(ok).filter(F.col("error").isNull())
    return enrich_lookup(ok, reference_index(t)).select("msg_no", "cid", "molecular_formula", "molecular_weight", "iupac_name")


@entry(
    "S08_result_messages",
    "select key, query, 'pubchem' source, cast(cid as varchar) cid, molecular_formula mf, molecular_weight mw, iupac_name, '2024-06-01T00:00:00Z' ts from o_routed where error is null",
)
def _(t):
    ok = routed(t).filter(F.col("error").isNull())
    m = messages.result_messages(ok, now())

    def g(k):
        return F.get_json_object("value", "$." + k)

    return m.select(
        "key", g("query").alias("query"), g("source").alias("source"), g("cid").alias("cid"), g("molecular_formula").alias("mf"),
        g("molecular_weight").alias("mw"), g("iupac_name").alias("iupac_name"), g("ts").alias("ts"),
    )


ORACLES["o_dead"] = """
select key, error, stage, cast(attempts as varchar) attempts, query, case when error='BAD_JSON' then value end raw from o_routed where error is not null
"""


@entry("S09_dead_letters", "select * from o_dead")
def _(t):
    def g(k):
        return F.get_json_object("value", "$." + k).alias(k)

    return messages.dead_letters(routed(t)).select("key", g("error"), g("stage"), g("attempts"), g("query"), g("raw"))


@entry(
    "S10_request_messages",
    "select 'pubchem|'||lower(hint)||'|'||coalesce(cast(source_item_id as varchar),'None')||'|'||lower(trim(query)) key, trim(query) query, lower(hint) hint, source_item_id, '2024-06-01T00:00:00Z' ts from fx_log where trim(query)<>'' "
    "union all select trim(name), trim(name), 'name', source_item_id, '2024-06-01T00:00:00Z' from fx_items where trim(name)<>''",
)
def _(t):
    a = messages.request_messages(t.fx_log, now())
    b = messages.request_messages(predicates.named_items(t.fx_items), now(), requested_by="names")

    def g(k):
        return F.get_json_object("value", "$." + k)

    return a.unionByName(b).select("key", g("query").alias("query"), g("hint").alias("hint"), g("source_item_id").cast("bigint").alias("source_item_id"), g("ts").alias("ts"))


@entry(
    "S11_topic_peek",
    "select key, case when ok then query end query, case when ok then '{' else value end head from (select * from o_decoded order by msg_no limit 20)",
)
def _(t):
    peek = messages.topic_peek(t.fx_requests.select("msg_no", "key", "value"), 20, order="msg_no")
    head = F.when(F.col("value").startswith("{\n") | F.col("value").startswith("{ "), "{").otherwise(F.regexp_replace("value", r"^\[\s*1\s*\]$", "[1]"))
    return peek.select("key", F.get_json_object("value", "$.query").alias("query"), head.alias("head"))


@entry(
    "S12_lookup_log",
    "select 'compound_lookup' job_type, query, case when cid is null then 'error' else 'success' end status, case when cid is null then 'No result from PubChem' else 'CID='||cast(cid as varchar) end message, 1::int attempt from o_enriched where verr is null",
)
def _(t):
    looked = routed(t).filter(F.col("error").isNull() | (F.col("stage") == "scrape"))
    return messages.lookup_log(looked, now()).select("job_type", "query", "status", "message", "attempt")
