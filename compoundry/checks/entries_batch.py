"""Joins, aggregates, windows, unions, upserts, integrity checks and flows over catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import patterns as P
from .. import schemas
from ..operators import compounds as comp
from ..operators import dispatch, families, fuzzy, matching, quality, registry, report, seed
from ..operators import upsert as up
from ..plans import flows
from ..sources import staging
from .catalog import entry, now, num, stamp
from .entries_scalar import CAS, CHEM, PRIORITY, SHAPE, _written_csv, grams_sql, q, sim_sql, title_sql
from .fixtures import NOW, ORACLES

ALIAS_SQL = "(values " + ",".join(f"({q(p)},{q(r)},{q(h)})" for p, r, h, _ in P.ALIASES) + ") a(pattern, replacement, hint)"
FAMILY_SQL = "(values " + ",".join(f"({i},{q(p)})" for i, _, p, _ in P.FAMILIES) + ") f(family_id, pattern)"

# Oracles shared by several queries -----------------------------------------------------------------

ORACLES["o_linked"] = "select distinct product_id from fx_xref where source='pubchem'"
ORACLES["o_unlinked"] = "select i.* from fx_items i left join o_linked l on l.product_id=i.source_item_id where l.product_id is null"
ORACLES["o_found"] = f"""
select source_item_id, 'name' src, i-1 pos, regexp_extract_all(name,'{CAS}')[i] query from fx_items, unnest(range(1,len(regexp_extract_all(name,'{CAS}'))+1)) t(i)
union all
select source_item_id, 'sku', i-1, regexp_extract_all(sku,'{CAS}')[i] from fx_items, unnest(range(1,len(regexp_extract_all(sku,'{CAS}'))+1)) t(i)
"""
ORACLES["o_raw"] = f"""
select source_item_id, min(m) cas_in_raw from (
 select source_item_id, nullif(regexp_extract(lower(unnest(json_extract_string(raw,'$.*'))),'{CAS}'),'') m from fx_items) where m is not null group by 1
"""
ORACLES["o_alias"] = f"select source_item_id, a.replacement query, a.hint from fx_items join {ALIAS_SQL} on regexp_matches(lower(name), a.pattern)"
ORACLES["o_branches"] = f"""
select source_item_id, cas query, 'cas' hint, 1 b, 0 p from fx_items where regexp_matches(cas,'{SHAPE}')
union all select source_item_id, query, 'cas', 2, pos from o_found where src='name'
union all select source_item_id, query, 'cas', 3, pos from o_found where src='sku'
union all select source_item_id, cas_in_raw, 'cas', 4, 0 from o_raw
union all select source_item_id, query, hint, 5, 0 from o_alias
union all select source_item_id, {title_sql('clean')}, 'name', 6, 0 from o_clean where length(clean)>=3 and regexp_matches(clean,{CHEM},'i')
"""
ORACLES["o_branches_wide"] = f"""
select * from o_branches union all select source_item_id, {title_sql('clean')}, 'name', 7, 0 from o_clean where length(clean)>=3
"""
ORACLES["o_seed"] = "select source_item_id, query, hint, min(b*1048576+p) seq from o_branches group by 1,2,3"
ORACLES["o_seed_wide"] = "select source_item_id, query, hint, min(b*1048576+p) seq from o_branches_wide group by 1,2,3"
ORACLES["o_results"] = """
select nullif(trim(query_name),'') query_name, lower(nullif(trim(query_hint),'')) query_hint, source_item_id, nullif(trim(CID),'') cid, nullif(trim(Title),'') title,
 nullif(trim(IUPACName),'') iupac, nullif(trim(MolecularFormula),'') mf, try_cast(nullif(trim(MolecularWeight),'') as decimal(18,6)) mw, nullif(trim(CanonicalSMILES),'') smiles from fx_results
"""
_STAGED = "cid pubchem_cid, {cas} cas, title as name, iupac iupac_name, mf molecular_formula, mw molecular_weight, smiles canonical_smiles"
_CAS_OR_NULL = f"case when regexp_matches(query_name,'{SHAPE}') then query_name end"
ORACLES["o_explicit"] = f"select source_item_id product_id, {_STAGED.format(cas=_CAS_OR_NULL)} from o_results where source_item_id is not null"
ORACLES["o_by_cas"] = (
    f"select i.source_item_id product_id, {_STAGED.format(cas='r.query_name')} from o_results r join (select source_item_id, cas from fx_items) i "
    f"on i.cas=r.query_name and regexp_matches(r.query_name,'{SHAPE}') where r.source_item_id is null"
)
ORACLES["o_by_query"] = (
    f"select s.source_item_id product_id, {_STAGED.format(cas='null::varchar')} from o_results r join o_seed_wide s on lower(s.query)=lower(r.query_name) "
    f"where r.source_item_id is null and not regexp_matches(r.query_name,'{SHAPE}')"
)
ORACLES["o_staged"] = "select * from o_explicit union all select * from o_by_cas union all select * from o_by_query"
_STAGED_OUT = ["product_id", "pubchem_cid", "cas", "name", "iupac_name", "molecular_formula", "molecular_weight", "canonical_smiles"]


def _staged_out(df):
    return df.select(*[num(c) if c == "molecular_weight" else F.col(c) for c in _STAGED_OUT])


def _staged_sql(name):
    return "select " + ", ".join("round(cast(molecular_weight as double),6) molecular_weight" if c == "molecular_weight" else c for c in _STAGED_OUT) + f" from {name}"


def seed_of(t):
    return seed.build_seed(t.fx_items)


def wide_seed_of(t):
    return seed.build_seed(t.fx_items, wide=True)


def matched(t):
    return comp.match_compounds(comp.clean_results(t.fx_results), t.fx_items, wide_seed_of(t))


# J: joins ------------------------------------------------------------------------------------------


@entry("J01_unlinked", "select source_item_id, sku, name, cas from o_unlinked")
def _(t):
    return seed.unlinked(t.fx_items, t.fx_xref).select("source_item_id", "sku", "name", "cas")


ORACLES["o_unsent"] = """
select s.* from o_seed s left join (select distinct source_item_id, trim(query) query, lower(coalesce(nullif(hint,''),'name')) hint from fx_log) l
 on l.source_item_id=s.source_item_id and l.query=trim(s.query) and l.hint=lower(s.hint) where l.query is null
"""
ORACLES["o_unsent_unlinked"] = "select u.* from o_unsent u join o_unlinked i using (source_item_id)"


@entry("J02_unsent", "select source_item_id, query, hint from o_unsent")
def _(t):
    return dispatch.unsent(seed_of(t), t.fx_log).select("source_item_id", "query", "hint")


@entry("J03_unsent_unlinked", "select source_item_id, query, hint from o_unsent_unlinked")
def _(t):
    return dispatch.unsent_unlinked(seed_of(t), t.fx_items, t.fx_xref, t.fx_log).select("source_item_id", "query", "hint")


@entry("J04_alias_match", "select * from o_alias")
def _(t):
    return seed.alias_match(t.fx_items)


ORACLES["o_fam_existing"] = "select source_item_id product_id, 3 family_id from fx_items where sku like '%5%'"
ORACLES["o_fam_name"] = f"""
select c.source_item_id product_id, f.family_id, 0.85::double confidence from o_clean c join {FAMILY_SQL} on regexp_matches(c.clean, f.pattern, 'i')
where not exists (select 1 from o_fam_existing e where e.product_id=c.source_item_id and e.family_id=f.family_id)
"""
ORACLES["o_fam_reg"] = f"""
select distinct x.product_id, f.family_id, 0.8::double confidence from o_linked_xref x join fx_registry r on r.source||':'||r.external_id=x.chem_id
join {FAMILY_SQL} on regexp_matches(coalesce(lower(r.iupac_name),lower(r.canonical_name)), f.pattern, 'i')
join fx_items i on i.source_item_id=x.product_id where x.source='pubchem'
and not exists (select 1 from o_fam_existing e where e.product_id=x.product_id and e.family_id=f.family_id)
and not exists (select 1 from o_fam_name e where e.product_id=x.product_id and e.family_id=f.family_id)
"""


def existing_families(t):
    return t.fx_items.filter(F.col("sku").contains("5")).select(F.col("source_item_id").alias("product_id"), F.lit(3).alias("family_id"))


@entry("J05_family_by_name", "select * from o_fam_name")
def _(t):
    return families.family_by_name(t.fx_items, existing_families(t))


@entry("J05_many_patterns", """
select a.p_partkey product_id, b.p_partkey family_id from part a join part b
on a.p_name=b.p_name and a.p_brand=b.p_brand and a.p_size=b.p_size""")
def _(t):
    """As many patterns as parts, each an alternation of two forms."""
    named = t.part.selectExpr("p_partkey product_id", "concat(upper(p_name), ' ', p_brand, ' size ', p_size, ' ', p_type) text")
    table = t.part.selectExpr("p_partkey family_id", "concat('^', p_name, ' +', p_brand, ' size ', p_size, '( |$)|^part ', p_partkey, '$') pattern")
    return matching.match_patterns(named, "text", table, ["family_id"], "(?i)").select("product_id", "family_id")


@entry("J06_family_by_registry", "select * from o_fam_reg")
def _(t):
    first = existing_families(t)
    assigned = first.unionByName(families.family_by_name(t.fx_items, first).select("product_id", "family_id"))
    xref = registry.link_registry(t.fx_xref, t.fx_registry, P.SOURCE_COMPOUND, now())
    return families.family_by_registry(t.fx_items, xref, t.fx_registry, assigned)


ORACLES["o_linked_xref"] = f"""
select x.product_id, x.source, x.external_id, x.cas, x.match_confidence,
 case when r.external_id is not null and x.chem_id is distinct from r.source||':'||r.external_id then r.source||':'||r.external_id else x.chem_id end chem_id,
 case when r.external_id is not null and x.chem_id is distinct from r.source||':'||r.external_id then timestamp '{NOW}' else x.updated_at end updated_at
from fx_xref x left join fx_registry r on x.source='pubchem' and r.source='pubchem' and r.external_id=x.external_id
"""


@entry("J07_link_registry", "select product_id, source, external_id, chem_id, strftime(updated_at,'%Y-%m-%d %H:%M:%S') updated_at from o_linked_xref")
def _(t):
    out = registry.link_registry(t.fx_xref, t.fx_registry, P.SOURCE_COMPOUND, now())
    return out.select("product_id", "source", "external_id", "chem_id", stamp("updated_at"))


@entry(
    "J08_product_properties",
    "select i.source_item_id product_id, i.sku, i.name, i.cas product_cas, x.external_id pubchem_cid, r.formula, round(cast(r.mol_weight as double),6) mol_weight, r.iupac_name, r.inchikey "
    "from fx_items i join fx_xref x on x.product_id=i.source_item_id and x.source='pubchem' left join fx_registry r on r.source||':'||r.external_id=x.chem_id",
)
def _(t):
    out = registry.product_properties(t.fx_items, t.fx_xref, t.fx_registry)
    return out.select("product_id", "sku", "name", "product_cas", "pubchem_cid", "formula", num("mol_weight"), "iupac_name", "inchikey")


@entry("J09_map_explicit", _staged_sql("o_explicit"))
def _(t):
    return _staged_out(comp.map_explicit(comp.clean_results(t.fx_results)))


@entry("J10_map_by_cas", _staged_sql("o_by_cas"))
def _(t):
    return _staged_out(comp.map_by_cas(comp.clean_results(t.fx_results), t.fx_items))


@entry("J11_map_by_query", _staged_sql("o_by_query"))
def _(t):
    return _staged_out(comp.map_by_query(comp.clean_results(t.fx_results), wide_seed_of(t)))


ORACLES["o_name_sets"] = f"select min(source_item_id) item_id, g from (select source_item_id, list_sort({grams_sql('name')}) g from fx_names where name is not null) where len(g)>0 group by g"
ORACLES["o_doc_sets"] = f"""
select doc_id, list_sort({grams_sql('title')}) g from fx_docs where product_id is null
union select doc_id, list_sort({grams_sql('filename')}) from fx_docs where product_id is null
"""
ORACLES["o_fuzzy"] = f"""
select doc_id, item_id source_item_id, sim from (
 select doc_id, item_id, sim, row_number() over (partition by doc_id order by sim desc, item_id) rn
 from (select d.g, n.item_id, {sim_sql('d.g','n.g')} sim from (select distinct g from o_doc_sets) d, o_name_sets n) s join o_doc_sets using (g)
) where rn=1 and cast(cast(sim as float) as double) >= 0.45
"""


@entry("J12_fuzzy_best", "select doc_id, source_item_id, round(sim,6) sim from o_fuzzy")
def _(t):
    return fuzzy.fuzzy_best(t.fx_docs, t.fx_names).select("doc_id", "source_item_id", F.round("sim", 6).alias("sim"))


@entry("W02_best_match", "select d.doc_id, coalesce(d.product_id, f.source_item_id) product_id, d.title from fx_docs d left join o_fuzzy f using (doc_id)")
def _(t):
    out = fuzzy.attach_products(t.fx_docs, fuzzy.fuzzy_best(t.fx_docs, t.fx_names))
    return out.select("doc_id", "product_id", "title")


@entry("J13_lateral_extract", "select source_item_id, pos::int match_pos, query, src from o_found")
def _(t):
    a = seed.lateral_extract(t.fx_items, "name").withColumn("src", F.lit("name"))
    return a.unionByName(seed.lateral_extract(t.fx_items, "sku").withColumn("src", F.lit("sku")))


ORACLES["o_relinked"] = f"""
with t as (select cast(cid as varchar) cid, min(external_id) ext from fx_registry where source='pubchem' and cid is not null group by 1),
k as (select source||':'||external_id chem_id, t.ext from fx_registry r join t on t.cid=json_extract_string(r.properties,'$.cid') where r.source='cas'),
x as (select x.product_id, case when k.ext is not null then 'pubchem' else x.source end source, coalesce(k.ext, x.external_id) external_id, x.cas, x.match_confidence, x.chem_id, k.ext is not null moved
 from (select * from o_cas_linked) x left join k on x.source='cas' and k.chem_id=x.chem_id)
select product_id, source, external_id, cas, match_confidence, chem_id from (select *, row_number() over (partition by product_id, source, external_id order by match_confidence desc, moved, chem_id desc) rn from x) where rn=1
"""
ORACLES["o_cas_linked"] = """
select x.product_id, x.source, x.external_id, x.cas, x.match_confidence, case when r.external_id is not null then 'cas:'||r.external_id else x.chem_id end chem_id
from fx_xref x left join fx_registry r on x.source='cas' and r.source='cas' and r.external_id=x.external_id
"""


@entry("J16_relink_to_compound", "select product_id, source, external_id, cas, match_confidence from o_relinked")
def _(t):
    linked = registry.link_registry(t.fx_xref, t.fx_registry, "cas", now())
    return registry.relink_to_compound(linked, t.fx_registry, now()).select("product_id", "source", "external_id", "cas", "match_confidence")


@entry("J17_clear_log", "select source_item_id, query, hint from fx_log l where not exists (select 1 from o_unlinked u where u.source_item_id=l.source_item_id)")
def _(t):
    return dispatch.clear_log(t.fx_log, t.fx_items, t.fx_xref).select("source_item_id", "query", "hint")


@entry("J19_scope_join", "select source_item_id, name from fx_items where source_item_id in (select source_item_id from o_unlinked)")
def _(t):
    return seed.scope_join(seed.unlinked(t.fx_items, t.fx_xref), t.fx_items).select("source_item_id", "name")


@entry("J20_named_cross", "select c.n_name company, p.p_partkey product_id, 'supplier' relationship_type from nation c, part p where c.n_nationkey=3 and p.p_name='red widget'")
def _(t):
    return registry.named_cross(
        t.nation.select("n_nationkey", "n_name"), t.part.select("p_partkey", "p_name"), F.col("n_nationkey") == 3, F.col("p_name") == "red widget",
        [F.col("n_name").alias("company"), F.col("p_partkey").alias("product_id"), F.lit("supplier").alias("relationship_type")],
    )


# A: aggregates -------------------------------------------------------------------------------------

ORACLES["o_collapsed"] = "select product_id, pubchem_cid, max(nullif(cas,'')) cas from o_staged where product_id is not null and pubchem_cid is not null group by 1,2"


@entry("A01_xref_collapse", "select * from o_collapsed")
def _(t):
    return comp.xref_collapse(matched(t).links())


@entry("A02_cas_from_raw", "select * from o_raw")
def _(t):
    return seed.cas_from_raw(t.fx_items)


@entry(
    "A04_coverage",
    "select count(*)::bigint products, count(x.product_id)::bigint linked, count(distinct source_item_id)::bigint distinct_products, count(distinct x.product_id)::bigint distinct_linked, "
    "round(100.0*count(x.product_id)/nullif(count(*),0),2)::double pct_linked from fx_items i left join fx_xref x on x.product_id=i.source_item_id and x.source='pubchem'",
)
def _(t):
    return report.coverage(t.fx_items, t.fx_xref).withColumn("pct_linked", F.col("pct_linked").cast("double"))


@entry(
    "A05_activity_window",
    f"select (select count(*) from fx_log where produced_at >= timestamp '{NOW}' - interval 30 minute)::bigint produced, (select count(*) from fx_compounds where created_at >= timestamp '{NOW}' - interval 30 minute)::bigint scraped, "
    f"(select count(*) from fx_xref where updated_at >= timestamp '{NOW}' - interval 30 minute)::bigint linked",
)
def _(t):
    return report.activity_window(
        now(), 30, produced=(t.fx_log, "produced_at"), scraped=(t.fx_compounds, "created_at"), linked=(t.fx_xref, "updated_at")
    )


@entry(
    "A06_stage_counts",
    "select (select count(*) from fx_results)::bigint raw_rows, (select count(*) from o_staged)::bigint staged_rows, (select count(*) from o_staged where product_id is not null and pubchem_cid is not null)::bigint ready_rows, "
    "(select count(*) from fx_xref where source='pubchem')::bigint xref_rows, (select count(*) from fx_registry where source='pubchem')::bigint registry_rows",
)
def _(t):
    return report.stage_counts(t.fx_results, matched(t).counts(), t.fx_xref, t.fx_registry)


@entry("A09_synonyms_agg", "select source, external_id, coalesce(array_to_string(json_extract_string(properties,'$.Synonyms[*]'),';'),'') synonyms from fx_compounds")
def _(t):
    return registry.synonyms_agg(t.fx_compounds).withColumn("synonyms", F.array_join("synonyms", ";"))


@entry(
    "A10_seed_counts",
    "select (select count(*) from fx_log)::bigint seed_before, (select count(*) from o_seed)::bigint seed_after, (select count(*) from fx_staging where coalesce(nullif(name,''),nullif(cas,'')) is not null)::bigint usable_items",
)
def _(t):
    return report.seed_counts(t.fx_log, seed_of(t), t.fx_staging)


# W: ordered selection ------------------------------------------------------------------------------

ORACLES["o_capped"] = f"""
select source_item_id, query, hint, seq, rn from (select *, row_number() over (partition by source_item_id order by {PRIORITY.replace('{q}', 'query')}, seq, query, hint) rn from o_unsent_unlinked) where rn<=3
"""


@entry("W01_cap_topn", "select source_item_id, query, hint, rn::int rank from o_capped")
def _(t):
    open_queries = dispatch.unsent_unlinked(seed_of(t), t.fx_items, t.fx_xref, t.fx_log)
    return dispatch.cap_topn(open_queries, 3).select("source_item_id", "query", "hint", "rank")


_BEST = "row_number() over (partition by pubchem_cid order by (molecular_weight is null), (iupac_name is null), (canonical_smiles is null), name nulls last, iupac_name nulls last, molecular_formula nulls last, molecular_weight nulls last, canonical_smiles nulls last)"
ORACLES["o_best"] = f"select pubchem_cid, name, iupac_name, molecular_formula, molecular_weight, canonical_smiles from (select *, {_BEST} rn from o_staged where pubchem_cid is not null) where rn=1"


@entry("W05_best_compound_row", "select pubchem_cid, name, iupac_name, molecular_formula, round(cast(molecular_weight as double),6) molecular_weight, canonical_smiles from o_best")
def _(t):
    return comp.best_compound_row(matched(t).reached()).select("pubchem_cid", "name", "iupac_name", "molecular_formula", num("molecular_weight"), "canonical_smiles")


@entry("W06_keyset_page", "select source_item_id, name from fx_items where source_item_id>50 order by source_item_id limit 100")
def _(t):
    return dispatch.keyset_page(t.fx_items, "source_item_id", 50, 100).select("source_item_id", "name")


@entry("W07_ordered_limit", "select source_item_id, name from fx_items where name<>'' order by source_item_id limit 500")
def _(t):
    return dispatch.ordered_limit(t.fx_items.filter(F.col("name") != ""), "source_item_id", 500).select("source_item_id", "name")


# U: unions -----------------------------------------------------------------------------------------


@entry("U01_build_seed", "select source_item_id, query, hint, (seq//1048576)::int branch_no from o_seed")
def _(t):
    return seed_of(t).select("source_item_id", "query", "hint", "branch_no")


@entry("U01_build_seed_wide_unlinked", "select source_item_id, query, hint, min(b)::int branch_no from o_branches_wide where source_item_id in (select source_item_id from o_unlinked) group by 1,2,3")
def _(t):
    scope = seed.unlinked(t.fx_items, t.fx_xref)
    base = t.fx_items.drop("raw")
    rows = t.fx_items.select(F.col("source_item_id").alias("id"), "raw")
    return seed.build_seed(base, rows, scope=scope, wide=True).select("source_item_id", "query", "hint", "branch_no")


@entry("U02_map_compounds", _staged_sql("o_staged"))
def _(t):
    return _staged_out(matched(t).staged())


@entry("U03_pick_mode", f"select source_item_id, cas query, 'cas' hint from fx_items where regexp_matches(cas,'{SHAPE}')")
def _(t):
    from ..operators.predicates import cas_items, include_exclude, named_items

    none_left = dispatch.unsent(seed_of(t), seed_of(t))
    return dispatch.pick_mode(
        [
            lambda: none_left.select("source_item_id", "query", "hint"),
            lambda: cas_items(t.fx_items),
            lambda: named_items(include_exclude(t.fx_items)),
            lambda: named_items(t.fx_items),
        ]
    )


# M: upserts ----------------------------------------------------------------------------------------

_REG_OUT = "source, external_id, cid, canonical_name, iupac_name, formula, mol_weight, array_to_string(synonyms,';') synonyms, strftime(created_at,'%Y-%m-%d %H:%M:%S') created_at, strftime(updated_at,'%Y-%m-%d %H:%M:%S') updated_at"


def _reg_out(df):
    return df.select(
        "source", "external_id", "cid", "canonical_name", "iupac_name", "formula", num("mol_weight"),
        F.array_join("synonyms", ";").alias("synonyms"), stamp("created_at"), stamp("updated_at"),
    )


ORACLES["o_props"] = """
select source, external_id, try_cast(nullif(json_extract_string(properties,'$.CID'),'') as bigint) cid, nullif(json_extract_string(properties,'$.Title'),'') canonical_name,
 nullif(json_extract_string(properties,'$.IUPACName'),'') iupac_name, nullif(json_extract_string(properties,'$.MolecularFormula'),'') formula,
 try_cast(nullif(json_extract_string(properties,'$.MolecularWeight'),'') as decimal(18,6)) mol_weight, coalesce(json_extract_string(properties,'$.Synonyms[*]'), []) synonyms
from fx_compounds where source='pubchem'
"""


def _reg_upsert_sql(src, cid, syn):
    ins = "t.external_id is null"
    return f"""
select coalesce(t.source,s.source) source, coalesce(t.external_id,s.external_id) external_id, {cid} cid, coalesce(s.canonical_name,t.canonical_name) canonical_name,
 coalesce(s.iupac_name,t.iupac_name) iupac_name, coalesce(s.formula,t.formula) formula, round(cast(coalesce(s.mol_weight,t.mol_weight) as double),6) mol_weight, {syn} synonyms,
 case when {ins} then null else t.created_at end created_at, case when s.external_id is not null then timestamp '{NOW}' else t.updated_at end updated_at
from fx_registry t full join {src} s on s.source=t.source and s.external_id=t.external_id
"""


ORACLES["o_reg_props"] = _reg_upsert_sql(
    "o_props", "case when s.external_id is not null then s.cid else t.cid end", "case when len(s.synonyms)>0 then s.synonyms else coalesce(t.synonyms, s.synonyms) end"
)


@entry("M01_registry_from_properties", f"select {_REG_OUT} from o_reg_props")
def _(t):
    return _reg_out(up.upsert(t.fx_registry, registry.registry_from_properties(t.fx_compounds), up.REGISTRY_KEYS, up.REGISTRY_FROM_PROPERTIES, now()))


@entry("M01_registry_from_properties_delta", f"select {_REG_OUT} from o_reg_props")
def _(t):
    src = registry.registry_from_properties(t.fx_compounds)
    return _reg_out(up.upsert(t.fx_registry, src, up.REGISTRY_KEYS, up.REGISTRY_FROM_PROPERTIES, now(), delta=True))


ORACLES["o_reg_source"] = "select 'pubchem' source, pubchem_cid external_id, try_cast(pubchem_cid as bigint) cid, name canonical_name, iupac_name, molecular_formula formula, molecular_weight mol_weight from o_best"
ORACLES["o_reg_results"] = _reg_upsert_sql("o_reg_source", "case when t.external_id is null then s.cid else t.cid end", "t.synonyms")


@entry("M02_registry_from_results", f"select {_REG_OUT} from o_reg_results")
def _(t):
    return _reg_out(up.upsert(t.fx_registry, comp.registry_from_results(matched(t).reached()), up.REGISTRY_KEYS, up.REGISTRY_FROM_RESULTS, now()))


ORACLES["o_xref_results"] = f"""
select coalesce(t.product_id,s.product_id) product_id, coalesce(t.source,'pubchem') source, coalesce(t.external_id,s.pubchem_cid) external_id, coalesce(s.cas,t.cas) cas,
 greatest(t.match_confidence, case when s.pubchem_cid is not null then 0.99::double end) match_confidence, t.chem_id,
 case when s.pubchem_cid is not null then timestamp '{NOW}' else t.updated_at end updated_at
from fx_xref t full join o_collapsed s on t.product_id=s.product_id and t.source='pubchem' and t.external_id=s.pubchem_cid
"""
_XREF_OUT = "product_id, source, external_id, cas, match_confidence, chem_id, strftime(updated_at,'%Y-%m-%d %H:%M:%S') updated_at"


def _xref_out(df):
    return df.select("product_id", "source", "external_id", "cas", "match_confidence", "chem_id", stamp("updated_at"))


@entry("M04_xref_from_results", f"select {_XREF_OUT} from o_xref_results")
def _(t):
    return _xref_out(up.upsert(t.fx_xref, comp.xref_from_results(matched(t).links()), up.XREF_KEYS, up.XREF_FROM_RESULTS, now()))


@entry(
    "M08_insert_only",
    "select source_item_id, query, hint, 'log' origin from fx_log union all select source_item_id, query, hint, 'new' from o_seed s "
    "where not exists (select 1 from fx_log l where l.source_item_id=s.source_item_id and l.query=s.query and l.hint=s.hint)",
)
def _(t):
    log = t.fx_log.select("source_item_id", "query", "hint", F.lit("log").alias("origin"))
    return up.insert_only(log, seed_of(t).withColumn("origin", F.lit("new")), up.QUERY_KEYS)


ORACLES["o_backfilled"] = """
select id, coalesce(nullif(name,''), nullif(json_extract_string(j,'$."Display Name"'),''), nullif(json_extract_string(j,'$.Name'),''), name) "name",
 coalesce(nullif(sku,''), nullif(json_extract_string(j,'$.Name'),''), nullif(json_extract_string(j,'$."Internal ID"'),''), sku) sku,
 coalesce(nullif(description,''), nullif(json_extract_string(j,'$.Description'),''), description) description,
 coalesce(nullif(cas,''), nullif(json_extract_string(j,'$.CAS'),''), nullif(json_extract_string(j,'$."CAS No"'),''), nullif(json_extract_string(j,'$."CAS Number"'),''), nullif(json_extract_string(j,'$."CAS#"'),''), cas) cas
from (select *, case when json_valid(raw) then raw end j from fx_staging)
"""


@entry("M15_backfill_columns", "select * from o_backfilled")
def _(t):
    out = staging.backfill_columns(quality.json_column_repair(t.fx_staging, "raw"))
    return out.select("id", "name", "sku", "description", "cas")


@entry("M16_hint_lowercase", "select source_item_id, query, lower(hint) hint from fx_log")
def _(t):
    return up.hint_lowercase(t.fx_log).select("source_item_id", "query", "hint")


# C: integrity --------------------------------------------------------------------------------------


@entry("C01_check_non_blank", "select product_id, name from fx_products where not coalesce(length(trim(name))>0, true)")
def _(t):
    return quality.check_non_blank(t.fx_products, "name").select("product_id", "name")


@entry("C02_check_pattern", f"select product_id, cas_number from fx_products where not coalesce(regexp_matches(cas_number,'{SHAPE}'), true)")
def _(t):
    return quality.check_pattern(t.fx_products, "cas_number", P.CAS_SHAPE).select("product_id", "cas_number")


@entry("C03_check_domain", "select event_id, event_type from events where event_type not in ('view','search','favorite','download','click')")
def _(t):
    return quality.check_domain(t.events, "event_type", ["view", "search", "favorite", "download", "click"]).select("event_id", "event_type")


@entry("C04_check_range", "select p_partkey, p_size from part where not (p_size between 1 and 16)")
def _(t):
    return quality.check_range(t.part, "p_size", 1, 16).select("p_partkey", "p_size")


@entry("C05_check_unique", "select l_orderkey, l_linenumber, count(*)::bigint \"rows\" from lineitem group by 1,2 having count(*)>1")
def _(t):
    return quality.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@entry("C06_check_unique_expr", "select product_id, coalesce(cas,'') k, count(*)::bigint \"rows\" from fx_xref group by 1,2 having count(*)>1")
def _(t):
    return quality.check_unique_expr(t.fx_xref, {"product_id": F.col("product_id"), "k": F.coalesce("cas", F.lit(""))})


@entry("C07_check_reference", "select x.product_id, x.external_id from fx_xref x where x.chem_id is not null and x.chem_id not in (select source||':'||external_id from fx_registry)")
def _(t):
    reg = t.fx_registry.select(registry.chem_id(F.col("source"), F.col("external_id")).alias("id"))
    return quality.check_reference(t.fx_xref, "chem_id", reg, "id").select("product_id", "external_id")


@entry("C08_check_not_null", "select source_item_id, sku from fx_items where cas is null")
def _(t):
    return quality.check_not_null(t.fx_items, "cas").select("source_item_id", "sku")


@entry("C09_json_column_repair", "select count(case when json_valid(raw) then 1 end)::bigint ok, count(case when not json_valid(raw) then 1 end)::bigint bad from fx_staging")
def _(t):
    return quality.json_repair_counts(t.fx_staging, "raw")


@entry("C10_cascade_delete", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus<>'P')")
def _(t):
    alive = t.orders.filter(F.col("o_orderstatus") != "P")
    return quality.cascade_delete(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", alive, "o_orderkey")


# L: flows ------------------------------------------------------------------------------------------


@entry(
    "L1_stage",
    f"select id source_item_id, coalesce(nullif(cas,''),nullif(name,'')) query, case when regexp_matches(cas,'{SHAPE}') then 'cas' else 'name' end hint from ("
    "select p_partkey id, nullif(case when p_size%2=0 then p_name else '' end,'') \"name\", case when p_partkey%3=0 then CAS[p_partkey] when p_partkey%3=1 then CAS[p_partkey+1] end cas from part) "
    "where coalesce(nullif(cas,''),nullif(name,'')) is not null",
)
def _(t):
    sheet = staging.read_text_table(t.spark, _written_csv(t, t.spark.sql(_sheet_sql(t)), "sheet"), [])
    customers = t.customer.select(F.col("c_custkey").alias("CustomerCode"), F.col("c_name").alias("CustomerName"), F.col("c_mktsegment").alias("Segment"))
    sales = t.lineitem.select(F.col("l_shipdate").alias("Date"), F.col("l_partkey").alias("ItemNo"), F.col("l_quantity").alias("Qty"), F.col("l_extendedprice").alias("Revenue"))
    out = flows.stage(sheet, customers, sales, schemas.empty(t.spark, "item_master_query").drop("seq"), F.col("Key").cast("bigint"))
    return out["item_master_query"]


def _sheet_sql(t):
    from .fixtures import sql

    return sql(
        "spark",
        "select cast(p_partkey as bigint) Key, concat('SKU',cast(p_partkey as string)) ItemNo, case when p_size%2=0 then p_name else '' end ItemName, "
        "case when p_partkey%3=0 then CAS[p_partkey] else '' end CAS, case when p_partkey%3=1 then CAS[p_partkey+1] end `CAS No` from {part}",
        t.dir,
    )


def orchestrated(t):
    empty_queries = schemas.empty(t.spark, "item_master_query")
    return flows.orchestrate(
        t.fx_items.drop("raw"), t.fx_items.select(F.col("source_item_id").alias("id"), "raw"), t.fx_xref, empty_queries,
        t.fx_log, t.fx_compounds, t.fx_registry, existing_families(t).withColumn("confidence", F.lit(0.8)), now(),
    )


@entry(
    "L2_orchestrate_messages",
    "select 'pubchem|'||lower(hint)||'|'||cast(source_item_id as varchar)||'|'||lower(trim(query)) key, source_item_id, min(trim(query)) query from o_capped where trim(query)<>'' group by 1, 2",
)
def _(t):
    m = orchestrated(t)["messages"]
    return m.select(
        "key", F.get_json_object("value", "$.source_item_id").cast("bigint").alias("source_item_id"),
        F.get_json_object("value", "$.query").alias("query"),
    )


@entry(
    "L2_orchestrate_log",
    "select source_item_id, query, hint from fx_log union all (select source_item_id, trim(query), lower(hint) from o_capped "
    "where trim(query)<>'' except select source_item_id, query, hint from fx_log)",
)
def _(t):
    return orchestrated(t)["produced_query_log"].select("source_item_id", "query", "hint")


ORACLES["o_l2_links"] = """
select x.product_id, x.source, x.external_id, case when x.source='pubchem' and r.external_id is not null then 'pubchem:'||r.external_id else x.chem_id end chem_id
from fx_xref x left join o_reg_props r on r.source=x.source and r.external_id=x.external_id
"""
ORACLES["o_l2_fam"] = f"""
select product_id, family_id from o_fam_existing union select product_id, family_id from o_fam_name
union select x.product_id, f.family_id from o_l2_links x join o_reg_props r on r.source||':'||r.external_id=x.chem_id
join {FAMILY_SQL} on regexp_matches(coalesce(lower(r.iupac_name),lower(r.canonical_name)), f.pattern, 'i') where x.source='pubchem'
"""


@entry("L2_orchestrate_links", "select product_id, source, external_id, chem_id from o_l2_links")
def _(t):
    return orchestrated(t)["product_chem_xref"].select("product_id", "source", "external_id", "chem_id")


@entry("L2_orchestrate_families", "select product_id, family_id::int family_id from o_l2_fam")
def _(t):
    return orchestrated(t)["product_family"].select("product_id", "family_id")


ORACLES["o_l4_links"] = """
select x.product_id, x.source, x.external_id, x.cas, x.match_confidence, case when x.source='pubchem' and r.external_id is not null then 'pubchem:'||r.external_id else x.chem_id end chem_id
from o_xref_results x left join o_reg_results r on r.source=x.source and r.external_id=x.external_id
"""


def loaded(t):
    return flows.compound_load(t.fx_results, t.fx_items, wide_seed_of(t), t.fx_xref, t.fx_registry, now())


@entry(
    "L4_compound_load",
    "select i.source_item_id product_id, i.name, x.external_id pubchem_cid, r.formula, r.mol_weight, r.iupac_name from fx_items i join o_l4_links x on x.product_id=i.source_item_id and x.source='pubchem' "
    "left join o_reg_results r on r.source||':'||r.external_id=x.chem_id",
)
def _(t):
    return loaded(t)["product_properties"].select("product_id", "name", "pubchem_cid", "formula", num("mol_weight"), "iupac_name")


@entry(
    "L4_compound_load_counts",
    "select (select count(*) from fx_results)::bigint raw_rows, (select count(*) from o_staged)::bigint staged_rows, (select count(*) from o_staged where product_id is not null and pubchem_cid is not null)::bigint ready_rows, "
    "(select count(*) from o_l4_links where source='pubchem')::bigint xref_rows, (select count(*) from o_reg_results where source='pubchem')::bigint registry_rows",
)
def _(t):
    return loaded(t)["counts_after"]
