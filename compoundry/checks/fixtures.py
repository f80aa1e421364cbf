"""Input tables derived from the test tables, in SQL that means the same in Spark and DuckDB.

``sql(dialect, text)`` puts the relations a query names in front of it as common table expressions, so
the same recipe feeds an operator and its oracle. Marks: ``{part}`` a base table, ``CAS[n]`` a registry
number with a right check digit made from a number, ``ARR[x]`` a one-element array, ``PAGES[x]`` parts
of a page in order.
"""

from __future__ import annotations

import re

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

NOW = "2024-06-01 00:00:00"

RELATIONS: dict[str, str] = {}
ORACLES: dict[str, str] = {}
#: Relations as Spark reads them, with the same rows: dealt once, by page, while rows are narrow; texts are made after that.
DEALT: dict[str, str] = {}


def _cas(n: str) -> str:
    body = f"lpad(concat(cast(50+({n}) as string),lpad(cast(({n})%100 as string),2,'0')),9,'0')"
    total = "+".join(f"{i}*cast(substr({body},{10 - i},1) as int)" for i in range(1, 10))
    return (
        f"concat(cast(50+({n}) as string),'-',lpad(cast(({n})%100 as string),2,'0'),'-',"
        f"cast(({total})%10 as string))"
    )


_PAGES = {
    "spark": "array_join(transform(array_sort(collect_list(struct(l_linenumber,txt))),x->x.txt),chr(10))",
    "duckdb": "string_agg(txt, chr(10) order by l_linenumber)",
}


def _expand(text: str, dialect: str, sf_dir: str | None) -> str:
    text = re.sub(r"CAS\[([^\]]+)\]", lambda m: _cas(m.group(1)), text)
    text = re.sub(r"ARR\[([^\]]+)\]", lambda m: f"{'array' if dialect == 'spark' else 'list_value'}({m.group(1)})", text)
    text = text.replace("PAGES[]", _PAGES[dialect])
    for t in BASE_TABLES:
        text = text.replace("{" + t + "}", f"parquet.`{sf_dir}/{t}.parquet`" if dialect == "spark" else t)
    return text


def sql(dialect: str, text: str, sf_dir: str | None = None) -> str:
    """A complete statement: needed relations first, then ``text`` (which may open with its own WITH)."""
    known = {**RELATIONS, **DEALT} if dialect == "spark" else {**RELATIONS, **ORACLES}
    order: list[str] = []

    def need(body: str) -> None:
        for name in re.findall(r"\b(?:fx|o)_\w+\b", body):
            if name in known and name not in order:
                need(known[name])
                if name not in order:
                    order.append(name)

    need(text)
    if not order:
        return _expand(text, dialect, sf_dir)
    ctes = ",\n".join(f"{n} AS (\n{known[n].strip()}\n)" for n in order)
    body = text.strip()
    body = ",\n" + body[4:].lstrip() if body[:5].lower() in ("with ", "with\n") else "\n" + body
    return _expand(f"WITH {ctes}{body}", dialect, sf_dir)


class Tables:
    """Fixtures and base tables of one scale folder, as DataFrames."""

    def __init__(self, spark, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str):
        if name in RELATIONS:
            return self.spark.sql(sql("spark", f"select * from {name}", self.dir))
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        raise AttributeError(name)


RELATIONS["fx_items"] = """
select cast(p_partkey+1 as bigint) source_item_id,
 concat('SKU-',cast(p_partkey as string),case when p_partkey%10=5 then concat(' ',CAS[p_partkey]) else '' end) sku,
 case p_partkey%8 when 0 then 'Sodium Hydroxide 50% w/v Drum' when 1 then p_name
  when 2 then concat('Acetone ACS 50% drum ',cast(p_size as string)) when 3 then ' Xylenes '
  when 4 then 'Isopropyl Alcohol'
  when 5 then concat('Citric Acid (CAS ',CAS[p_partkey],') ',cast(p_size as string),' kg')
  when 6 then 'n-Butyl ACETATE Technical' else cast(null as string) end name,
 case p_partkey%3 when 0 then CAS[p_partkey] when 1 then '' else cast(null as string) end cas,
 concat('{"Display Name":"',p_name,'","CAS No":"',case when p_partkey%2=0 then CAS[p_partkey] else '' end,'","Size":',cast(p_size as string),'}') raw
from {part}
"""
RELATIONS["fx_staging"] = """
select source_item_id id, case when source_item_id%4=0 then '' else sku end sku, name,
 cast(null as string) description, cas,
 case when source_item_id%9=0 then '{broken' when source_item_id%9=1 then cast(null as string)
  when source_item_id%9=2 then concat('{"Name":"N',cast(source_item_id as string),'","Internal ID":"I7","Description":"D","CAS#":"',CAS[source_item_id],'"}')
  else raw end raw
from fx_items
"""
RELATIONS["fx_results"] = """
select case when p_partkey%5=0 then '  ' when p_partkey%2=0 then CAS[p_partkey] else p_name end query_name,
 case when p_partkey%2=0 then 'CAS' else ' name ' end query_hint,
 case when p_partkey%4=0 then cast(p_partkey+1 as bigint) end source_item_id,
 case when p_partkey%13=0 then '' else cast(1000+p_partkey%500 as string) end CID,
 concat('Compound ',cast(p_partkey%500 as string)) Title,
 case when p_partkey%7=0 then '' else concat('iupac-',cast(p_partkey%500 as string)) end IUPACName,
 case when p_partkey%11=0 then '' else concat('C',cast(p_size as string),'H',cast(2*p_size as string)) end MolecularFormula,
 case when p_partkey%17=0 then 'n/a' else cast(p_size*60 as string) end MolecularWeight,
 concat(' C',cast(p_size as string)) CanonicalSMILES, cast(null as string) InChI, cast(null as string) InChIKey,
 cast(null as string) Synonyms
from {part}
"""
RELATIONS["fx_requests"] = """
select event_id msg_no, ts, concat('pubchem|',event_type,'|',cast(user_id as string)) key,
 case event_id%10 when 0 then '{bad' when 1 then '{"query":"  ","hint":"name"}' when 2 then '{"query":"ab"}'
  when 3 then '{"query":"12-3","hint":"CAS"}' when 4 then '[1]'
  else concat('{"query":"',case when event_id%2=0 then CAS[user_id] else concat('Compound ',cast(user_id as string)) end,
   '","hint":"',case when event_id%2=0 then 'cas' else 'name' end,'","source_item_id":',cast(user_id+1 as string),'}') end value
from {events}
"""
RELATIONS["fx_sds_src"] = """
select cast(l_orderkey+1 as bigint) doc_id, l_linenumber, min(l_partkey) pk, min(l_suppkey) sk, cast(min(l_quantity) as int) q
from {lineitem} group by l_orderkey, l_linenumber
"""
RELATIONS["fx_sds_parts"] = """
select doc_id, cast(floor((l_linenumber-1)/3) as int)+1 page_no, l_linenumber,
 concat('SECTION ',cast(l_linenumber as string),': Part ',cast(l_linenumber as string),chr(10),
  'Ingredient ',cast(pk%50 as string),' , ',CAS[pk],' ',cast(q as string),
  case when pk%3=0 then concat(' - ',cast(q+5 as string),' %') when pk%3=1 then ' %' else '' end,chr(10),
  'Impurity ',cast(10+pk%90 as string),'-11-',cast(sk%10 as string),chr(10),
  case when sk%4=0 then 'Danger: ' when sk%4=1 then 'WARNING ' else '' end,'H',cast(200+sk as string),' P301+P310 P',cast(200+pk%99 as string)) txt
from fx_sds_src
"""
RELATIONS["fx_sds_pages"] = "select doc_id, page_no, PAGES[] text from fx_sds_parts group by doc_id, page_no"
RELATIONS["fx_sds_docs"] = """
select doc_id, case when doc_id%5=0 then cast(null as bigint) else doc_id%1000+1 end product_id,
 concat('Sheet ',cast(doc_id as string)) title, concat('sheet_',cast(doc_id as string),'.pdf') filename
from (select distinct doc_id from fx_sds_src) d
"""
_PAGE_NO = "cast(floor((l_linenumber-1)/3) as int)+1"
DEALT["fx_sds_rows"] = f"""
select /*+ REPARTITION(doc_id, page_no) */ cast(l_orderkey+1 as bigint) doc_id, {_PAGE_NO} page_no, l_linenumber, l_partkey, l_suppkey, l_quantity
from {{lineitem}}
"""
DEALT["fx_sds_src"] = """
select doc_id, page_no, l_linenumber, min(l_partkey) pk, min(l_suppkey) sk, cast(min(l_quantity) as int) q
from fx_sds_rows group by doc_id, page_no, l_linenumber
"""
DEALT["fx_sds_parts"] = RELATIONS["fx_sds_parts"].replace(_PAGE_NO, "")
DEALT["fx_sds_ids"] = "select cast(l_orderkey+1 as bigint) doc_id from {lineitem}"
DEALT["fx_sds_docs"] = RELATIONS["fx_sds_docs"].replace("fx_sds_src", "fx_sds_ids")
RELATIONS["fx_docs"] = """
select cast(p_partkey+1 as bigint) doc_id, case when p_size=50 then cast(1 as bigint) end product_id,
 concat(p_name,' SDS') title, concat(replace(p_name,' ','_'),'_',p_brand,'.pdf') filename
from {part}
"""
RELATIONS["fx_names"] = """
select cast(p_partkey+1 as bigint) source_item_id,
 case when p_size=49 then cast(null as string) else concat(p_name,' ',p_brand) end name from {part}
"""
RELATIONS["fx_xref"] = """
select *, cast(null as string) properties_ref,
 case when source='pubchem' and product_id%4=0 then concat('pubchem:',external_id) when product_id%4=1 then 'pubchem:0' end chem_id,
 cast(concat('2024-05-31 23:',lpad(cast(product_id%60 as string),2,'0'),':00') as timestamp) updated_at
from (
 select cast(p_partkey+1 as bigint) product_id, 'pubchem' source, cast(1000+p_partkey%500 as string) external_id,
  cast(null as string) cas, cast(0.95 as double) match_confidence from {part} where p_size<=17
 union all
 select cast(p_partkey+1 as bigint), 'pubchem', cast(5000+p_partkey as string), CAS[p_partkey], cast(0.5 as double) from {part} where p_size<=8
 union all
 select cast(p_partkey+1 as bigint), 'cas', CAS[p_partkey], CAS[p_partkey], cast(0.97 as double) from {part} where p_type in ('SMALL','PROMO')
) x
"""
RELATIONS["fx_registry"] = """
select 'pubchem' source, cast(1000+k as string) external_id, cast(1000+k as bigint) cid,
 case when k%3=0 then cast(null as string) when k%3=1 then concat('methyl ketone ',cast(k as string)) else nm end canonical_name,
 case when k%2=0 then concat('ethanol-',cast(k as string)) end iupac_name,
 case when k%5=0 then 'C2H6O' end formula, case when k%7<5 then cast(sz*1.5 as decimal(18,6)) end mol_weight,
 cast(null as string) canonical_smiles, cast(null as string) inchi, case when k%9=0 then 'KEY' end inchikey,
 ARR['old'] synonyms, cast(null as string) properties,
 cast('2024-01-01 00:00:00' as timestamp) created_at, cast('2024-01-02 00:00:00' as timestamp) updated_at
from (select p_partkey%500 k, min(p_size) sz, min(p_name) nm from {part} where p_type in ('SMALL','LARGE') group by p_partkey%500) a
union all
select 'cas', CAS[p_partkey], cast(null as bigint), p_name, cast(null as string), cast(null as string), cast(null as decimal(18,6)),
 cast(null as string), cast(null as string), cast(null as string), ARR['c'],
 case when p_size<=25 then concat('{"cid":"',cast(1000+p_partkey%500 as string),'"}') end,
 cast('2024-01-01 00:00:00' as timestamp), cast('2024-01-02 00:00:00' as timestamp)
from {part} where p_type='SMALL'
"""
RELATIONS["fx_compounds"] = """
select p_name query, case when p_type='PROMO' then 'other' else 'pubchem' end source, cast(1000+p_partkey as string) external_id,
 concat('{"CID":',case when p_partkey%6=0 then '""' else cast(1000+p_partkey as string) end,
  case when p_partkey%4=0 then concat(',"Title":"',p_name,'"') else '' end,
  ',"IUPACName":',case when p_partkey%5=0 then 'null' else concat('"iupac-',cast(p_partkey as string),'"') end,
  ',"MolecularFormula":"',case when p_partkey%3=0 then '' else 'H2O' end,
  '","MolecularWeight":"',case when p_partkey%7=0 then 'n/a' else cast(p_size as string) end,'"',
  case when p_partkey%2=0 then concat(',"Synonyms":["',p_brand,'","',p_type,'"]') else '' end,'}') properties,
 cast(concat('2024-05-31 23:',lpad(cast(p_partkey%60 as string),2,'0'),':30') as timestamp) created_at,
 cast('2024-05-31 23:59:00' as timestamp) updated_at
from {part}
"""
RELATIONS["fx_log"] = """
select case when p_size=3 then cast(null as bigint) else cast(p_partkey+1 as bigint) end source_item_id,
 case when p_partkey%3=0 then CAS[p_partkey] else 'isopropanol' end query,
 case when p_partkey%3=0 then 'CAS' else 'Name' end hint,
 cast(concat('2024-05-31 23:',lpad(cast(p_partkey%60 as string),2,'0'),':00') as timestamp) produced_at
from {part} where p_type in ('LARGE','MEDIUM')
"""
RELATIONS["fx_reference"] = """
select case when p_partkey%13=0 then cast(null as bigint) else cast(1000+p_partkey%500 as bigint) end cid, concat('Compound ',cast(p_partkey%500 as string)) title,
 case when p_partkey%2=0 then CAS[p_partkey] end cas,
 case when p_partkey%11=0 then '' else concat('C',cast(p_size as string),'H',cast(2*p_size as string)) end molecular_formula,
 case when p_partkey%17=0 then 'n/a' else cast(p_size*60 as string) end molecular_weight,
 case when p_partkey%7=0 then '' else concat('iupac-',cast(p_partkey%500 as string)) end iupac_name
from {part}
"""
RELATIONS["fx_products"] = """
select cast(p_partkey as bigint) product_id, case when p_size=1 then '  ' else p_name end name,
 case p_partkey%4 when 0 then CAS[p_partkey] when 1 then cast(null as string) when 2 then 'n/a' else concat('CAS ',CAS[p_partkey]) end cas_number
from {part}
"""
