"""Table schemas, as DDL strings, and what their rows must fulfil. Text sources are read as text and converted;
nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

SCHEMAS: dict[str, str] = {
    "stg_item_master": "id bigint, sku string, name string, description string, cas string, brand string, "
    "family string, vendor string, raw string, loaded_at timestamp",
    "stg_customers": "customer_code string, name string, segment string, region string, raw string",
    "stg_sales_lines": "tx_date string, customer_code string, sku string, qty double, revenue double, raw string",
    "item_master_clean": "source_item_id bigint, sku string, name string, cas string",
    "item_master_query": "source_item_id bigint, query string, hint string, seq bigint",
    "produced_query_log": "source_item_id bigint, query string, hint string, produced_at timestamp",
    "name_alias_map": "pattern string, replacement string, hint string, note string",
    "scraped_compounds": "query string, source string, external_id string, properties string, "
    "created_at timestamp, updated_at timestamp",
    "scraping_logs": "job_type string, query string, source string, status string, message string, attempt int, "
    "created_at timestamp",
    "product_chem_xref": "product_id bigint, source string, external_id string, cas string, match_confidence double, "
    "properties_ref string, chem_id string, updated_at timestamp",
    "chemical_registry": "source string, external_id string, cid bigint, canonical_name string, iupac_name string, "
    "formula string, mol_weight decimal(18,6), canonical_smiles string, inchi string, inchikey string, "
    "synonyms array<string>, properties string, created_at timestamp, updated_at timestamp",
    "chemical_family": "family_id int, name string, pattern string, note string",
    "product_family": "product_id bigint, family_id int, confidence double",
    "stg_pubchem_results_raw": "query_name string, query_hint string, source_item_id string, CID string, Title string, "
    "IUPACName string, MolecularFormula string, MolecularWeight string, CanonicalSMILES string, InChI string, "
    "InChIKey string, Synonyms string",
    "stg_pubchem_results": "product_id bigint, pubchem_cid string, cas string, name string, iupac_name string, "
    "molecular_formula string, molecular_weight decimal(18,6), canonical_smiles string, inchi string, inchikey string",
    "sds_document": "doc_id bigint, product_id bigint, title string, filename string, file_sha256 string, pages int",
    "sds_page": "doc_id bigint, page_no int, has_text boolean, ocr_used boolean, ocr_conf double, text string",
    "sds_page_state": "doc_id bigint, page_no int, digest string, run int",
    "sds_run": "run int, folder string",
    "section_violation": "doc_id bigint, page_no int, piece int, section_no int, title string, text string",
    "sds_section": "doc_id bigint, section_no int, title string, text string",
    "sds_entity": "doc_id bigint, page_no int, section string, entity_type string, value string, norm_value string",
    "sds_component": "doc_id bigint, page_no int, name string, cas string, cas_norm string, name_key string, "
    "conc_low double, conc_high double, conc_units string",
    "sds_hazard": "doc_id bigint, page_no int, section string, code string, statement string",
    "ingest_dlq": "query string, reason string, stage string, attempts int, payload_json string, created_at timestamp",
    "companies": "company_id bigint, name string, location string, industry string, contact_email string",
    "products": "product_id bigint, name string, cas_number string, molecular_formula string, "
    "molecular_weight decimal(12,6), description string",
    "company_product_relationships": "relationship_id bigint, company_id bigint, product_id bigint, relationship_type string",
    "chemical_properties": "property_id bigint, product_id bigint, property_name string, property_value string, "
    "unit string, source string, measured_at date",
    "users": "user_id bigint, email string, full_name string",
    "user_interactions": "interaction_id bigint, user_id bigint, product_id bigint, action string, "
    "occurred_at timestamp, metadata string",
}


def empty(spark, table: str):
    """An empty table; the state before the first run. The plan knows that it is empty, so joins with it cost nothing."""
    return spark.createDataFrame([], SCHEMAS[table]).limit(0)


@dataclass(frozen=True)
class Constraints:
    """What the rows of a table must fulfil; everything is SQL over its columns.

    ``rules`` are conditions by name, ``unique`` lists of expressions by name, ``references`` name a column's parent table
    and column. Rows go with their parent. ``key`` is what children refer to.
    """

    rules: dict[str, str] = field(default_factory=dict)
    unique: dict[str, list[str]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    key: str | None = None


def _present(*columns: str) -> dict[str, str]:
    return {f"{c}_present": f"{c} is not null" for c in columns}


def _of_document(*present: str, unique: dict[str, list[str]] | None = None, **rules: str) -> Constraints:
    return Constraints({**_present("doc_id", *present), **rules}, unique or {}, {"doc_id": ("sds_document", "doc_id")})


# The conditions, keys and references of the stored tables.
CONSTRAINTS: dict[str, Constraints] = {
    "users": Constraints(_present("user_id"), {"user": ["user_id"], "email": ["email"]}, key="user_id"),
    "companies": Constraints(
        {**_present("company_id", "name"), "name_text": "length(trim(name)) > 0"}, {"company": ["company_id"]}, key="company_id"),
    "products": Constraints(
        {**_present("product_id", "name"), "name_text": "length(trim(name)) > 0", "cas_form": r"cas_number rlike r'^[0-9]{2,7}-[0-9]{2}-[0-9]\z'"},
        {"product": ["product_id"], "cas": ["cas_number"]}, key="product_id"),
    "company_product_relationships": Constraints(
        {**_present("company_id", "product_id", "relationship_type"), "type_known": "relationship_type in ('supplier','manufacturer','customer')"},
        {"relationship": ["company_id", "product_id", "relationship_type"]},
        {"company_id": ("companies", "company_id"), "product_id": ("products", "product_id")}, "relationship_id"),
    "chemical_properties": Constraints(
        {**_present("product_id", "property_name", "property_value"), "name_text": "length(trim(property_name)) > 0"},
        {"property": ["product_id", "property_name", "coalesce(source, '')"]}, {"product_id": ("products", "product_id")}, "property_id"),
    "user_interactions": Constraints(
        {**_present("user_id", "product_id", "action", "occurred_at"), "action_known": "action in ('view','search','favorite','download')"},
        {"interaction": ["user_id", "product_id", "action", "occurred_at"]},
        {"user_id": ("users", "user_id"), "product_id": ("products", "product_id")}, "interaction_id"),
    "name_alias_map": Constraints(
        {**_present("pattern", "replacement", "hint"), "hint_known": "hint in ('name','cas')"}, {"pattern": ["pattern"]}),
    "item_master_query": Constraints({"hint_known": "hint in ('auto','name','cas')"}),
    "sds_document": Constraints(
        _present("doc_id", "filename", "file_sha256", "pages"), {"document": ["doc_id"], "file": ["file_sha256"]}, key="doc_id"),
    "sds_page": _of_document("page_no", unique={"page": ["doc_id", "page_no"]}),
    "sds_section": _of_document(
        "section_no", unique={"section": ["doc_id", "section_no"]}, section_range="section_no between 1 and 16"),
    "sds_entity": _of_document(
        "entity_type", unique={"entity": ["doc_id", "entity_type", "norm_value"]},
        type_known="entity_type in ('CAS','UN','GHS_H','GHS_P','SIGNAL','NAME')"),
    "sds_component": _of_document(),
    "sds_hazard": _of_document(),
}
