"""The end-to-end flows L1, L2, L4 and L5. L3 is ``streaming.worker.run_worker``.

Each takes tables and returns the tables after the run, by name; nothing is written in place. A frame
that several results need is written once to the shared folder (``durable``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import patterns as P
from ..functions.text import strip_ws
from ..operators import compounds as comp
from ..operators import dispatch, families, fuzzy, predicates, registry, report, seed, sheets
from ..operators import upsert as up
from ..operators.quality import json_column_repair
from ..session import discard, durable, release, settled
from ..schemas import SCHEMAS, empty
from ..sources import documents, messages, staging
from ..sources.versions import Versions

#: What a stored page holds besides its key.
PAGE_FACTS = ["has_text", "ocr_used", "ocr_conf", "text"]
#: What ``sds_update`` can derive from pages, with what each table is made from besides them.
DERIVED = {
    "sds_entity": set(), "sds_component": set(), "sds_hazard": set(), "sds_section": set(), "section_violation": set(),
    "sds_document": set(), "product_chem_xref": {"sds_entity", "sds_document", "chemical_registry"},
    "chemical_registry": {"sds_entity", "sds_document", "product_chem_xref"},
}
MINED = {"sds_entity", "sds_component", "sds_hazard", "sds_section", "section_violation"}
_STATE = {"sds_page", "sds_page_state", "sds_run"}


def stage(items_sheet: DataFrame, customers: DataFrame, sales: DataFrame, queries: DataFrame, item_id: Column) -> dict[str, DataFrame]:
    """L1: map the three sheets, repair and backfill items, and add the first query of each item.

    ``item_id`` is an expression over the item sheet (a sheet row number or a hash of its key).
    """
    mapped = staging.mapped_stage(items_sheet, P.ITEM_COLUMNS, id=item_id)
    items = staging.backfill_columns(json_column_repair(mapped, "raw"))
    first = up.reduce_first(seed.seed_query_hint(items), up.QUERY_KEYS, F.lit(0))
    return {
        "stg_item_master": items,
        "stg_customers": staging.mapped_stage(customers, P.CUSTOMER_COLUMNS),
        "stg_sales_lines": staging.numeric_coerce(staging.mapped_stage(sales, P.SALES_COLUMNS), ["qty", "revenue"]),
        "item_master_query": up.insert_only(queries, first, up.QUERY_KEYS),
    }


def orchestrate(
    items: DataFrame,
    staging_rows: DataFrame,
    xref: DataFrame,
    queries: DataFrame,
    log: DataFrame,
    compounds: DataFrame,
    chem_registry: DataFrame,
    product_family: DataFrame,
    now: Column,
    replay_unlinked: bool = False,
    unlinked_only: bool = False,
    wide_names: bool = False,
    cap_topn: int = P.QUERIES_PER_ITEM,
    produce_rest: bool = False,
    minutes: int = 30,
    alias: DataFrame | list[dict] | None = None,
    family: DataFrame | list[dict] | None = None,
) -> dict[str, DataFrame]:
    """L2: replay, seed, choose and send, register, link, assign families, report.

    ``alias`` and ``family`` are the stored pattern tables; fixed rows that they lack are added (M08), and both are
    returned. Without them, or as lists, just the given or the fixed rows are used.
    """
    grown = {}
    if isinstance(alias, DataFrame):
        alias = grown["name_alias_map"] = durable(seed.with_fixed_aliases(alias), "aliases")
    if isinstance(family, DataFrame):
        family = grown["chemical_family"] = durable(families.with_fixed_families(family), "family")
    if replay_unlinked:
        log = dispatch.clear_log(log, items, xref)
    scope = seed.unlinked(items, xref) if unlinked_only else None
    found = seed.build_seed(items, staging_rows, alias, scope, wide_names).drop("branch_no")
    queries = durable(up.insert_only(queries, found, up.QUERY_KEYS), "queries")
    chosen = dispatch.cap_topn(dispatch.unsent_unlinked(queries, items, xref, log), cap_topn).select(*queries.columns)

    def as_log(df: DataFrame) -> DataFrame:
        q = strip_ws(F.col("query"))
        rows = df.filter(q != "").select("source_item_id", q.alias("query"), F.lower("hint").alias("hint"), now.alias("produced_at"))
        return up.reduce_first(rows, up.QUERY_KEYS, F.col("produced_at"))

    sent_log = up.insert_only(log, as_log(chosen), up.QUERY_KEYS)
    sent = messages.request_messages(chosen, now)
    if produce_rest:
        rest = dispatch.unsent(queries, sent_log)
        sent = sent.unionByName(messages.request_messages(rest, now))
        sent_log = up.insert_only(sent_log, as_log(rest), up.QUERY_KEYS)
    new_registry = durable(
        up.upsert(chem_registry, registry.registry_from_properties(compounds), up.REGISTRY_KEYS, up.REGISTRY_FROM_PROPERTIES, now),
        "registry",
    )
    new_xref = durable(registry.link_registry(xref, new_registry, P.SOURCE_COMPOUND, now), "xref")
    by_name = families.family_by_name(items, product_family, family)
    assigned = durable(product_family.unionByName(by_name), "families")
    by_registry = families.family_by_registry(items, new_xref, new_registry, assigned, family)
    return {
        **grown,
        "item_master_query": queries,
        "messages": dispatch.dedupe_requests(sent),
        "produced_query_log": sent_log,
        "chemical_registry": new_registry,
        "product_chem_xref": new_xref,
        "product_family": assigned.unionByName(by_registry),
        "activity": report.activity_window(
            now, minutes, produced=(sent_log, "produced_at"), scraped=(compounds, "created_at"), linked=(new_xref, "updated_at")
        ),
        "coverage": report.coverage(items, new_xref),
    }


def compound_load(
    raw_results: DataFrame, items: DataFrame, queries: DataFrame, xref: DataFrame, chem_registry: DataFrame, now: Column
) -> dict[str, DataFrame]:
    """L4: clean a result file, map it to products, and bring links and registry up to date.

    Registry, links and counts come from results and products by key (``Matches``); the staged table, which has a row for
    every result and product of a text, is spelled out only by who reads it.
    """
    matches = comp.match_compounds(comp.clean_results(raw_results), items, queries)
    staged, counts = matches.staged(), durable(matches.counts(), "counts")
    new_registry = durable(
        up.upsert(chem_registry, comp.registry_from_results(matches.reached()), up.REGISTRY_KEYS, up.REGISTRY_FROM_RESULTS, now), "registry"
    )
    merged = up.upsert(xref, comp.xref_from_results(matches.links()), up.XREF_KEYS, up.XREF_FROM_RESULTS, now)
    new_xref = durable(registry.link_registry(durable(merged, "links"), new_registry, P.SOURCE_COMPOUND, now), "xref")
    return {
        "stg_pubchem_results": staged,
        "chemical_registry": new_registry,
        "product_chem_xref": new_xref,
        "counts_before": report.stage_counts(raw_results, counts, xref, chem_registry),
        "counts_after": report.stage_counts(raw_results, counts, new_xref, new_registry),
        "incomplete": predicates.incomplete_rows(staged),
        "product_properties": registry.product_properties(items, new_xref, new_registry),
    }


def sds_mine(
    docs: DataFrame, pages: DataFrame, items: DataFrame, xref: DataFrame, chem_registry: DataFrame, now: Column,
    relink: bool = False,
) -> dict[str, DataFrame]:
    """Mine the pages of safety sheets, attach documents to products, and add number links.

    What holds texts besides the results is removed when its last reader has run, so the shared folder doesn't hold the
    pages several times over.
    """
    lines = settled(sheets.mined_lines(pages), "lines")
    entities = durable(sheets.extract_entities(lines), "entities")
    release(pages.sparkSession)
    components = durable(sheets.extract_components(lines), "components")
    release(pages.sparkSession)
    hazards = durable(sheets.extract_hazards(lines), "hazards")
    discard(lines)
    pieces = settled(sheets.section_pieces(pages), "pieces")
    sections = durable(sheets.sections_of(pieces), "sections")
    release(pages.sparkSession)
    violations = durable(sheets.section_violations(pieces), "violations")
    discard(pieces)
    attached = durable(fuzzy.attach_products(docs, fuzzy.fuzzy_best(docs, items)), "documents")
    main = sheets.main_component(components)
    new_items = sheets.backfill_cas(items, attached, main)
    merged = durable(
        up.upsert(xref, registry.xref_from_documents(attached, entities), up.XREF_KEYS, up.XREF_FROM_DOCUMENTS, now), "links"
    )
    new_registry = durable(
        up.insert_only(
            chem_registry,
            registry.registry_for_numbers(entities).withColumn("created_at", now).withColumn("updated_at", now),
            up.REGISTRY_KEYS,
        ),
        "registry",
    )
    new_xref = registry.link_registry(merged, new_registry, "cas", now)
    if relink:
        new_xref = registry.relink_to_compound(durable(new_xref, "linked"), new_registry, now)
    new_xref = durable(new_xref, "xref")
    discard(merged)
    return {
        "sds_document": attached,
        "sds_entity": entities,
        "sds_component": components,
        "sds_hazard": hazards,
        "sds_section": sections,
        "section_violation": violations,
        "item_master_clean": new_items,
        "product_chem_xref": new_xref,
        "chemical_registry": new_registry,
        "summary": report.sds_summary(attached, entities, components, hazards, new_xref),
        "section_pivot": sheets.section_pivot(docs, sections),
    }


def sds_update(
    store: Versions, docs: DataFrame, pages: DataFrame, items: DataFrame, now: Column, tables: Iterable[str] | None = None
) -> int:
    """L5 over what arrives, on published tables (M09-M14): returns the version it publishes.

    ``docs`` has ``doc_id``, ``product_id``, ``title``, ``filename``, ``file_sha256``, one row for each; ``pages`` has the
    columns of ``sds_page``, one row for each page. Either may repeat what is stored: a page counts as changed where its
    digest is new, and only documents with a changed page are mined. Their rows in the derived tables are replaced by
    document; those of other documents stay. Pages are stored as they arrive, with the number of their run; which run's
    row of a page holds is kept beside them (``sds_page_state``), so neither stored texts are copied, nor those of
    unchanged documents read again. Of a changed document's unchanged pages only the runs that hold them are read.

    Documents without product are matched again, as items may be new. Links and registry rows are added for documents
    that changed or got their product in this run, and none is taken away. ``items`` gets no new numbers here; they are
    derived from the published tables (``sheets.backfill_cas``).

    A store whose readers want some of the derived tables only names them in ``tables``; these and what they are made from
    (``DERIVED``) are kept, and the work for the others isn't done. Pages and their states are always kept. As a page that
    is stored isn't mined again, all runs of a store name the same tables.
    """
    spark, version = pages.sparkSession, store.current()
    run = version + 1
    wants = set(DERIVED) if tables is None else set(tables).union(*[DERIVED[n] for n in tables])
    if version and set(store.manifest(version)) & set(DERIVED) != wants:
        raise ValueError(f"the store keeps {sorted(set(store.manifest(version)) - _STATE)}, not {sorted(wants)}")

    def stored(name: str) -> DataFrame:
        found = store.table(name, version)
        return empty(spark, name) if found is None else found

    digest = F.sha2(F.to_json(F.struct(*PAGE_FACTS), {"ignoreNullFields": "false"}), 256)
    arrived = durable(pages.select("doc_id", "page_no", digest.alias("digest")), "digests")
    state = stored("sds_page_state")
    changed, new_pages = arrived, pages.dropna(subset=up.PAGE_KEYS)
    if version:  # a first run has nothing to compare with, so its texts need no shuffle
        known = state.select("doc_id", "page_no", F.col("digest").alias("_digest"))
        changed = durable(arrived.join(known, up.PAGE_KEYS, "left").filter(~F.col("digest").eqNullSafe(F.col("_digest"))).select(
            "doc_id", "page_no", "digest"), "changed")
        new_pages = pages.join(changed.select(*up.PAGE_KEYS), up.PAGE_KEYS, "left_semi")
    touched = durable(changed.select("doc_id").distinct(), "touched")
    same = state.join(changed, up.PAGE_KEYS, "left_anti")
    new_state = same.unionByName(changed.withColumn("run", F.lit(run)))

    fresh = store.write("sds_page", new_pages.select(*up.PAGE_KEYS, *PAGE_FACTS).withColumn("run", F.lit(run)))
    release(spark)
    scratch = [arrived, touched] if changed is arrived else [arrived, changed, touched]
    replaced: dict[str, DataFrame | dict] = {"sds_page_state": new_state}
    if wants & MINED:
        wanted = durable(same.join(touched, "doc_id", "left_semi").select(*up.PAGE_KEYS, "run"), "wanted")
        scratch.append(wanted)
        mined = store.read(fresh).select("doc_id", "page_no", "text")
        folders = stored("sds_run").join(wanted.select("run").distinct(), "run", "left_semi").select("folder")
        held = store.table("sds_page", version, [r["folder"] for r in folders.collect()])
        if held is not None:
            held = durable(held.join(wanted, [*up.PAGE_KEYS, "run"], "left_semi").select("doc_id", "page_no", "text"), "held")
            scratch.append(held)
            mined = mined.unionByName(held)

        def keep(name: str, rows: DataFrame) -> None:
            old = stored(name).join(touched, "doc_id", "left_anti")
            replaced[name] = store.write(name, old.unionByName(rows.select(*old.columns)))
            release(spark)

        _mine(mined, wants & MINED, keep)

    if "sds_document" in wants:
        before = stored("sds_document")
        counted = sheets.page_count(new_state).withColumnRenamed("pages", "_pages")
        merged = up.upsert(before, docs, up.DOCUMENT_KEYS, up.DOCUMENT_BY_DIGEST).join(counted, "doc_id", "left").withColumn(
            "pages", F.coalesce("_pages", F.lit(0)).cast("int")).select(*before.columns)
        merged = durable(merged, "documents")
        scratch.append(merged)
        best = fuzzy.fuzzy_best(merged.filter("product_id is null"), items)
        replaced["sds_document"] = store.write("sds_document", fuzzy.attach_products(merged, best))

    if "product_chem_xref" in wants:
        now_owned = store.read(replaced["sds_document"])
        earlier = before.filter("product_id is not null").select("doc_id")
        linked = touched.unionByName(now_owned.filter("product_id is not null").select("doc_id").join(earlier, "doc_id", "left_anti")).distinct()
        found = durable(store.read(replaced["sds_entity"]).join(linked, "doc_id", "left_semi"), "found")
        scratch.append(found)
        links = up.upsert(
            stored("product_chem_xref"), registry.xref_from_documents(now_owned, found), up.XREF_KEYS, up.XREF_FROM_DOCUMENTS, now, delta=True)
        numbers = registry.registry_for_numbers(found).withColumn("created_at", now).withColumn("updated_at", now)
        replaced["chemical_registry"] = store.write(
            "chemical_registry", up.insert_only(stored("chemical_registry"), numbers, up.REGISTRY_KEYS))
        links = durable(links, "links")
        scratch.append(links)
        replaced["product_chem_xref"] = registry.link_registry(links, store.read(replaced["chemical_registry"]), "cas", now)
    runs = spark.createDataFrame([(run, f) for f in fresh["folders"]], SCHEMAS["sds_run"])
    published = store.publish(replaced, {"sds_page": fresh, "sds_run": runs}, based_on=version)
    discard(*scratch)
    return published


def _mine(mined: DataFrame, wants: set[str], keep: Callable[[str, DataFrame], None]) -> None:
    """Hands the tables in ``wants`` that are made from texts alone to ``keep``, which writes them. What one of them reads
    is not written for it first; what was written is removed when its last reader has run. ``mined`` is a stored table."""
    by_line = {"sds_entity": sheets.extract_entities, "sds_component": sheets.extract_components, "sds_hazard": sheets.extract_hazards}
    by_piece = {"sds_section": sheets.sections_of, "section_violation": sheets.section_violations}
    for makers, cut, label in ((by_line, sheets.mined_lines, "lines"), (by_piece, sheets.section_pieces, "pieces")):
        chosen = {n: f for n, f in makers.items() if n in wants}
        if chosen:
            source = cut(mined)
            between = source._made_from
            if len(chosen) > 1:
                source = settled(source, label)
                between = [source]
            for name, make in chosen.items():
                keep(name, make(source))
            discard(*between)


def sds_arrivals(
    store: Versions, files: DataFrame, items: DataFrame, now: Column, checkpoint: str,
    reader: Callable = documents.text_pages, continuous: str | None = None,
) -> StreamingQuery:
    """L5 from the files on: S05 and S06 on a stream of files (``documents.arriving_files``), then ``sds_update``.

    Each micro-batch is one version. A document is a distinct content; a file that repeats one only gives it its title.
    A batch that is replayed finds its pages stored and mines none. Without ``continuous`` (a trigger interval) it takes
    what is there and ends; files per batch are an option of the stream.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        held = durable(batch.select("path", "content"), "files")  # files may change or go while they are read
        found = documents.documents_of(held)
        docs = found.select(
            documents.document_id(F.col("file_sha256")).alias("doc_id"), F.lit(None).cast("bigint").alias("product_id"),
            "title", "filename", "file_sha256")
        pages = documents.page_triage(documents.pages_of(held, reader)).select(
            documents.document_id(F.col("file_sha256")).alias("doc_id"), "page_no", "has_text",
            F.lit(False).alias("ocr_used"), F.lit(None).cast("double").alias("ocr_conf"), "text")
        pages = durable(pages, "pages")
        sds_update(store, docs, pages, items, now)
        discard(held, pages)

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take).trigger(**trigger).start()


def current_pages(store: Versions, version: int | None = None, with_run: bool = False) -> DataFrame:
    """The pages of a published version, without those that later runs replaced; ``with_run`` shows which run stored them."""
    pages, state = store.table("sds_page", version), store.table("sds_page_state", version)
    held = pages.join(state.select(*up.PAGE_KEYS, "run"), [*up.PAGE_KEYS, "run"], "left_semi")
    return held if with_run else held.drop("run")
