"""Rules of whole tables: C01-C08 judged together on write, and C10 along all references.

Wide rows are read for the conditions of their own and joined once with what was found; everything that needs another
row (references, unique keys) runs on row numbers and key columns.
"""

from __future__ import annotations

from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CONSTRAINTS, Constraints
from ..session import durable
from .skew import split_hot_join


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def gate(
    rows: DataFrame,
    constraints: Constraints,
    parents: dict[str, DataFrame] | None = None,
    stored: DataFrame | None = None,
    order: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows that may be added to a table, and the others with ``rules``, the sorted names of what they break.

    A condition that yields NULL passes, a NULL reference too, and a key that contains NULL is never a duplicate. Of
    rows with one key the first by ``order`` stays (exact ties: any one); rows that break something else hold no key,
    and unique keys are judged one after the other, each among the rows that are left. A key in ``stored`` is taken.
    References are judged only where ``parents`` has the table. Every row is in exactly one of the two results,
    repeated rows as often as they occur; an empty table gives two empty results.
    """
    order = order or []
    broken = [F.when(~F.coalesce(F.expr(r), F.lit(True)), F.lit(n)) for n, r in constraints.rules.items()]
    found = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    judged = durable(rows.select("*", found.alias("_broken"), F.monotonically_increasing_id().alias("_row")), "judged")
    keys = {n: [f"_{n}_{i}" for i in range(len(e))] for n, e in constraints.unique.items()}
    narrow = judged.select(
        "_row", (F.size("_broken") == 0).alias("_clean"),
        F.struct(*[F.col(c) for c in order], "_row").alias("_order"),
        *[F.col(c).alias("_ref_" + c) for c in constraints.references],
        *[F.expr(e).alias(k) for n, es in constraints.unique.items() for k, e in zip(keys[n], es)],
    )
    bad = []
    for column, (table, key) in constraints.references.items():
        if table in (parents or {}):
            ref = "_ref_" + column
            known = parents[table].select(F.col(key).alias(ref)).distinct()
            lost = split_hot_join(narrow.select("_row", ref).dropna(subset=[ref]), known, [ref], "left_anti")
            bad.append(durable(lost.select("_row", F.lit(column + "_known").alias("rule")), "lost"))
    passing = narrow.filter("_clean").drop("_clean")
    for lost in bad:
        passing = passing.join(lost.select("_row"), "_row", "left_anti")
    for name, es in constraints.unique.items():
        k = keys[name]
        held = passing.select("_row", "_order", *k).dropna(subset=k)
        # counted in every task first; a hot key is one row here
        first = held.groupBy(*k).agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n"))
        more = split_hot_join(held, first.filter("_n > 1").drop("_n"), k, unique_right=True).filter("_order <> _first").select("_row")
        if stored is not None:
            taken = stored.select(*[F.expr(e).alias(c) for c, e in zip(k, es)]).dropna().distinct()
            more = more.union(split_hot_join(held, taken, k, "left_semi").select("_row")).distinct()
        more = durable(more.select("_row", F.lit(name + "_unique").alias("rule")), "repeated")
        bad.append(more)
        passing = passing.join(more.select("_row"), "_row", "left_anti")
    if bad:
        verdict = union(bad).groupBy("_row").agg(F.collect_set("rule").alias("_more"))  # a row breaks each rule once
        judged = judged.join(verdict, "_row", "left")
        all_rules = F.concat("_broken", F.coalesce("_more", F.array().cast("array<string>")))
    else:
        all_rules = F.col("_broken")
    judged = durable(judged.select(*rows.columns, F.array_sort(all_rules).alias("_rules")), "verdicts")
    accepted = judged.filter(F.size("_rules") == 0).drop("_rules")
    return accepted, judged.filter(F.size("_rules") > 0).withColumnRenamed("_rules", "rules")


def cascade(
    tables: dict[str, DataFrame], gone: dict[str, DataFrame], constraints: dict[str, Constraints] = CONSTRAINTS
) -> dict[str, DataFrame]:
    """The tables after rows are deleted from some of them, with all rows that refer to deleted ones.

    ``gone`` has, by table, a frame with the keys that are deleted. Parents come before children, at any depth, so one
    pass does. Only deleted keys travel, not the surviving ones; a NULL reference stays, and so do references to rows
    that were never there. Tables that nothing leads to come back as they are. References that run in a circle raise
    ``graphlib.CycleError``.
    """
    parents = {t: [(c, p) for c, (p, _) in constraints[t].references.items() if p in tables] for t in tables if t in constraints}
    depends = {t: {p for _, p in parents.get(t, [])} for t in tables}
    deleted: dict[str, DataFrame] = {}
    out = dict(tables)
    for table in TopologicalSorter(depends).static_order():
        rules = constraints.get(table, Constraints())
        ways = [(c, deleted[p].withColumnRenamed(constraints[p].key, c)) for c, p in parents.get(table, []) if p in deleted]
        if table in gone:
            ways.append((rules.key, gone[table].select(rules.key).dropna().distinct()))
        if not ways:
            continue
        if rules.key and any(table in d for d in depends.values()):  # somebody refers to these rows
            hit = [split_hot_join(tables[table], keys, [c], "left_semi").select(rules.key) for c, keys in ways]
            deleted[table] = durable(union(hit).dropna().distinct(), "deleted")
        for c, keys in ways:
            out[table] = split_hot_join(out[table], keys, [c], "left_anti").select(*tables[table].columns)
    return out
