"""Time the headline queries and print one JSON line.

Inputs (fixtures) are written as Parquet before timing, as they would be stored tables. Every query runs
REPEAT times after one warm-up run, its whole result going to the ``noop`` sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compoundry.checks import catalog, fixtures  # noqa: E402
from compoundry.session import build_session  # noqa: E402

HEADLINE = [
    "A04_coverage", "J01_unlinked", "J05_family_by_name", "J07_link_registry", "J12_fuzzy_best", "J18_enrich_lookup",
    "L3_stream_enrich", "L4_compound_load", "L5_sds_mine", "M01_registry_from_properties", "M05_xref_from_documents",
    "T08_activity_stream", "U01_build_seed", "U02_map_compounds", "W01_cap_topn", "W03_main_component",
    "W05_best_compound_row", "X01_explode_lines", "X02_extract_entities", "X03_extract_components",
    "X04_extract_hazards", "X05_split_sections",
]
REPEAT = 3


class Stored(fixtures.Tables):
    """Fixtures as stored tables, so that a query is timed without the making of its input."""

    def __init__(self, spark, sf_dir, folder):
        super().__init__(spark, sf_dir)
        self.folder = folder

    def store(self):
        for name in fixtures.RELATIONS:
            super().__getattr__(name).write.mode("overwrite").parquet(f"{self.folder}/{name}")

    def __getattr__(self, name):
        if name in fixtures.RELATIONS:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        return super().__getattr__(name)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    work = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": work + "/shared",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load()
    tables = Stored(spark, sf_dir, work + "/input")
    tables.store()
    times: dict[str, float] = {}
    for name in wanted:
        fn = catalog.ENTRIES[name][0]
        runs = []
        for i in range(REPEAT + 1):
            if name == "L3_stream_enrich":
                from compoundry.checks import entries_stream

                entries_stream._RUNS.clear()
            t0 = time.perf_counter()
            fn(tables).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
