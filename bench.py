"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all cores) set the
input and the parallelism. Each query is planned and run in full; its rows go to a sink
that discards them. One untimed query warms the session up; each time is the better of
two runs, as code compiled in the first would otherwise count against whoever comes first.
The whole load, which writes ten tables from scratch, is run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelwright.catalog.queries import all_queries  # noqa: E402
from panelwright.session import build_session  # noqa: E402

HEADLINE = [
    "q1_top_sector_share",
    "q2_intensity_topk",
    "q3_emission_breakdown",
    "q3_safe",
    "q4_yearly_leaders",
    "q5_development_panel",
    "q5_safe",
    "q6_renewable_split",
    "load_sector_country",
    "load_power_source_country",
    "load_development",
    "tidy_energy_wide",
    "unpivot_years",
    "pivot_categories",
    "dedup_keep_first",
    "top_row_per_group",
    "upsert_keep_old",
    "accent_fold_lookup",
    "casefold_text",
    "key_duplicates",
    "fk_orphans",
    "load_everything",
    "store_upsert",
    "unmatched_names",
    "audit_panel",
    "audit_star",
    "outer_merge_hot_key",
    "fan_out_three_sides",
    "ordered_export",
    "melt_by_header",
    "workbook_sectors",
]
ONCE = {"load_everything"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("union_years")
    times = {name: min(run(name) for _ in range(1 if name in ONCE else 2)) for name in sys.argv[1:] or HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
