"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadforge.catalog import registry  # noqa: E402
from leadforge.session import local_session  # noqa: E402

HEADLINE = [
    "add_tli", "tradeline_features", "customer_category", "current_utils", "dpd_features", "enquiry_features",
    "pii_master", "mark_duplicates", "match_phone", "partner_process", "assign_bureau_ids", "bureau_export",
    "score_gate", "batch_summary", "scrub_batch_monitor", "parse_file_columns", "lender_view_prefr_ar",
    "shortlist_filter_files", "map_to_offers_schema", "bureau_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    queries = registry.queries()
    timings = {}
    for key in HEADLINE:
        started = time.time()
        queries[key](spark, folder).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.time() - started, 3)
        print(f"{key}: {timings[key]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
