"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from tributary.plans import catalog
from tributary.session import build_session

HEADLINE = (
    "range_filter_any feature_filter global_search multi_level_sort_page series_groups_price_rep group_summary facets top_k_quota "
    "column_profile resolve_all fuse_values merge_verified containment_enrich cell_diff candidate_pairs components audit_regression "
    "page_links nested_properties event_windows facet_cube"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    queries, seconds = catalog.queries(), {}
    for name in HEADLINE:
        best = None
        for _ in range(2):  # the first run compiles
            start = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(time.time() - start, best or 1e9)
        seconds[name] = round(best, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
