"""Time the headline queries. Prints one JSON line.

`$BENCH_SF_DIR` names the tables, `$BENCH_CPUS` the cores of the local master. Each query runs once
to warm up and `$BENCH_RUNS` times to be measured; the best time counts. Names (or their beginnings)
given as arguments choose other queries; `all` takes every registered one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from runlens import get_spark  # noqa: E402
from runlens.plans import QUERIES, runner  # noqa: E402

HEADLINE = [
    "loss_summary", "first_terminal", "known_job_filter", "state_counts", "running_counts", "dense_ids", "kill_noop",
    "decommission_pairs", "bench_common", "bench_last_wins", "natural_sort", "map_in_pandas", "to_allocate", "mode_rules",
    "kv_list_parse", "resolve_job", "resolve_resources", "required_rules", "typed_conf", "map_layers", "merge_by_name",
    "deep_merge", "pod_count_check", "check_results", "stream_first_terminal", "stream_state_counts",
] + [name for name in QUERIES if name.startswith("w")]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = HEADLINE
    if sys.argv[1:]:
        chosen = [n for n in QUERIES if sys.argv[1] == "all" or n.startswith(tuple(sys.argv[1:]))]
    spark = get_spark(f"local[{cpus}]", app="bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                      extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g",
                             "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in chosen:
        run, best = runner(name), float("inf")
        for attempt in range(runs + 1):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
