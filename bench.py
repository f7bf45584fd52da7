"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (cores), BENCH_QUERIES (names,
separated by commas; all of them with "all"), BENCH_RUNS (timed runs per query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402
from tidemark.workload import QUERIES  # noqa: E402

HEADLINE = (
    "scd1_tier scd2_versions scd2_incremental temporal_join money_parse mixed_dates alias_resolve "
    "star_observations quarterly_rollup latest_view star_summary profile_industry rfm_segments "
    "event_validate cdc_apply cdc_sync cdc_stream contract_scorecard null_profile "
    "tfidf_vocab tfidf_search vector_topk vector_neighbours sql_audit"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE

    spark = build_session(
        "bench",
        cores,
        **{"spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    times: dict[str, float] = {}
    for name in names:
        run(name)  # warm-up
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "shuffle_partitions": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
