"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores.  Each query is run whole
into a sink that keeps nothing; the time of the best of BENCH_RUNS runs counts.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidefold.plans import QUERIES  # noqa: E402
from tidefold.session import build_session  # noqa: E402

HEADLINE = (
    "apply_changes",
    "apply_changes_lineitem",
    "merge_changes",
    "dropped_updates",
    "snapshot_plus_log",
    "dump_rows",
    "dump_rows_documents",
    "dump_columns",
    "rotate_attribution",
    "rows_to_records",
    "status_transitions",
    "bulk_lines",
    "reconcile",
    "doc_diff",
    "lenient_equal",
    "pk_collisions_lineitem",
    "stream_apply",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {best:.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
