"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stopwise.operators.joins import release_dimensions  # noqa: E402
from stopwise.plans import catalog  # noqa: E402
from stopwise.session import build_session  # noqa: E402

HEADLINES = ("clean_pings", "schedule_master", "route_geometry", "nearest_stop",
             "nearest_stop_grid", "asof_nearest", "asof_next", "true_delay", "live_status",
             "speed_instant", "arrivals_visit", "training_set", "vehicle_replay",
             "mae_summary", "stream_vehicle_state")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINES

    def run(name: str) -> float:
        release_dimensions()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("nearest_stop", "speed_instant"):
        run(name)
    seconds = {name: run(name) for name in names}
    print(json.dumps({"metric": "headline query time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
