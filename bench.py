"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from plymill.catalog import QUERIES
from plymill.session import local_session

HEADLINE = [
    "a01_dedupe",
    "c02_silver_games",
    "a04_player_months",
    "a05_opening_performance",
    "a08_time_pressure_without_evaluations",
    "c07_evaluated_positions",
    "j03_time_pressure",
    "q03_gate_on_candidates",
    "w01_player_rating_history",
    "a20_player_style",
    "m07_stratified_split",
    "m13_ranking_metrics",
    "o06_nearest_vectors",
    "t05_unique_events",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
