"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the number of local threads. Each query
runs once to warm up and then ``BENCH_RUNS`` times, of which the fastest counts. Results are written to
Spark's ``noop`` sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from viewmill.catalog.queries import QUERIES, stored_star  # noqa: E402
from viewmill.session import build_session  # noqa: E402

HEADLINE = (
    "enriched_views",
    "views_from_json",
    "geo_lookup",
    "geo_lookup_shuffled",
    "device_dims",
    "traffic_source",
    "dim_store",
    "fact_views",
    "fact_insert_if_absent",
    "lineitem_insert_if_absent",
    "duplicate_keys",
    "daily_top_products",
    "daily_views_by_country",
    "daily_traffic_breakdown",
    "product_rank",
    "mart_upsert",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {"star_load": seconds(lambda: stored_star(spark, sf_dir))}
    for name in HEADLINE:
        seconds(run(name))
        times[name] = min(seconds(run(name)) for _ in range(runs))
    # Includes starting the query, committing its offsets and all writes of the star.
    times["stream_star_load"] = seconds(run("stream_star_load"))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
