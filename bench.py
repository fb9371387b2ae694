"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads.
Every query is run to the end into a sink that drops its rows, once, in a session
that has been warmed up on another, small query. The API responses the zone flows
read are laid down before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from zonewright.catalog import REGISTRY  # noqa: E402
from zonewright.catalog.flows import zones  # noqa: E402
from zonewright.session import build_session  # noqa: E402

HEADLINES = [
    "clean_typed",
    "json_array_explode",
    "normalize_dim",
    "normalize_bridge",
    "dedup_latest",
    "upsert_merge",
    "upsert_idempotent",
    "enrich_left_project",
    "lookup_inner",
    "unnest_map",
    "limited_collect",
    "vector_topk",
    "vector_topk_batch",
    "embed_texts",
    "stream_upsert",
    "landing_tables",
    "trusted_tables",
    "serving_tables",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "zonewright-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["item_text"].run(spark, folder).write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or HEADLINES
    if any(name.endswith("_tables") for name in names):
        zones(spark, folder).dumps()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
