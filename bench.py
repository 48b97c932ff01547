"""Time the headline queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urbanweave.plans.queries import QUERIES  # noqa: E402
from urbanweave.session import build_session  # noqa: E402

HEADLINE = [
    "shard_categories", "way_assembly", "road_tag_rules", "building_tag_rules", "degree_histogram", "lamps", "signs",
    "carriageway_hits", "cover_pairs", "lod_cells", "strips_cut_by_rank", "junction_candidates", "occupancy_paint",
    "distance_transform", "relief_and_slope", "square_heights",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__driver__memory="16g", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=str(4 * int(cpus)),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
