"""Headline queries on local cores; prints one JSON line.

Every query runs to completion into a no-op sink, once, after one short warm-up job. Queries that
write intermediate tables include that time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hexmosaic.plans.queries import QUERIES
from hexmosaic.session import local_session

# one per stage of the pipeline, then the consumers
HEADLINE = [
    "boundary_parts",
    "polyfill_center",
    "polyfill_overlap",
    "polyfill_center_odd",
    "raster_pixels",
    "population_by_cell",
    "stage_osm",
    "clip_and_index",
    "group_counts",
    "category_entropy",
    "neighbour_sums",
    "hex_features",
    "point_in_polygon",
    "admin_tags",
    "match_points",
    "dedupe_pois",
    "quantile_breaks",
    "explore_categories",
    "snapshot_asof",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    line = {
        "metric": "total seconds of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
