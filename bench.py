"""Time every query of the catalog and print one JSON line.

BENCH_SF_DIR names the folder of the generated tables, BENCH_CPUS the number of
local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ebbline.catalog.queries import QUERIES
from ebbline.session import local_session


def run(spark, folder: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8, memory="16g")
    run(spark, folder, "feature_matrix")
    times = {name: round(run(spark, folder, name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "catalog_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
