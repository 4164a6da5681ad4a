"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).  A query counts from
building its plan to the last row; the result goes to a sink that discards it.  Each query
runs once to warm up and then twice; the better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starforge.plans.registry import all_queries
from starforge.session import local_session

HEADLINE = (
    "flagship",
    # lookups and filters
    "fil_2", "fil_3", "fil_7", "fil_10",
    # aggregation
    "agg_3", "agg_9", "agg_10", "agg_13", "agg_15",
    # joins; joi_7 and joi_8 are the two forms of the anti join
    "joi_2", "joi_5", "joi_7", "joi_8", "joi_10", "joi_15",
    # windows, top k, sets, subqueries
    "win_1", "win_2", "win_3", "win_4", "win_6", "win_7", "srt_2", "set_4", "sub_2",
    # warehouse
    "dim_1", "dim_2", "nrm_2", "fct_2", "fct_3", "fct_5", "lod_1", "lod_2", "src_4", "inc_2", "inc_3",
    # quality
    "dq_9", "dq_11",
    # text and vectors
    "txt_3", "txt_4", "txt_5", "txt_7", "txt_9", "txt_11", "vec_1", "vec_2", "vec_4",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus)
    queries = all_queries()
    times: dict[str, float] = {}
    for key in only or HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[key] = round(min(runs[1:]), 3)
    total = round(sum(times.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": times, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
