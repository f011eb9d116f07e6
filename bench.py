"""Headline queries, timed: one warm-up, then the median of the runs. Prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8) and ``BENCH_RUNS`` (default 2) set the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayline import session
from stayline.plans import registry

HEADLINE = (
    "continuity_by_guid episode_order_stats_title episode_order_stats_lastspace train_frame count_complete word_count "
    "encode_labels click_decode decode_viewlog join_inner_multi sql_join_agg join_full join_cogroup sample_exact rebalance "
    "minmax_scale gram coo_matmul vec_norm pv_uv auc linreg_gd nb_sql pagerank_top stream_pv_uv churn_model_continuity churn_model_classic"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session.build(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    seconds = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
