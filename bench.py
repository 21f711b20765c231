"""Wall-clock bench of the headline queries.

Runs each query's full plan into Spark's ``noop`` sink (every row computed,
nothing collected) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints
one JSON line. One untimed warm-up query runs first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from glossa.plans.registry import load_all  # noqa: E402
from glossa.session import build_session  # noqa: E402

HEADLINE = [
    "e09_post_process",        # flagship: ranks -> final blend -> rules
    "e04_rank_blend",          # three power-mean families, three global ranks
    "e08_tta_rollup",
    "w01_pct_rank",
    "a10_roc_auc",
    "t11_clean_text_mono",
    "k03_split_windows",
    "k07_mlm_mask",
    "g02_stratified_chunks",
    "g01_class_balance",
    "au04_length_router",
    "u02_dedupe_keep_first",
    "m02_batch_score",
    "d01_prepare_train_split",  # whole-file preparation: chunks -> encode -> windows
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    queries, _ = load_all()
    # JVM start-up and first code generation are not part of any query: one
    # untimed pass over the text table warms them.
    queries["t08_clean_text"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        queries[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
