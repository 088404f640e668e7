"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma separated, default the list below) steer the run.
"""

from __future__ import annotations

import json
import os
import time

from clickweave import catalog
from clickweave.catalog import features
from clickweave.session import build_session

HEADLINE = (
    "s02_tsv_scan", "s05_history_text_sink", "f04_engagement_threshold", "a03_count_per_key",
    "a08_history_lists", "a11_funnel", "o01_global_sort", "d02_latest_per_key",
    "st1_merge_window", "st4_backfill", "p01_item_support", "p03_preprocess",
    "p04_label_encoding", "w01_running_prefix", "p11_prepare", "m06_masked_pooling",
    "m12_interest_routing", "m16_dense_layers", "m20_user_vectors", "r01_exact_search",
    "r03_ivf_search", "r05_pq_search", "r09_hit_rate",
)
CLICK_ROWS = "lineitem"
WARM_UP = ("p11_prepare", "r01_exact_search")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session("bench", f"local[{cpus}]", cpus, os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.load()
    rows = spark.read.parquet(f"{sf}/{CLICK_ROWS}.parquet").count()
    took: dict[str, float] = {}

    def run(name: str) -> float:
        began = time.perf_counter()
        queries[name].build(spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    began = time.perf_counter()
    features._inputs(spark, sf)  # rows and vectors that the model queries share
    setup = round(time.perf_counter() - began, 3)
    for name in WARM_UP:  # class loading and code generation, not timed
        run(name)
    for name in names.split(",") if names else HEADLINE:
        took[name] = run(name)
    total = round(sum(took.values()) + setup, 3)
    print(json.dumps({
        "metric": "headline_seconds", "value": total, "unit": "sec", "queries": took,
        "model_inputs_seconds": setup,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": cpus,
        "click_rows": rows,
        "p11_rows_per_sec": round(rows / took["p11_prepare"]) if "p11_prepare" in took else None}))
    spark.stop()


if __name__ == "__main__":
    main()
