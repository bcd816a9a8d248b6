"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores.
Every query runs three times and its fastest run counts, so that start-up of the JVM
and of Python workers stays out.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from workload.queries import REGISTRY

HEADLINE = {
    "clean": "c9_clean_row",
    "dedup": "s2_dedup",
    "funnel": "a1_funnel",
    "curate": "s4_split_exact",
    "curate_and_write": "io2_chat_roundtrip",
    "training_subset": "s7_train_subset",
    "health": "r13_health",
    "chat_text": "c21_tools",
    "turns": "c21_turns",
    "normalize": "c10_normalize",
    "metric_set": "r1_metric_set",
    "row_scores": "row_scores",
    "rougeLsum": "a12_rougeLsum",
    "per_intent": "a16_per_intent",
    "histogram": "a17_histogram",
    "executive": "r6_executive",
    "train_stats": "a19_train_stats",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="turnmill-bench-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for label, name in HEADLINE.items():
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[label] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline queries, best of three runs each, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
