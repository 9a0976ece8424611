"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Arguments name other registered queries to time; ``all`` times every one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from pyspark.sql import SparkSession  # noqa: E402

from tripleweave.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "chunk_documents", "global_chunk_ids", "tag_entities", "generate_triplets", "rules_to_index",
    "parse_triplets_strict", "clean_records", "clean_reason_counts", "clean_dedup", "inverted_index",
    "graph_edges", "graph_merge_incremental", "top_relations", "clean_to_graph", "documents_to_graph",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("tripleweave.input.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    times = {}
    for name in names:
        taken = []
        for i in range(rounds + 1):  # the first one warms up
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, times[name], [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds_of_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
