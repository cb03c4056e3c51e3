"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Every query runs in full into a
no-op sink, once to warm up and then ``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = (
    "chunk_window chunk_sentence extract_html clean_lines assign_ids corpus_terms embed_hash embed_hash_by_join "
    "validate_vectors similarity_topk_cosine similarity_topk_l2 similarity_access similarity_cells similarity_ann "
    "rerank_bm25 retrieve_flagship retrieve_two_stage build_prompts eval_hit_at_k upsert_embeddings diff_snapshots "
    "create_or_sync_index sync_triggered"
).split()


def main() -> None:
    from catalogue.queries import QUERIES
    from shelfmark.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: first {taken[0]:.2f}s, warm {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
