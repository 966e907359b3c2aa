"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusflow.plans.queries import QUERIES
from corpusflow.session import local_session

HEADLINES = [
    "filter_min_score", "decontaminate", "decontaminate_anchored", "contamination_hits", "minhash_signature",
    "duplicate_clusters", "keep_one_per_cluster", "build_vocab", "tokenize", "count_tokens", "pack_sequences",
    "shard_contiguous", "global_index", "shuffle_seeded", "split_by_ratio", "mix", "interleave", "shard_size",
    "weights_override_scaled", "render_manifest", "render_chat", "clean_solutions", "split_sentences",
    "sentence_scores", "fim_transform_fragments", "last_n_per_group", "read_jsonl", "clean_corpus",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    # Start the JVM's and the Python workers' machinery before the clock runs.
    spark.read.parquet(f"{folder}/region.parquet").groupBy("r_name").count().collect()
    spark.range(1000).repartition(8).mapInArrow(lambda batches: batches, "id bigint").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # The no-op sink runs every column of every row without collecting any.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
