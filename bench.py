"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "temporal_features", "behavioral_features", "master_features", "book_metadata", "genre_encoding", "validate_all",
    "kpis", "genre_trend", "top_books", "interaction_strength", "tfidf_weights", "tfidf_weights_documents",
    "tfidf_recommend", "emb_recommend", "topn_popular_unseen", "hybrid_recommend", "als_recommend", "svd_recommend",
    "ndcg_at_k", "psi_drift", "kl_drift", "drift_report", "windowed_rate", "stream_engagement",
]

#: Queries under so many seconds run a second time, with compiled code.
WARM_BELOW = 20


def main() -> None:
    from pyspark.sql import SparkSession

    from checks.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus)))).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timings, warm = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        timings[name] = run(name)
        if timings[name] < WARM_BELOW:
            warm[name] = run(name)
        print(name, timings[name], warm.get(name, ""), file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "warm": warm, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
