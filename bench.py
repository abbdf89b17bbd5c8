"""Times the headline queries and prints one JSON line.

Every query is planned and run in full into a sink that keeps nothing. One
unmeasured pass warms the JVM up; the better of two measured passes counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corvane.plans.registry import QUERIES
from corvane.session import local_session

HEADLINE = (
    "chunk_documents",
    "chunks_per_document",
    "split_sentences",
    "embed_chunks",
    "mirror_embeddings",
    "knn_topk",
    "knn_topk_pruned",
    "knn_approx",
    "cited_context",
    "synthesis_context",
    "answer_batch",
    "validate_sql",
    "customer_metrics",
    "order_metrics_monthly",
    "required_field_audit",
    "column_catalog",
    "latest_metadata",
    "coerce_types",
    "payload_extract",
    "upsert_documents",
    "stream_documents",
    "stream_structured",
    "cost_summary",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "corvane-bench")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
