"""Benchmark of the headline queries; prints one JSON line.

``bm25_index`` includes building and storing the index that later queries of the
same session search. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Set
``BENCH_TWIN=1`` to also time a single-process pandas twin of the corpus build.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

import pandas as pd

from sieveline.catalog.registry import QUERIES
from sieveline.config import MAX_TOKENS, STRIDE
from sieveline.session import local_session

HEADLINE = (
    "chunk_documents",
    "corpus_pipeline",
    "write_corpus",
    "bm25_index",
    "bm25_topk",
    "dense_topk",
    "hybrid_search",
    "ir_metrics_domain",
    "rrf_k_sweep",
    "ablation_table",
    "latency_stats",
    "condition_passages",
    "grounding_rows",
    "grounding_summary",
    "ab_metric_stats",
    "class_balance",
)


def pandas_twin(path: str) -> tuple[float, int]:
    """Clean, deduplicate and chunk row by row in one process."""
    started = time.perf_counter()
    docs = pd.read_parquet(f"{path}/documents.parquet", columns=["doc_id", "text", "lang"])
    docs["text"] = docs["text"].fillna("").str.strip()
    docs = docs[docs["text"].str.len() > 0].drop_duplicates("doc_id")
    rows = []
    for _, row in docs.iterrows():
        tokens = row["text"].split()
        start, number = 0, 0
        while True:
            end = min(start + MAX_TOKENS, len(tokens))
            text = row["text"] if len(tokens) <= MAX_TOKENS else " ".join(tokens[start:end])
            rows.append((f"{row['doc_id']}__chunk{number}", row["doc_id"], row["lang"], text, start, end))
            if end == len(tokens):
                break
            start, number = start + MAX_TOKENS - STRIDE, number + 1
    frame = pd.DataFrame(rows, columns=["chunk_id", "doc_id", "domain", "text", "start", "end"])
    return time.perf_counter() - started, len(frame)


def main() -> int:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    for name in ("chunk_documents", "latency_stats"):  # JVM warm-up
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    found = re.search(r"sf([0-9.]+)", path)
    report = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else None,
    }
    if os.environ.get("BENCH_TWIN"):
        report["pandas_twin_corpus_sec"] = round(pandas_twin(path)[0], 3)
    print(json.dumps(report), flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
