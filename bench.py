"""Time the headline queries: ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``; prints one JSON line.

Every query is written to Spark's no-op sink, so the whole result is computed and nothing is collected. With
``BENCH_QUERIES=all`` or a comma-separated list other queries are timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "k2_document_frequency",
    "k3_term_weights",
    "r1_text_match",
    "r2_vector_match",
    "r10_search",
    "r11_retrieval",
    "j1_fuse_scores",
    "f4_meta_filter",
    "a5_metadata_summary",
    "a9_usage_stats",
    "a15_merge_relation_mentions",
    "a21_latency_summary",
    "c1_chunk_by_tokens",
    "c5_split_children",
    "c11_html_to_sections",
    "c21_index_columns",
    "w9_cooccurrence",
    "w6_pack_batches",
    "j11_nhop_paths",
    "g8_pagerank_supply",
    "g9_resolve_pairs",
    "g11_connected_components",
    "m1_tag_chunks",
    "m4_feedback_deltas",
    "m12_ranked_metrics",
    "h6_split_buckets",
    "s13_write_chunks",
    "st3_idempotent_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = os.environ.get("BENCH_QUERIES", "")
    from corvane import plans
    from corvane.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = plans.load()[0]
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINES
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds, errors = {}, {}
    if not wanted:  # the stored index that the text queries share is built once, and counts
        from corvane.plans import text_queries

        begin = time.time()
        text_queries.chunk_index(spark, folder)
        seconds["text_index_build"] = round(time.time() - begin, 3)
    for name in names:
        start = time.perf_counter()
        try:
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # a failing query must not hide the others
            errors[name] = str(error)[:300]
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds.get(name, errors.get(name)), file=sys.stderr, flush=True)
    out = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "spark": spark.version,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
