"""Time the headline queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_QUERIES``
(comma separated, default the headline list; ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import time

from silsila.plans.catalog import QUERIES
from silsila.plans.session import local_session

HEADLINE = [
    "manifest_inventory", "content_dedup_canonical", "page_segments", "line_sessions", "record_classify", "boundary_extract",
    "mentions", "atomic_split", "list_segments", "normalize_profiles", "phrase_page_evidence", "prefix_index", "neighbours",
    "chain_links", "observed_edges", "edge_evidence", "resolved_pairs", "bilateral_relations", "graph_resolve_fixpoint",
    "queue_recommendation", "source_card_resolve", "specific_context", "alias_resolve", "precedence_union", "kinship_resolve",
    "edge_analysis", "branch_summary", "card_links_graph", "mart_nodes", "integrity_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = local_session("bench", cpus, int(cpus))
    spark.read.parquet(f"{sf_dir}/region.parquet").count()   # start the session before the clock
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
