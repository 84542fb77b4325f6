"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) set
the input and the local cores.  Results go to the noop sink, so every row is
computed and none is collected.  One untimed query warms the session up.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from tidings.plans import catalogue  # noqa: E402

HEADLINE = (
    "ingest_canonical", "union_topics_dedup", "clean_staging", "relevance_mart", "sector_tags", "content_router",
    "top_sources", "length_stats", "facets", "bm25_topk", "vector_topk", "hybrid_rrf", "chunk_retrieval", "ann_topk",
    "embed_hash", "ner_gazetteer", "graph_extract", "relation_rules", "coref_rewrite", "graph_relations_upsert",
    "two_hop", "pagerank_5", "components", "enriched_search_doc", "entity_resolution", "relation_lifecycle",
    "confidence_merge", "dq_tests", "stream_threshold", "stream_ingest_index",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", "16"))
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()
    names = sys.argv[1:] or HEADLINE
    queries["top_sources"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
