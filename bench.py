"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Every query runs to the end into a sink that keeps
nothing; one untimed query starts the JVM and the Python workers first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stallweave.catalogue import QUERIES  # noqa: E402
from stallweave.session import build_session  # noqa: E402

HEADLINE = (
    "stg_listing_latest", "stg_seller_distinct_on", "stg_reviews_explode", "fct_reviews_enriched",
    "fct_products_enriched", "top_products", "top_categories", "top_sellers", "tree_flatten", "request_frontier",
    "product_documents", "changed_documents", "document_vectors", "question_topk", "hybrid_topk", "prompt_rows",
    "ttl_dedupe", "partition_merge_union", "drift_safe_read", "stream_silver_latest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["document_vectors"](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
