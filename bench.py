"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import threading
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "keyword_scores",
    "keywords_capped",
    "term_edges",
    "similarity_edges",
    "network_shred",
    "check_sufficiency",
    "match_substrings",
    "score_description",
    "clean_transcript",
    "hash_embed",
    "knn_search",
    "retrieval_record",
    "page_elements",
    "annotation_sufficiency",
    "parse_records",
    "route_documents",
)

#: Seconds after which a query is given up.
LIMIT = int(os.environ.get("BENCH_LIMIT", "300"))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    with contextlib.redirect_stdout(sys.stderr):
        from wordloom.plans.catalog import QUERIES
        from wordloom.session import build_session

        spark = build_session("bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        })
        spark.sparkContext.setLogLevel("ERROR")
        spark.range(1000).selectExpr("sum(id)").collect()
        times, failed = {}, {}
        for name in names:
            start = time.perf_counter()
            guard = threading.Timer(LIMIT, spark.sparkContext.cancelAllJobs)
            guard.start()
            try:
                QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            except Exception as error:  # noqa: BLE001 - the others are still to be timed
                failed[name] = str(error).splitlines()[0][:200]
            finally:
                guard.cancel()
            times[name] = round(time.perf_counter() - start, 3)
            print(name, times[name], failed.get(name, ""), file=sys.stderr, flush=True)
        spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, **({"failed": failed} if failed else {}), "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
