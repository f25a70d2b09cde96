"""Times the headline queries and prints one line of JSON."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from quillmark.plans import catalog

HEADLINE = ["ranked_search", "ranked_search_short", "ranked_search_mixed", "recall_short", "recall_long", "recall_counts", "hits_by_source", "batch_search", "compare_sources", "indexed_recall", "indexed_search", "top_search", "indexed_batch_search", "posting_search", "indexed_counts", "smoke_terms", "traceability", "manifest_digests"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    catalog.stored_index(spark, sf_dir)
    built = round(time.perf_counter() - start, 4)  # also the session's first job
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the first run compiles
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 4)
    small = f"{sf_dir.rstrip('/').rpartition('/sf')[0]}/sf0.001"
    growth = {}  # of a scan and of the index, from the smallest table to this one
    for name in ("recall_short", "indexed_recall", "posting_search") if os.path.isdir(small) else ():
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        growth[name] = round(times[name] / min(runs), 2)
    print(json.dumps({"growth_from_sf0.001": growth, "index_build_seconds": built, "metric": "total_query_seconds", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rpartition("/sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
