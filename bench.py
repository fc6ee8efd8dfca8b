"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (the full plan runs,
nothing is collected to the driver).  A line per query goes to stderr as soon
as it has ended; stdout gets ONE JSON line, also when the run is terminated.
A query's jobs are cancelled after ``BENCH_LIMIT`` seconds, and none begins
after ``BENCH_TOTAL`` seconds.

    BENCH_SF_DIR=/root/testdata/sf0.01 BENCH_CPUS=8 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import signal
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Headline queries: one per operator family (parsing, quantile classes,
# reports, skills, text lines, cards/dedup, pages, features, TF-IDF,
# clustering metrics, streaming).
HEADLINE = [
    "avg_salary_by_contract", "dashboard_reports", "offers_enriched", "quality_report", "skills_extract",
    "top_skills", "clean_text_v2", "line_dedup", "boilerplate_lines", "offer_dedup", "tag_routing",
    "page_main_text", "page_fields", "classif_prepared", "stratified_split", "tfidf", "cluster_top_terms",
    "silhouette_sq", "svd_scores", "kmeans_text", "page_cards", "page_description_collected", "page_detail_offers",
    "stream_offer_ingest", "elbow", "model_comparison",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("offerlens-bench")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.offerlens.spreadPartitions", str(cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("OFFERLENS_DRIVER_MEMORY", "16g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from offerlens.plans.catalog import QUERIES
    from offerlens.session import shared_dir

    shared_dir(spark)  # the cluster's spark.checkpoint.dir; a scratch folder only when unset

    # warm the JVM (class loading, codegen caches) on a tiny read
    spark.read.parquet(f"{sf}/region.parquet").count()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    sf_name = os.path.basename(sf).replace("sf", "")
    limit, total = float(os.environ.get("BENCH_LIMIT", "240")), float(os.environ.get("BENCH_TOTAL", "1500"))

    def report(*_) -> None:
        out = {"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
               "queries": times, "sf": float(sf_name) if sf_name.replace(".", "").isdigit() else sf_name,
               "cpus": int(cpus)}
        if failed:
            out["failed"] = failed
        print(json.dumps(out), flush=True)

    def terminated(*_) -> None:
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, terminated)
    began = time.perf_counter()
    for n in names:
        t0 = time.perf_counter()
        if t0 - began > total:
            failed[n] = f"not begun after {total:.0f} s"
            continue
        timer = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
        timer.start()
        try:
            QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on
            failed[n] = f"after {time.perf_counter() - t0:.0f} s: {type(e).__name__}: {str(e)[:200]}"
        finally:
            timer.cancel()
        print(n, times.get(n, failed.get(n)), file=sys.stderr, flush=True)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
