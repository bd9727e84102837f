"""Time the headline queries and print one JSON line.

``tables`` is the time to normalise and deduplicate all documents and write the result; the
queries then run on those tables, as they do in a report. The smallest data set is run once
before, untimed: a fresh JVM spends most of a first run on compiling.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINES = [
    "period_metrics_all", "monthly_trend", "kpi_variance_flags", "sql_service_metrics",
    "dealer_metrics", "agent_metrics", "product_metrics", "top_dealers_sql", "topn_tables",
    "worst_dealers_dashboard", "product_buckets", "loss_code_rows", "loss_code_kpis", "top_makes",
    "top_loss_codes_per_dealer", "dealer_cohort", "time_to_loss", "make_exposure",
    "target_summary", "dq_by_category", "component_buckets", "claim_benchmark",
    "coverage_summary", "state_vs_nation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from pactlens.plans.queries import QUERIES, report

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(small):
        for name in HEADLINES:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    started = time.perf_counter()
    rep = report(spark, sf_dir)
    for table in ("all_contract_rows", "ledger", "transactions", "all_claim_rows", "claims"):
        begun = time.perf_counter()
        getattr(rep, table)
        times[f"table_{table}"] = round(time.perf_counter() - begun, 3)
    times["tables"] = round(time.perf_counter() - started, 3)
    for name in HEADLINES:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
    total = times["tables"] + sum(times[n] for n in HEADLINES)
    print(
        json.dumps(
            {
                "metric": "report_seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
