"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; its figure is the median
wall time of building the plan and consuming every row.  The set-up stores the
given tables again in the shared folder, texts and pages in one file a core, as
a large table would be read by all cores.  Marts read a star schema that the
set-up has stored, as they would in production.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import fixture as fx  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from jobmart.operators import marts, silver, star  # noqa: E402
from jobmart.session import local_session, work_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

DIRECT = [
    "keyword_match_all", "canonical_role", "employment_type", "location_type", "seniority_level", "experience_level",
    "salary_phrase", "posted_date", "slug_md5_key", "clean_jobs", "clean_companies", "dedup_first", "dedup_report",
    "fact_hiring", "bridge_tech_fact", "dim_techstack", "upsert", "crawl_frontier", "explode_listing_items",
    "extract_fields", "join_details", "extract_postings", "check_unique", "check_no_nulls",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(make) -> float:
    times = []
    for run in range(RUNS + 1):
        start = time.perf_counter()
        consume(make())
        if run:
            times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8)
    data = work_path(spark, "bench")
    for name in ("documents", "pages", "customer", "nation", "supplier", "orders", "lineitem"):
        table = fx.table(spark, SF_DIR, name)
        table = table.repartition(spark.sparkContext.defaultParallelism) if name in ("documents", "pages") else table
        table.write.parquet(f"{data}/{name}.parquet")
    stored = fx.stored_tables(spark, data)
    jobs, companies = stored["jobs"], stored["companies"]
    bounds = star.date_bounds(spark, fx.CALENDAR_START, 365)

    def silver_end_to_end():
        return silver.silver_jobs(fx.raw_jobs(spark, data), ["doc_id"], fx.processed_at())

    cases = {"silver_end_to_end": silver_end_to_end}
    cases |= {name: (lambda q=QUERIES[name]: q(spark, data)) for name in DIRECT}
    cases |= {
        f"star_{name}": (lambda n=name: star.build_star(jobs, companies, bounds)[n])
        for name in ("dim_role", "dim_techstack", "fact_hiring", "bridge_tech_fact")
    }
    cases |= {f"mart_{name}": (lambda n=name: marts.mart_tables(stored)[n]) for name in marts.mart_tables(stored)}
    cases["mart_job_analytics"] = lambda: marts.job_analytics(jobs, companies)
    cases["mart_salary_insights"] = lambda: marts.salary_insights(jobs)
    cases["check_foreign_keys"] = lambda: star.check_foreign_keys(stored)

    times = {name: seconds(make) for name, make in cases.items()}
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "cpus": CPUS,
        "documents": spark.read.parquet(f"{SF_DIR}/documents.parquet").count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
