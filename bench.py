"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs of
each query after one warm-up; the best counts), BENCH_ONLY (name prefixes).

`queries` start from the driver tables, joins included. `stages` start from a
staged table, as the stages of a run do, and carry their rows per second.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from campusgrid.operators.clean import transform  # noqa: E402
from campusgrid.operators.quality import validate, validation_report  # noqa: E402
from campusgrid.session import scratch_dir, session  # noqa: E402
from campusgrid.sources.sinks import drop_table, load_table  # noqa: E402
from checks import load_all  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from checks.tables import institutions, raw_records  # noqa: E402

HEADLINE = (
    "a2_state_admission",
    "a6_state_sizes",
    "a10_admissions_summary",
    "a11_state_performance",
    "a12_size_category_analysis",
    "r2_admission_completion_profile",
    "r3_institution_detail",
    "w1_largest_schools",
    "w2_largest_per_state",
    "w3_best_completion",
    "u1_data_quality_metrics",
    "v5_keep_first",
    "v6_validation_report",
    "v6_validated_rows",
    "v7_exact_duplicates",
    "p18_transform",
    "s1_pages",
    "s3_records_to_table",
    "j1_merge_surveys",
    "j1_merge_unique_surveys",
    "j1_merge_repeated_keys",
    "j2_related_counts",
    "b5_largest_names",
    "b8_reimbursement_places",
    "l8_expired_by_count",
)


def run_all(df) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def seconds(work, runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        work()
        times.append(time.perf_counter() - started)
    return round(min(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = tuple(p for p in os.environ.get("BENCH_ONLY", "").split(",") if p)
    load_all()
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.log.level": "ERROR",
        },
    )
    queries = {
        name: seconds(lambda q=QUERIES[name]: run_all(q(spark, sf_dir)), runs)
        for name in HEADLINE
        if not only or name.startswith(only)
    }

    stages = {}
    if not only:
        folder = scratch_dir(spark)
        # As many files as threads, so that a stage's scan and cleaning use them all.
        files = int(cpus) if cpus.isdigit() else 8
        raw_records(spark, sf_dir).repartition(files).write.parquet(f"{folder}/raw")
        institutions(spark, sf_dir).repartition(files).write.parquet(f"{folder}/institutions")
        raw = spark.read.parquet(f"{folder}/raw")
        ready = spark.read.parquet(f"{folder}/institutions")
        rows = raw.count()

        def load() -> None:
            table = f"bench_{uuid.uuid4().hex}"
            load_table(ready, table, "replace", f"{folder}/{table}")
            drop_table(spark, table)

        work = {
            "validate_report": lambda: validation_report(raw).collect(),
            "validate_rows": lambda: run_all(validate(raw, ["school_id"])),
            "transform": lambda: run_all(transform(raw)),
            "load": load,
        }
        for name, job in work.items():
            took = seconds(job, runs)
            stages[name] = {"seconds": took, "rows": rows, "rows_per_second": round(rows / took)}

    total = sum(queries.values()) + sum(s["seconds"] for s in stages.values())
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(total, 4),
                "unit": "sec",
                "queries": queries | {f"stage_{n}": s["seconds"] for n, s in stages.items()},
                "stages": stages,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
