"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the parquet tables; BENCH_CPUS: local cores;
BENCH_QUERIES: comma-separated names to run instead of the headline ones.
"""

import json
import os
import time

from quartermill.session import build_session

HEADLINE = ("tax_latest", "employee_lines", "tax_lines", "mandatory_coverage", "skip_audit", "site_file", "site_file_with_skips")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    from quartermill.plans.registry import QUERIES

    # One untimed run on the smallest query starts the JVM's code paths.
    QUERIES["scan_worker"](spark, sf_dir).count()
    seconds = {}
    for name in [n for n in names.split(",") if n] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
