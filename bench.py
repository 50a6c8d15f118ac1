"""Times the queries on the tables in $BENCH_SF_DIR and prints one line of JSON.

Each query is built and run to the end, its rows going nowhere; the time is
the best of $BENCH_RUNS runs after one to warm up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleanery.catalog.queries import QUERIES  # noqa: E402
from gleanery.session import local_session  # noqa: E402

HEADLINE = (
    "csv_text_load",
    "csv_text_load_split",
    "repeat_baseline",
    "exact_duplicates",
    "repeat_span",
    "latest_per_key",
    "latest_per_key_wide",
    "typed_or_null",
    "format_classes",
    "case_variants",
    "probe_vocabulary",
    "probe_vocabulary_joined",
    "term_matches",
    "term_matches_joined",
    "large_vocabulary_matches",
    "recovered_rows",
    "dimension_of_words",
    "fact_rows",
    "fact_rows_salted",
    "junction_rows",
    "constraint_report",
    "model_counts",
)


def seconds(run, runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return min(times)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, spark__ui__showConsoleProgress="false")

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {name: round(seconds(lambda n=name: run(n), runs), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "curation_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
