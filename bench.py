"""Time the headline queries; prints one JSON line.

The engine's inputs (page texts, spans, nested results, ...) are derived from
the driver tables once and stored; that time is reported as ``prepare_sec``.
Each query then reads its stored input and computes all columns of its result.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from catalogue import fixtures
from catalogue.queries import QUERIES
from foliospark.session import local_session

HEADLINE = [
    "process_statements",
    "process_summary",
    "transactions",
    "split_documents",
    "split_documents_by_range",
    "assign_pages",
    "folder_summary",
    "raw_text",
    "table_rows",
    "fill_missing_dates",
    "region_text",
    "extract_value_full_page",
    "date_prefix",
    "identify_duplicates",
    "run_document_tasks",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g", "bench")
    spark.sparkContext.setLogLevel("ERROR")
    start = time.time()
    given = fixtures.prepare(spark, sf_dir, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    prepared = round(time.time() - start, 3)
    for name in HEADLINE:  # the first run of a query mostly measures code generation
        run(spark, name, given)
    timings = {name: run(spark, name, given) for name in HEADLINE}
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "prepare_sec": prepared,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
