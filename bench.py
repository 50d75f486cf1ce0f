"""Headline queries, timed: one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.  The tables are
dealt out first to as many files as cores, as a store of documents has them: a table in
one file of one row group is read by one task, whatever is done with it.  Each query runs
once to warm up and once for its time, writing all rows and columns to the no-op sink.
"""

import json
import os
import re
import sys
import time
import uuid
from pathlib import Path

from quirebind.session import drop_settled, local_session, shared_folder
from quirebind.workload.queries import QUERIES

HEADLINES = [
    "prepare_text", "heading_kind", "clean_lines", "markup_paragraphs", "segment_headings",
    "segment_long", "segment_documents", "bundle_index", "bundle_log", "bundle_entries",
    "validate_bundles", "job_trace", "user_jobs", "jobs_page", "download_gate", "cascade_delete",
    "latest_status", "status_transitions", "register_unique", "accept_jobs", "json_roundtrip",
    "idempotent_intake", "convert_corpus",
]
TABLES = ["conversations", "customer", "documents", "events", "lineitem", "orders", "pages"]


def dealt(spark, folder: str, cpus: int) -> str:
    """The tables in as many files as cores, in the shared folder."""
    root = f"{shared_folder(spark)}/bench-{uuid.uuid4()}"
    for name in TABLES:
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(cpus).write.parquet(
            f"{root}/{name}.parquet")
    return root


def timed(name: str, folder: str, spark) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    folder = dealt(spark, str(Path(given)), cpus)
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        timed(name, folder, spark)
        times[name] = round(timed(name, folder, spark), 3)
        drop_settled(spark)
    scale = re.search(r"sf([0-9.]+)", given)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
