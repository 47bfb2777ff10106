"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.  Every query runs
once to warm up and once timed; results go to a sink that reads every row.
The given tables have one row group each, which is one task's work; large
tables have many.  So they are first dealt to one file per core, untimed, and
the line tells so as ``layout``.
"""

import json
import os
import time

from sluice.catalog import QUERIES
from sluice.session import fresh_folder, local_session

HEADLINE = [
    "merge_winners", "merge_losers", "merge_upsert_null_safe", "reject_reasons", "row_reasons",
    "rule_counts", "business_split_numeric", "business_split_strict", "dup_flag_all",
    "dup_keep_first", "latest_per_key", "structural_reasons", "structural_clean", "line_scan",
    "coerce_numeric", "coerce_date", "record_hashes", "quarantine_payload", "audit_latest",
    "sum_by_product", "nested_totals", "line_total", "claims_on_date", "file_name_parts",
    "pages_concat", "text_normalize", "note_classify", "note_fields", "note_confidence",
    "doc_upsert", "patient_latest", "claims_lines_load_v2", "migration_load", "hash_merge_load",
    "split_file_intake",
]


def dealt(spark, sf_dir, files):
    """The tables as folders of ``files`` files with the same rows."""
    folder = fresh_folder(spark, "bench-tables")
    for name in sorted(n.removesuffix(".parquet") for n in os.listdir(sf_dir) if n.endswith(".parquet")):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def timed(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "sluice-bench", int(cpus) if cpus.isdigit() else 8)
    tables = dealt(spark, sf_dir, spark.sparkContext.defaultParallelism)
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, tables)
        seconds[name] = round(timed(spark, name, tables), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "layout": "one file per core",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
