"""Incremental claim intake: every batch of arriving files is one small load."""

from pyspark.sql import DataFrame, SparkSession

from sluice.operators import audit
from sluice.plans.claims import header_names, load_claims_lines
from sluice.plans.migration import Tables, write_audit
from sluice.sinks.tables import write_load
from sluice.sources.lines import file_start

PROCESS_NAME = "claims_file_intake"
# Only the path is selected, so no file content is read by the stream itself.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
FILE_REJECTS_SCHEMA = "load_id string, file string, reason string"


def judge_files(spark: SparkSession, paths):
    """({header names: files}, {path: reason}): every file is judged by its own first line."""
    good, bad = {}, {}
    for path in paths:
        start = file_start(spark, path)
        try:
            if start is None:
                raise ValueError("input is empty")
            good.setdefault(tuple(header_names(start["value"])), []).append(start["file"])
        except ValueError as reason:
            bad[path] = str(reason)
    return good, bad


def claims_batch(tables: Tables, load_prefix, as_of, run_ts, **options):
    """The foreachBatch function: rules, stage, archives and audit of a batch.

    The batch number is part of the load id, so a replayed batch replaces its
    own rows and repeats its own audit key.  Duplicates count within a batch.
    A file that is empty or has other columns goes to ``file_rejects`` with its
    reason, and the rest of the batch is loaded; the order of the columns may
    differ from file to file.
    """

    def run(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        # File names only, as many as one trigger admits.
        paths = [r["path"] for r in batch.select("path").collect()]
        if not paths:
            return
        load_id = f"{load_prefix}-{batch_id:06d}"
        headers, refused = judge_files(spark, paths)
        if refused:
            rows = [(load_id, path, reason) for path, reason in refused.items()]
            write_load(spark.createDataFrame(rows, FILE_REJECTS_SCHEMA), tables.file_rejects)
        paths = [path for path in paths if path not in refused]
        if not paths:
            write_audit(spark, tables, audit.failed(load_id, PROCESS_NAME, run_ts, "no readable file"))
            return
        got = load_claims_lines(
            spark, paths, tables.stage, f"{tables.root}/archive", load_id, as_of, run_ts, header=headers, **options)
        write_audit(
            spark, tables,
            audit.progress(
                load_id, PROCESS_NAME, run_ts, batch_id,
                source_rows_read=got["rows_read"],
                source_rows_quarantined=got["rows_read"] - got["rows_loaded"],
                staged_rows_loaded=got["rows_loaded"]))

    return run


def run_claims_intake(spark: SparkSession, folder, tables: Tables, checkpoint, load_prefix, as_of, run_ts,
                      max_files=100, **options):
    """Load all files that have arrived, then stop; call again for more."""
    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("maxFilesPerTrigger", max_files)
        .load(folder).select("path")
    )
    query = (
        files.writeStream.foreachBatch(claims_batch(tables, load_prefix, as_of, run_ts, **options))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
