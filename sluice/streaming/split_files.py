"""Split-file intake: arriving files by folder, the same rows to two targets."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions import paths as P
from sluice.operators.analysis import row_text
from sluice.sinks.archive import csv_writer
from sluice.sinks.tables import hadoop_path, write_load
from sluice.sources.delimited import split_values

# Fixed names of the two arrival folders.
FOLDERS = ("success_split_files", "unprocessed_transactions")


def read_arrivals(spark: SparkSession, root, folders=FOLDERS, max_files=1000) -> DataFrame:
    """Stream of (value, file_path) lines from the folders that exist to be read."""
    glob = "{" + ",".join(folders) + "}"
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
        .load(f"{root}/{glob}").select("value", F.col("_metadata.file_path").alias("file_path"))
    )


def payload_rows(lines: DataFrame) -> DataFrame:
    """(program_name, row_as_string, file_uuid, folder, id_and_program) per line."""
    values = split_values(lines)
    name = P.object_name("file_path")
    return values.select(
        P.program_name(name).alias("program_name"),
        row_text("values").alias("row_as_string"),
        P.leading_id(name).alias("file_uuid"),
        P.folder_name("file_path").alias("folder"),
        P.id_and_program(name).alias("id_and_program"),
    ).filter(F.col("folder").isin(*FOLDERS))


def commits_folder(targets) -> str:
    """Where the commit records of ``targets`` lie by default: beside the first."""
    return f"{targets[0].rstrip('/').rsplit('/', 1)[0]}/_commits"


def _record(spark: SparkSession, commits, batch_id):
    return hadoop_path(spark, f"{commits}/batch-{int(batch_id):012d}")


def commit_batch(spark: SparkSession, commits, batch_id, targets) -> None:
    """The one record that makes a batch visible in all targets at once.

    It names the targets; it is written aside and renamed into place, which
    a reader sees whole or not at all.
    """
    fs, final = _record(spark, commits, batch_id)
    _, aside = hadoop_path(spark, f"{commits}/_pending-{int(batch_id):012d}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray("\n".join(targets).encode()))
    out.close()
    if not fs.rename(aside, final):
        raise OSError(f"batch {batch_id}: commit record not placed")


def uncommit_batch(spark: SparkSession, commits, batch_id) -> None:
    fs, final = _record(spark, commits, batch_id)
    fs.delete(final, False)


def committed(spark: SparkSession, commits) -> list[int]:
    """Batches whose commit record is in place."""
    fs, folder = hadoop_path(spark, commits)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n[len("batch-"):]) for n in names if n.startswith("batch-"))


def read_committed(spark: SparkSession, target, commits) -> DataFrame:
    """A target's rows of committed batches only; the batch folders of others are not read."""
    done = committed(spark, commits)
    rows = spark.read.parquet(target)
    return rows.where(F.col("batch_id").isin(done)) if done else rows.where(F.lit(False))


def write_both(rows: DataFrame, batch_id, targets, write=write_load, commits=None) -> None:
    """The rows of a batch to every target, then its commit record; readers see both or neither.

    Each target is keyed by batch.  A batch that runs again takes its record
    back first, so while it replaces its rows nothing of it is seen, and a
    run that stopped between two targets is never seen until one finishes.
    """
    spark = rows.sparkSession
    commits = commits or commits_folder(targets)
    uncommit_batch(spark, commits, batch_id)
    keyed = rows.withColumn("batch_id", F.lit(int(batch_id)))
    for target in targets:
        write(keyed, target, keys=("batch_id",))
    commit_batch(spark, commits, batch_id, targets)


def drop_batch(spark: SparkSession, targets, batch_id) -> None:
    for target in targets:
        fs, path = hadoop_path(spark, f"{target}/batch_id={int(batch_id)}")
        fs.delete(path, True)


def archive_failed(rows: DataFrame, root, batch_id, database, stamp) -> None:
    """All rows of a failed batch, in folders named by id, program, database and time."""
    named = rows.withColumn("archive", F.concat_ws(
        "_", F.coalesce("id_and_program", F.lit("unknown")), F.lit(database), F.lit(stamp)))
    (
        csv_writer(named.select("program_name", "row_as_string", "file_uuid", "archive"))
        .mode("overwrite").partitionBy("archive").csv(f"{root}/batch_id={int(batch_id)}")
    )


def intake_batch(targets, failed_root, database, stamp, write=write_load):
    """The foreachBatch function of the intake."""

    def run(batch: DataFrame, batch_id: int):
        rows = payload_rows(batch).persist()
        try:
            write_both(rows, batch_id, targets, write)
        except Exception:
            uncommit_batch(batch.sparkSession, commits_folder(targets), batch_id)
            drop_batch(batch.sparkSession, targets, batch_id)
            archive_failed(rows, failed_root, batch_id, database, stamp)
        finally:
            rows.unpersist()

    return run


def run_intake(spark: SparkSession, root, targets, failed_root, checkpoint, database="programs",
               stamp="run", write=write_load, max_files=1000):
    """Take in all files that have arrived, then stop; call again for more."""
    query = (
        read_arrivals(spark, root, max_files=max_files).writeStream
        .foreachBatch(intake_batch(list(targets), failed_root, database, stamp, write))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def archive_processed(spark: SparkSession, names, root, archive_folder) -> int:
    """Move processed files below an archive folder, keeping their key.

    File moves are driver calls; pass the names of one batch.
    """
    moved = 0
    for name in names:
        fs, source = hadoop_path(spark, f"{root}/{name}")
        _, target = hadoop_path(spark, f"{archive_folder}/{name}")
        fs.mkdirs(target.getParent())
        moved += bool(fs.rename(source, target))
    return moved
