"""Raw text lines with their line numbers, in files of any size.

Each split numbers its own rows; one cheap counting pass over the splits gives
every split the number of lines before it.  No line is shuffled, and no file
has to fit in one task.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sluice.session import truncate_lineage

# One row per split of at most 128 MB by default, of some 200 bytes: room for
# several million splits.
BROADCAST_BYTES = 1 << 30
_FIXED_BYTES = 72
_SPLIT = ["file", "split_start", "split_length", "split_no"]


def _pin_splits(spark):
    """Keep the split layout fixed while executors come and go.

    Unset, the layout of small inputs follows the number of cores alive.
    """
    key = "spark.sql.files.minPartitionNum"
    if not spark.conf.get(key, None):
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def _raw_splits(spark, paths):
    return (
        spark.read.option("lineSep", "\n").text(paths)
        .select(
            F.col("value").alias("raw_row"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.col("_metadata.file_block_length").alias("split_length"),
            F.spark_partition_id().alias("split_no"),
            F.monotonically_increasing_id().alias("position"),
        )
    )


def split_table(raw: DataFrame) -> DataFrame:
    """One row per split: first position, lines before it, and file totals.

    A file whose bytes are its lines' bytes plus one line feed each ends with
    a line feed; one byte short means that the last line is cut off.  (A byte
    order mark at the start is three bytes that belong to no line.)
    """
    counted = raw.groupBy(*_SPLIT, "file_size").agg(
        F.count("*").alias("lines"),
        F.min("position").alias("first_position"),
        F.sum(F.octet_length("raw_row")).alias("line_bytes"),
    )
    # One row per split and file: small enough for one ordered pass.
    before = Window.orderBy("file", "split_start").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file")
    numbered = counted.withColumn("rows_before", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    surplus = F.sum(F.col("line_bytes") + F.col("lines")).over(in_file) - F.col("file_size")
    return numbered.select(
        *_SPLIT, "first_position", "rows_before",
        F.min("rows_before").over(in_file).alias("file_offset"),
        F.sum("lines").over(in_file).alias("file_lines"),
        surplus.isin(1, -2).alias("file_cut_off"),
    )


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, line_number, row_no, raw_row, truncated), numbers from 1.

    ``row_no`` runs on over all files in name order.  Blank lines are kept.
    ``truncated`` marks the last line of a file that does not end with a line
    feed.  Files are plain text, not compressed.
    """
    _pin_splits(spark)
    raw = _raw_splits(spark, paths)
    splits = truncate_lineage(split_table(raw))
    size = splits.agg(F.sum(F.octet_length("file") + _FIXED_BYTES)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        splits = F.broadcast(splits)
    joined = raw.join(splits, _SPLIT, "left")
    number = F.col("rows_before") + F.col("position") - F.col("first_position") + 1
    # A split the counting pass did not see would get a wrong number: fail.
    changed = F.raise_error(F.lit("input files changed during the load")).cast("bigint")
    numbered = joined.withColumn("row_no", F.coalesce(number, changed))
    line_number = F.col("row_no") - F.col("file_offset")
    last = line_number == F.col("file_lines")
    return numbered.select(
        "file", line_number.alias("line_number"), "row_no", "raw_row",
        (last & F.col("file_cut_off")).alias("truncated"),
    )


def file_start(spark: SparkSession, path):
    """(file, first line) of one file, None for an empty one."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value").first()


def first_line(spark: SparkSession, paths) -> str:
    """The first line of the first file that has one; raises on empty input."""
    for name in sorted(spark.read.text(paths).inputFiles()):
        row = file_start(spark, name)
        if row is not None:
            return row["value"]
    raise ValueError("input is empty")
