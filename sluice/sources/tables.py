"""Tables as sources: Parquet, and a database through the JDBC reader."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.model import SOURCE_COLUMNS


def read_table(spark: SparkSession, path, columns=SOURCE_COLUMNS) -> DataFrame:
    """Project the source columns of a Parquet table, plus a stable ``row_id``."""
    return with_row_id(spark.read.parquet(path)).select(*columns, "row_id")


def with_row_id(df: DataFrame) -> DataFrame:
    """Identify each row of a Parquet scan by its file and place in the file.

    The identity is the same in every scan of the same files, costs no shuffle
    and is unique.
    """
    return df.withColumn(
        "row_id",
        F.struct(
            F.xxhash64("_metadata.file_path").alias("file_key"),
            F.col("_metadata.row_index").alias("row_index"),
        ),
    )


def jdbc_options(url, table, columns, partition_column, lower, upper, partitions, fetch_size=5000):
    """Reader options for a parallel extract in ranges of ``partition_column``."""
    return {
        "url": url,
        "dbtable": f"(select {', '.join(columns)} from {table}) source_rows",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(spark: SparkSession, url, table, partition_column, lower, upper,
              partitions, columns=SOURCE_COLUMNS, properties=None) -> DataFrame:
    """Extract a database table; credentials come in ``properties``."""
    options = jdbc_options(url, table, columns, partition_column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options, **(properties or {})).load()
