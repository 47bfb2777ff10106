"""Load-keyed tables: a second run of a load replaces its own rows only."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.model import WAREHOUSE_PATIENT_COLUMNS


def write_load(df: DataFrame, path, keys=("load_id",)) -> None:
    """Write by load (or load and batch); only the partitions written change."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def read_load_table(spark: SparkSession, path, schema, load_id=None) -> DataFrame:
    """A load-keyed table, empty if nothing was written; one load if named."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path).select(*schema.names)
    return df.filter(F.col("load_id") == load_id) if load_id is not None else df


def append_rows(df: DataFrame, path) -> None:
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url, table, batch_size=10_000, properties=None) -> None:
    """Append to a database table; credentials come in ``properties``."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    df.write.format("jdbc").options(**options).mode("append").save()


def append_patients(df: DataFrame, path, fmt="parquet", **options) -> None:
    """Append the five patient columns to a warehouse table."""
    df.select(*WAREHOUSE_PATIENT_COLUMNS).write.format(fmt).options(**options).mode("append").save(path)


def hadoop_path(spark: SparkSession, path):
    """(file system, path) of any storage Spark can reach."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)
