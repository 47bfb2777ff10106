"""Nested records."""

from pyspark.sql import DataFrame, SparkSession, functions as F

NESTED_SCHEMA = "user_id long, transactions array<struct<amount: long, status: string>>"


def records(spark: SparkSession, rows, schema=NESTED_SCHEMA) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def read_records(spark: SparkSession, path, schema=NESTED_SCHEMA) -> DataFrame:
    """JSON lines with a fixed schema."""
    return spark.read.schema(schema).json(path)


def flatten(df: DataFrame, key="user_id", items="transactions") -> DataFrame:
    """One row per list item with the parent key; an empty list gives none."""
    return df.select(F.col(key), F.inline(items))
