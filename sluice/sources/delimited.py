"""Delimited files with a header, and headerless split files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.functions import paths as P
from sluice.functions.coerce import missing_to_null, to_whole
from sluice.model import CLAIMS_FILE_SCHEMA


def require_rows(df: DataFrame, message="input is empty") -> DataFrame:
    """Raise when there is no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


_RECORD = "_whole_record"


def read_csv(spark: SparkSession, path, sep=",") -> DataFrame:
    """Header CSV scan; every column text, missing-value tokens as null.

    Every file must have the first one's header, in its order, and a row with
    more fields than the header ends the scan: nothing is cut off or shifted
    silently.  A row with fewer fields has nulls for the rest.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RECORD]])
    df = (
        reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD)
        .option("enforceSchema", False)
        # Whole records, also where few columns are wanted: else long ones pass unseen.
        .option("columnPruning", False).csv(path)
    )
    # Of the records that do not fit, those with a value for every column are too long.
    record = F.col(_RECORD)
    bare = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    fields = 1 + F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))
    too_long = F.raise_error(F.concat(F.lit("row has extra columns: "), record)).cast("string")
    return df.select(*[
        F.when(record.isNotNull() & (fields > len(names)), too_long).otherwise(missing_to_null(F.col(f"`{c}`"))).alias(c)
        for c in names])


def read_typed_csv(spark: SparkSession, path, schema: T.StructType = CLAIMS_FILE_SCHEMA) -> DataFrame:
    """Header CSV scan whose load fails on the first value of a wrong type.

    The columns found keep the file's names and order, so that a later check
    can compare them; a column unknown to the schema is text.
    """
    types = {f.name: f.dataType for f in schema}
    df = read_csv(spark, path)
    out = []
    for name in df.columns:
        text = F.col(f"`{name}`")
        want = types.get(name.strip().lower(), T.StringType())
        if want == T.LongType():
            message = F.concat(F.lit(f"{name}: not a whole number: "), text)
            text = F.when(text.isNotNull(), F.coalesce(
                to_whole(text), F.raise_error(message).cast("bigint")))
        out.append(text.alias(name))
    return df.select(*out)


def read_headerless(spark: SparkSession, path) -> DataFrame:
    """(file_path, values): the delimiter follows from each file's name.

    Blank lines are dropped and missing-value tokens become null.
    """
    lines = spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("file_path"))
    return split_values(lines)


def split_values(lines: DataFrame) -> DataFrame:
    """Split (value, file_path) lines into an array of values."""
    cut = F.when(
        P.delimiter("file_path") == "|", F.split("value", r"\|", -1)
    ).otherwise(F.split("value", ",", -1))
    values = F.transform(cut, lambda v: missing_to_null(v))
    return lines.filter(F.trim("value") != "").select("file_path", values.alias("values"))
