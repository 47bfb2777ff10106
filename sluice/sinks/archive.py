"""CSV and JSON archives of rejected rows and records."""

from pyspark.sql import DataFrame, functions as F

from sluice.model import DOCUMENT_COLUMNS


def csv_writer(df: DataFrame):
    """Values are written as they are, blanks at the ends included."""
    return (
        df.write.option("header", True).option("quote", '"').option("escape", '"')
        .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def flat_text(df: DataFrame) -> DataFrame:
    """Columns a CSV file can hold; arrays become text."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.array_join(c, "; ").alias(c) if kinds[c] == "array<string>" else F.col(c) for c in df.columns])


def write_csv(df: DataFrame, path, order=(), hidden=(), mode="errorifexists", partition_by=()) -> None:
    """CSV parts with a header, in ``order`` from part to part.

    ``hidden`` columns order the rows but are not written; ``partition_by``
    columns name a folder per value.
    """
    out = flat_text((df.orderBy(*order) if order else df).drop(*hidden))
    csv_writer(out).partitionBy(*partition_by).mode(mode).csv(path)


def write_json(df: DataFrame, path, mode="errorifexists", compression="none") -> None:
    """One JSON object per line and row; nulls are kept."""
    df.write.option("ignoreNullFields", "false").option("compression", compression).mode(mode).json(path)


def write_summary(parsed: DataFrame, path, mode="errorifexists", compression="none") -> None:
    csv_writer(parsed.select(*DOCUMENT_COLUMNS)).option("compression", compression).mode(mode).csv(path)
