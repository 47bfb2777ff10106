"""Quarantine rows with their payload."""

from pyspark.sql import DataFrame, functions as F

from sluice.functions import coerce as K
from sluice.model import QUARANTINE_SCHEMA, SOURCE_COLUMNS


def payload_source(df: DataFrame, columns=SOURCE_COLUMNS):
    """Columns as the payload shows them: numbers stay numbers, the rest text."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    kinds = dict(df.dtypes)
    return [
        F.col(c) if kinds[c] in numeric or kinds[c] == "array<string>"
        else F.col(c).cast("double").alias(c) if kinds[c].startswith("decimal")
        else F.col(c).cast("string").alias(c)
        for c in columns
    ]


def quarantine_rows(bad: DataFrame, load_id, run_ts, reason="rejection_reason",
                    payload_columns=None) -> DataFrame:
    """Rows of the quarantine table from rejected source rows."""
    shown = payload_columns or [*SOURCE_COLUMNS, reason]
    payload = F.to_json(F.struct(*payload_source(bad, shown)), {"ignoreNullFields": "false"})
    rows = bad.select(
        F.lit(load_id).alias("load_id"),
        *[F.col(c) for c in SOURCE_COLUMNS],
        F.col(reason).alias("rejection_reason"),
        payload.alias("source_row_payload"),
        F.lit(run_ts).cast("timestamp").alias("quarantined_at"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUARANTINE_SCHEMA])


def safe_values(df: DataFrame) -> DataFrame:
    """Null-safe int, decimal-as-float, text and date text of the claim columns."""
    return df.select(
        *[K.as_int(c).alias(c) for c in ("claim_id", "patient_id", "provider_id")],
        *[K.as_text(c).alias(c) for c in ("diagnosis_code", "procedure_code")],
        K.as_float("amount").alias("amount"), K.date_text("service_date").alias("service_date"),
    )
