"""Column lists, table schemas and the fixed values of the rules."""

from pyspark.sql import types as T

# Fixed column orders of the inputs and outputs.
CLAIM_COLUMNS_STRICT = [
    "claim_id", "patient_id", "provider_id", "diagnosis_code",
    "procedure_code", "claim_amount", "service_date",
]
CLAIM_COLUMNS_LINES = [
    "provider_id", "claim_amount", "claim_id", "service_date",
    "patient_id", "procedure_code", "diagnosis_code",
]
SOURCE_COLUMNS = [
    "claim_id", "patient_id", "provider_id", "diagnosis_code",
    "procedure_code", "amount", "service_date",
]
STAGE_COLUMNS = [
    "provider_id", "amount", "claim_id", "service_date",
    "patient_id", "procedure_code", "diagnosis_code", "load_id",
]
PATIENT_REQUIRED = ["patient_id", "name", "dob"]
WAREHOUSE_PATIENT_COLUMNS = ["patient_id", "first_name", "last_name", "dob", "source_system"]
INTEGER_COLUMNS = ["claim_id", "patient_id", "provider_id", "procedure_code"]
DOCUMENT_COLUMNS = [
    "run_id", "document_id", "file_name", "file_path", "processed_at",
    "extraction_method", "document_type", "patient_name", "mrn", "dob",
    "sex", "admit_date", "discharge_date", "encounter_date", "diagnosis",
    "provider", "confidence_score", "needs_review", "raw_text_preview",
]

# Fixed code lists: procedure codes a claims file may carry, and the codes the
# target-side reason expression knows.
FILE_PROCEDURE_CODES = ["99213", "80050", "93000", "71020", "99214", "36415"]
TARGET_PROCEDURE_CODES = ["J5502", "99202", "99203", "99201"]

# Fixed limits.
PREVIEW_CHARS = 1000
ERROR_CHARS = 4000
DIRECT_TEXT_MIN_CHARS = 100
REVIEW_BELOW = 0.60
CLASSIFIED_BONUS = 0.10
CSV_FIELD_LIMIT = 131072

# Fixed column widths of the target tables.
WIDTHS = {
    "claim_id": 100, "patient_id": 100, "provider_id": 100,
    "diagnosis_code": 50, "procedure_code": 50, "record_hash": 64,
}
REASON_WIDTH = 255

AMOUNT = T.DecimalType(18, 2)


def _struct(spec):
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


CLAIMS_FILE_SCHEMA = _struct([
    ("claim_id", T.LongType()), ("patient_id", T.LongType()),
    ("provider_id", T.LongType()), ("diagnosis_code", T.StringType()),
    ("procedure_code", T.LongType()), ("claim_amount", T.StringType()),
    ("service_date", T.StringType()),
])

_CLAIM = [
    ("claim_id", T.StringType()), ("patient_id", T.StringType()),
    ("provider_id", T.StringType()), ("diagnosis_code", T.StringType()),
    ("procedure_code", T.StringType()), ("amount", AMOUNT),
    ("service_date", T.DateType()),
]
_STAMP = [("ingested_at", T.TimestampType()), ("record_hash", T.StringType())]

TARGET_SCHEMA = _struct(_CLAIM + _STAMP)
STAGE_SCHEMA = _struct(
    [("load_id", T.StringType())] + _CLAIM + _STAMP + [("stg_claim_row_id", T.LongType())]
)
REJECTS_SCHEMA = _struct(
    [("load_id", T.StringType()), ("stg_claim_row_id", T.LongType())] + _CLAIM + _STAMP
    + [("rejection_reason", T.StringType()), ("rejected_at", T.TimestampType())]
)
QUARANTINE_SCHEMA = _struct(
    [("load_id", T.StringType())] + _CLAIM
    + [("rejection_reason", T.StringType()), ("source_row_payload", T.StringType()),
       ("quarantined_at", T.TimestampType())]
)
AUDIT_COUNTERS = [
    "source_rows_read", "source_rows_quarantined", "staged_rows_loaded",
    "target_rows_rejected", "target_rows_upserted",
]
AUDIT_EVENT_SCHEMA = _struct(
    [("load_id", T.StringType()), ("event_seq", T.LongType()),
     ("event_key", T.StringType()), ("process_name", T.StringType())]
    + [(c, T.LongType()) for c in AUDIT_COUNTERS]
    + [("reconciliation_status", T.StringType()), ("status", T.StringType()),
       ("error_message", T.StringType()), ("event_at", T.TimestampType())]
)
