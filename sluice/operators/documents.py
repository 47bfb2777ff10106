"""Document text to records: label, class, fields, score, review.

One narrow job over (file_path, file_name, text); all expressions built in.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.hashing import document_key
from sluice.functions.text import (
    capture, captured, column, cut, even_blanks, first_capture, strip,
)
from sluice.model import (
    CLASSIFIED_BONUS, DIRECT_TEXT_MIN_CHARS, DOCUMENT_COLUMNS, PREVIEW_CHARS, REVIEW_BELOW,
)
from sluice.operators.once import compute_in_steps, compute_once

# Document classes in test order, each with its patterns.
CLASS_PATTERNS = [
    ("discharge_summary", [r"\bdischarge summary\b", r"\bhospital discharge\b"]),
    ("consult_note", [r"\bconsult note\b", r"\bconsultation\b"]),
    ("progress_note", [r"\bprogress note\b"]),
    ("operative_report", [r"\boperative report\b", r"\boperation performed\b"]),
    ("history_and_physical", [r"\bhistory and physical\b", r"\bh&p\b"]),
    ("lab_report", [r"\blaboratory report\b", r"\blab results?\b"]),
    ("radiology_report", [r"\bradiology report\b", r"\bimpression\b", r"\bfindings\b"]),
    ("consent_form", [r"\bconsent\b", r"\binformed consent\b"]),
]
# The one pattern that can never match lower-cased text when written in capitals.
CAPITALS_ONLY = r"\bh&p\b"

# One pattern per field.
DATE_TEXT = r"([0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4})"
NAME_TEXT = r"([A-Z][A-Za-z,\-.' ]+)"
FIELD_PATTERNS = {
    "patient_name": r"(?:Patient Name|Name)[:\s]+" + NAME_TEXT,
    "mrn": r"(?:MRN|Medical Record Number|Chart Number)[:\s#]+([A-Za-z0-9\-]+)",
    "dob": r"(?:DOB|Date of Birth)[:\s]+" + DATE_TEXT,
    "sex": r"(?:Sex|Gender)[:\s]+(Male|Female|M|F)",
    "admit_date": r"(?:Admit Date|Admission Date)[:\s]+" + DATE_TEXT,
    "discharge_date": r"(?:Discharge Date)[:\s]+" + DATE_TEXT,
    "encounter_date": r"(?:Encounter Date|Visit Date|Date of Service)[:\s]+" + DATE_TEXT,
    "diagnosis": r"(?:Primary Diagnosis|Diagnosis|Discharge Diagnosis)[:\s]+(.+)",
    "provider": r"(?:Attending Physician|Provider|Author|Ordering Physician)[:\s]+" + NAME_TEXT,
}
# The ten-field variant, with its fallbacks in order.
LABELLED_PATTERNS = {
    "patient_name": [r"Patient Name[:\s]+" + NAME_TEXT, r"Name[:\s]+" + NAME_TEXT],
    "mrn": [r"(?:MRN|Medical Record Number)[:\s#]+([A-Za-z0-9\-]+)"],
    "dob": [FIELD_PATTERNS["dob"]],
    "sex": [FIELD_PATTERNS["sex"]],
    "admit_date": [FIELD_PATTERNS["admit_date"]],
    "discharge_date": [FIELD_PATTERNS["discharge_date"]],
    "encounter_date": [FIELD_PATTERNS["encounter_date"]],
    "document_type": [r"Document Type[:\s]+([A-Za-z /-]+)",
                      r"^(Discharge Summary|Consult Note|Operative Report|Progress Note)$"],
    "diagnosis": [r"(?:Primary Diagnosis|Diagnosis)[:\s]+(.+)"],
    "provider": [r"(?:Attending Physician|Provider|Author)[:\s]+" + NAME_TEXT],
}
FIELDS = list(FIELD_PATTERNS)


def method_label(text, fallback_text=None, weak="direct_pdf_text_weak") -> Column:
    """How the text was obtained: enough text directly, a fallback, or weak."""
    enough = F.length(strip(text)) >= DIRECT_TEXT_MIN_CHARS
    label = F.when(enough, "direct_pdf_text")
    if fallback_text is not None:
        label = label.when(column(fallback_text).isNotNull(), "ocr_fallback")
    return label.otherwise(weak)


def chosen_text(text, fallback_text=None) -> Column:
    """The direct text if there is enough of it, else the fallback if given."""
    if fallback_text is None:
        return column(text)
    enough = F.length(strip(text)) >= DIRECT_TEXT_MIN_CHARS
    return F.when(enough, column(text)).otherwise(F.coalesce(column(fallback_text), column(text)))


def classify(text, parity=True) -> Column:
    """First class with a matching pattern, or null.

    With ``parity`` the capital-letter pattern stays without effect, as it is
    on lower-cased text; without it, the abbreviation counts.
    """
    return classify_lowered(F.lower(column(text)), parity)


def classify_lowered(lowered: Column, parity=True) -> Column:
    """As ``classify``; a pattern runs only where its literal part occurs."""
    chain = None
    for label, patterns in CLASS_PATTERNS:
        tests = [
            lowered.contains(pattern.replace(r"\b", "").removesuffix("s?")) & lowered.rlike(pattern)
            for pattern in patterns if not (parity and pattern == CAPITALS_ONLY)]
        test = reduce(lambda a, b: a | b, tests)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def nine_fields(text) -> dict:
    return {name: first_capture(text, pattern) for name, pattern in FIELD_PATTERNS.items()}


def _flags(pattern) -> str:
    return "im" if pattern.startswith("^") else "i"


def _first_filled(tries) -> Column:
    """An empty capture gives way to the next pattern's."""
    return F.coalesce(*[F.when(t != "", t) for t in tries[:-1]], tries[-1])


def confidence(document_type="document_type", fields=FIELDS) -> Column:
    """Share of fields found, more if classified, at most 1, two places."""
    found = F.lit(0)
    for c in fields:
        found = found + F.when(F.length(F.col(c)) > 0, 1).otherwise(0)
    base = found / F.lit(float(len(fields)))
    bonus = F.when(F.col(document_type).isNotNull(), CLASSIFIED_BONUS).otherwise(0.0)
    return F.round(F.least(base + bonus, F.lit(1.0)), 2)


def needs_review(score="confidence_score", below=REVIEW_BELOW) -> Column:
    return F.col(score) < below


def review_reason(score="confidence_score") -> Column:
    return F.concat(F.lit("Low confidence score: "), F.col(score).cast("string"))


def split_readable(documents: DataFrame, text="text"):
    """(readable, failed): a document without text fails alone."""
    failed = documents.filter(F.col(text).isNull()).withColumn(
        "reason", F.lit("Processing failure: no readable text"))
    return documents.filter(F.col(text).isNotNull()), failed


def with_normal_text(df: DataFrame, text, name="full_text") -> DataFrame:
    """Add ``normalize_text(text)``, made once per row: its patterns first, then the strip."""
    return compute_once(compute_once(df, _even=even_blanks(text)), **{name: strip("_even")}).drop("_even")


def parse_documents(documents: DataFrame, run_id, processed_at, parity=True,
                    fallback_text=None, document_id=None, keep_text=False, columns=DOCUMENT_COLUMNS, readable_only=True) -> DataFrame:
    """The 19-column record of each document with text, or the ``columns`` of it.

    The same path has the same ``document_id`` in every run, so a second run
    updates its records.  Patterns run for the wanted columns only; the score
    needs all of them.  Without ``readable_only`` documents without text stay,
    with a null ``full_text``.
    """
    scored = bool({"confidence_score", "needs_review"} & set(columns))
    fields = [n for n in FIELDS if scored or n in columns]
    classed = scored or "document_type" in columns
    raw = chosen_text("text", fallback_text)
    base = (documents.filter(F.col("text").isNotNull()) if readable_only else documents).select(
        "file_path", "file_name",
        (document_id if document_id is not None else document_key("file_path")).alias("document_id"),
        method_label("text", fallback_text).alias("extraction_method"), raw.alias("_raw"),
    )
    if fields or classed or keep_text or "raw_text_preview" in columns:
        base = with_normal_text(base, "_raw")
    made = {f"_{n}": capture("full_text", FIELD_PATTERNS[n]) for n in fields}
    if classed:
        base = base.withColumn("_lowered", F.lower("full_text"))
        made["document_type"] = classify_lowered(F.col("_lowered"), parity)
    record = compute_in_steps(base, **made)
    # The score looks at every field: stripped once, not once more for the score.
    record = compute_in_steps(record, **{n: captured(f"_{n}") for n in fields})
    record = record.withColumns({"run_id": F.lit(run_id), "processed_at": F.lit(str(processed_at))})
    if scored:
        record = compute_once(record, confidence_score=confidence())
        record = record.withColumn("needs_review", needs_review())
    if "raw_text_preview" in columns:
        record = record.withColumn("raw_text_preview", cut("full_text", PREVIEW_CHARS))
    return record.select(*columns, *(["full_text"] if keep_text else []))


def parse_labelled(documents: DataFrame, text="text", fallback_text=None) -> DataFrame:
    """(file_name, extraction_method, ten fields, raw_text_preview, full_text)."""
    label = method_label(text, fallback_text, weak="direct_pdf_text_failed_no_ocr")
    base = with_normal_text(documents.select(
        "file_name", label.alias("extraction_method"), chosen_text(text, fallback_text).alias("_raw")), "_raw")
    record = base.select("file_name", "extraction_method", "full_text")
    # Each pattern runs once per text; a capture is looked at several times.
    record = compute_once(record, **{
        f"_{name}_{i}": capture("full_text", p, _flags(p)) for name, patterns in LABELLED_PATTERNS.items() for i, p in enumerate(patterns)})
    fields = {name: _first_filled([captured(f"_{name}_{i}") for i in range(len(patterns))]) for name, patterns in LABELLED_PATTERNS.items()}
    return record.select(
        "file_name", "extraction_method", *[c.alias(name) for name, c in fields.items()],
        cut("full_text", PREVIEW_CHARS).alias("raw_text_preview"), "full_text")


def review_queue(parsed: DataFrame, quarantined_at) -> DataFrame:
    """(file_name, reason, quarantined_at, payload) of low-score documents."""
    low = parsed.filter(F.col("needs_review"))
    payload = F.struct(
        F.struct(*DOCUMENT_COLUMNS).alias("parsed_document"), "document_type", "extraction_method")
    return low.select(
        "file_name", review_reason().alias("reason"),
        F.lit(str(quarantined_at)).alias("quarantined_at"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"))


def failure_queue(failed: DataFrame, quarantined_at) -> DataFrame:
    return failed.select(
        "file_name", "reason", F.lit(str(quarantined_at)).alias("quarantined_at"),
        F.to_json(F.struct("file_path")).alias("payload"))


def run_totals(documents: DataFrame, parsed: DataFrame) -> DataFrame:
    """(succeeded, failed, review_needed) of a run."""
    done = parsed.agg(F.count("*").alias("succeeded"), F.count_if("needs_review").alias("review_needed"))
    lost = documents.agg(F.count_if(F.col("text").isNull()).alias("failed"))
    both = done.unionByName(lost, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in ("succeeded", "failed", "review_needed")])
