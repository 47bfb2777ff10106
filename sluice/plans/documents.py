"""Documents to records, review queue, summary and target."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions.hashing import document_key
from sluice.functions.text import cut
from sluice.model import DOCUMENT_COLUMNS, PREVIEW_CHARS
from sluice.operators.documents import (
    failure_queue, parse_documents, parse_labelled, review_queue, run_totals, split_readable,
)
from sluice.plans.migration import upsert_version
from sluice.session import materialize
from sluice.sinks.archive import write_json, write_summary
from sluice.sources.documents import read_documents

# Columns of a record that follow from its path and its text.
DERIVED = ("document_id", "raw_text_preview")


def run_documents(spark: SparkSession, documents: DataFrame, output, run_id, processed_at,
                  target=None, parity=True, buckets=16, compression="gzip") -> dict:
    """Parse documents and write records, queues and the summary of a run.

    Without input the run does nothing.  With a ``target``, records replace
    those of the same document, in ``buckets`` key buckets when the run
    creates the target (an existing target keeps its own).  Records, queues
    and the summary are text files with ``compression`` ("none" for plain ones).
    """
    if documents.isEmpty():
        return {"run_id": run_id, "succeeded": 0, "failed": 0, "review_needed": 0}
    # One pass writes every document once, unreadable ones with their path alone;
    # what follows from a written column is made again where it is read.
    shown = [c for c in DOCUMENT_COLUMNS if c not in DERIVED]
    made = parse_documents(documents, run_id, processed_at, parity, keep_text=True, columns=shown, readable_only=False)
    rows = materialize(made, "parsed-documents")
    failed = split_readable(rows, "full_text")[1]
    parsed = rows.filter(F.col("full_text").isNotNull()).withColumns({
        "document_id": document_key("file_path"), "raw_text_preview": cut("full_text", PREVIEW_CHARS)})
    parsed = parsed.select(*DOCUMENT_COLUMNS, "full_text")
    write_json(parsed, f"{output}/parsed_json/{run_id}", mode="overwrite", compression=compression)
    queue = review_queue(parsed, processed_at).unionByName(failure_queue(failed, processed_at))
    write_json(queue, f"{output}/quarantine/{run_id}", mode="overwrite", compression=compression)
    records = parsed.select(*DOCUMENT_COLUMNS)
    write_summary(records, f"{output}/summaries/run_{run_id}_summary", mode="overwrite", compression=compression)
    upserted = 0
    if target is not None:
        upserted = upsert_version(
            spark, target, records, run_id, "always", None, key="document_id", schema=records.schema, buckets=buckets, stored=True)
    totals = run_totals(rows.withColumnRenamed("full_text", "text"), parsed).first().asDict()
    return {"run_id": run_id, **totals, "upserted": upserted}


def run_folder(spark: SparkSession, folder, output, run_id, processed_at, pattern="*.txt", **options) -> dict:
    return run_documents(
        spark, read_documents(spark, folder, pattern), output, run_id, processed_at, **options)


def run_labelled(documents: DataFrame, output, failures=None, quarantined_at=None) -> None:
    """The ten-field variant, one JSON record per document with text.

    The others go to ``failures``, by default the folder ``<output>_failures``.
    """
    readable, failed = split_readable(documents)
    write_json(failure_queue(failed, quarantined_at), failures or f"{output}_failures", mode="overwrite")
    parsed = parse_labelled(readable)
    fields = [c for c in parsed.columns if c not in ("file_name", "extraction_method", "full_text")]
    record = parsed.select(
        "file_name", "extraction_method", F.struct(*fields).alias("parsed_fields"), "full_text")
    write_json(record, output, mode="overwrite")
