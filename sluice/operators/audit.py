"""Audit as an append-only list of events; the state of a load is a query.

Every event has a key, and a replayed event (a retried batch) repeats its key,
so reading counts it once.  A load that is run again is another attempt: its
events have keys and sequence numbers of their own, and the state of the load
is the state of its last attempt.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.model import AUDIT_COUNTERS, AUDIT_EVENT_SCHEMA, ERROR_CHARS


#: Sequence numbers of one attempt.
ATTEMPT = 2**48


def event(load_id, seq, key, process_name, at, status=None, reconciliation=None,
          error=None, attempt=0, **deltas):
    """One event row; counters not named are 0."""
    seq, key = int(seq) + attempt * ATTEMPT, f"{attempt}/{key}" if attempt else key
    if isinstance(at, str):
        at = datetime.fromisoformat(at)
    unknown = set(deltas) - set(AUDIT_COUNTERS)
    if unknown:
        raise ValueError(f"unknown counters: {sorted(unknown)}")
    row = {
        "load_id": load_id, "event_seq": int(seq), "event_key": str(key),
        "process_name": process_name, "reconciliation_status": reconciliation,
        "status": status, "error_message": error[:ERROR_CHARS] if error else None,
        "event_at": at,
    }
    row.update({c: int(deltas.get(c, 0)) for c in AUDIT_COUNTERS})
    return tuple(row[f.name] for f in AUDIT_EVENT_SCHEMA)


def started(load_id, process_name, at, attempt=0):
    return event(load_id, 0, "start", process_name, at, status="STARTED", reconciliation="PENDING", attempt=attempt)


def progress(load_id, process_name, at, batch_id, attempt=0, **deltas):
    return event(load_id, 1 + int(batch_id), f"batch-{batch_id}", process_name, at, attempt=attempt, **deltas)


# Closing events come after every batch.
_MERGED, _RECONCILED, _FAILED = 2**40, 2**40 + 1, 2**40 + 2


def succeeded(load_id, process_name, at, rejected, upserted, attempt=0):
    return event(load_id, _MERGED, "merge", process_name, at, status="SUCCESS", attempt=attempt,
                 target_rows_rejected=rejected, target_rows_upserted=upserted)


def reconciled(load_id, process_name, at, status, attempt=0):
    return event(load_id, _RECONCILED, "reconcile", process_name, at, reconciliation=status, attempt=attempt)


def failed(load_id, process_name, at, error, attempt=0):
    return event(load_id, _FAILED, "failure", process_name, at, status="FAILED", error=str(error), attempt=attempt)


def events_frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, AUDIT_EVENT_SCHEMA)


def reconciliation_status(read="source_rows_read", quarantined="source_rows_quarantined",
                          staged="staged_rows_loaded"):
    """MATCH when what was read and not quarantined was staged."""
    ok = F.col(read) - F.col(quarantined) == F.col(staged)
    return F.when(ok, "MATCH").otherwise("MISMATCH")


def reconcile(counts: DataFrame) -> DataFrame:
    """Add expected_staged and reconciliation_status to rows of counters."""
    expected = F.col("source_rows_read") - F.col("source_rows_quarantined")
    return counts.withColumn("expected_staged", expected).withColumn(
        "reconciliation_status", reconciliation_status())


def check_batch(valid_rows: int, staged_rows: int, batch="load"):
    if valid_rows != staged_rows:
        raise ValueError(f"{batch}: {valid_rows} valid rows, but {staged_rows} staged")


def latest_state(events: DataFrame) -> DataFrame:
    """One row per load, of its last attempt: counters summed, latest status, first and last times."""
    attempt = F.expr(f"event_seq div {ATTEMPT}")
    once = events.dropDuplicates(["load_id", "event_key"]).withColumn("attempt", attempt)

    def latest(c):
        # max_by over the events that set the column.
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("event_seq"))).alias(c)

    closing = F.col("event_seq") % ATTEMPT >= _MERGED
    states = once.groupBy("load_id", "attempt").agg(
        F.min_by("process_name", "event_seq").alias("process_name"),
        *[F.sum(c).alias(c) for c in AUDIT_COUNTERS],
        latest("reconciliation_status"), latest("status"), latest("error_message"),
        F.max("event_at").alias("updated_at"), F.min("event_at").alias("started_at"),
        F.max(F.when(closing, F.col("event_at"))).alias("completed_at"),
    )
    # One small row per attempt is left; the last one is the state.
    names = [c for c in states.columns if c not in ("load_id", "attempt")]
    last = states.groupBy("load_id").agg(F.max_by(F.struct(*names), "attempt").alias("last"))
    return last.select("load_id", "last.*")


def next_attempt(events: DataFrame, load_id) -> int:
    """0 for a load without events, else the number after its last attempt."""
    last = events.where(F.col("load_id") == load_id).agg(F.max(F.expr(f"event_seq div {ATTEMPT}"))).first()[0]
    return 0 if last is None else int(last) + 1


def stage_counts(df: DataFrame, reasons="reasons") -> DataFrame:
    """(rows_read, rows_clean, rows_bad) in one pass."""
    bad = F.size(F.col(reasons)) > 0
    return df.agg(
        F.count("*").alias("rows_read"), F.count_if(~bad).alias("rows_clean"),
        F.count_if(bad).alias("rows_bad"))


def rejects_per_load(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("load_id").agg(F.count("*").alias("target_rows_rejected"))
