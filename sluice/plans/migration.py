"""Source table to target: extract, quarantine, stage, merge, audit."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sluice.model import (
    AUDIT_COUNTERS, AUDIT_EVENT_SCHEMA, REJECTS_SCHEMA, SOURCE_COLUMNS, STAGE_SCHEMA, TARGET_SCHEMA,
)
from sluice.operators import audit
from sluice.operators.dedupe import mark_first, part_repeated, surrogate_id
from sluice.operators.ordinal import with_ordinal
from sluice.operators.merge import (
    DUPLICATE_REASON, MERGE_ORDER, add_hash, changed_rows, insert_ignore, invalid_rejects, replace_rows,
    taken_rows,
)
from sluice.operators.quarantine import quarantine_rows
from sluice.operators.rules import is_target_valid, reasons_text, source_rules, type_source
from sluice.operators.schema import check_schema
from sluice.plans.claims import stage_output
from sluice.session import materialize, materialize_counted, observed
from sluice.sinks.publish import (
    BUCKET, Output, current_marker, next_version, publish, read_paths, read_version, remove, switch_version,
    write_aside,
)
from sluice.sinks.tables import append_rows, path_exists, read_load_table

PROCESS_NAME = "claims_migration"
SOURCE_DUPLICATE = "duplicate claim_id in source chunk"
# A parameter of upsert_version; small here, thousands for a large target.
TARGET_BUCKETS = 16


@dataclass(frozen=True)
class Tables:
    """Paths of the tables of one migration."""

    root: str

    def __getattr__(self, name):
        if name in ("stage", "target", "rejects", "quarantine", "quarantine_files", "file_rejects", "audit"):
            return f"{self.root}/{name}"
        raise AttributeError(name)


def source_checked(source: DataFrame, as_of) -> DataFrame:
    """Typed source rows with ``rejection_reason``, null for a good row."""
    typed = type_source(check_schema(source.select(*[c for c in source.columns if c != "row_id"]), SOURCE_COLUMNS))
    return typed.withColumn("rejection_reason", reasons_text(source_rules(as_of)))


# The extract is ordered by key; further columns make the order a full one.
SOURCE_ORDER = [(c, "asc") for c in SOURCE_COLUMNS]


def source_split(rows: DataFrame, key="claim_id", order=SOURCE_ORDER, row_id="source_row"):
    """The written, checked rows that passed, with ``is_kept``: the first of a key is staged, its others are duplicates."""
    keys = [key] if isinstance(key, str) else list(key)
    passed = rows.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")
    return mark_first(passed, keys, list(order), row_id, "is_kept")


def quarantined_rows(rows: DataFrame, split: DataFrame) -> DataFrame:
    """To quarantine: rows with a reason, as they were written when checked, and the duplicates of the written split."""
    repeated = split.filter(~F.col("is_kept")).drop("is_kept").withColumn("rejection_reason", F.lit(SOURCE_DUPLICATE))
    return rows.filter(F.col("rejection_reason").isNotNull()).unionByName(repeated)


def write_audit(spark: SparkSession, tables: Tables, *events) -> None:
    append_rows(audit.events_frame(spark, list(events)), tables.audit)


def audit_state(spark: SparkSession, tables: Tables) -> DataFrame:
    return audit.latest_state(spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit))


def merge_load(spark: SparkSession, tables: Tables, load_id, as_of, run_ts, policy="null_safe",
               hash_mode="md5", enforce_codes=False, order=MERGE_ORDER, keep_rejects=True, buckets=TARGET_BUCKETS) -> dict:
    """Merge one staged load into the target; running it again changes nothing.

    ``buckets`` is the target's number of key buckets when the merge creates
    it; a target that exists keeps its own.

    ``rejected_rows`` counts invalid rows newly rejected, ``rejected_total``
    all rejects of the load, duplicates included.
    """
    stage = read_load_table(spark, tables.stage, STAGE_SCHEMA, load_id)
    # A hash made of the row's own columns is neither shuffled nor written aside, but made where it is needed.
    late = (lambda rows: add_hash(rows, hash_mode)) if hash_mode == "md5" else (lambda rows: rows)
    bare = stage.drop("record_hash") if hash_mode == "md5" else add_hash(stage, hash_mode)
    # A key's only row wins as it lies in the stage, neither shuffled nor written aside.
    single, shared = part_repeated(bare.filter(is_target_valid(as_of, enforce_codes)), ["claim_id"])
    marked = mark_first(shared, ["claim_id"], order, "stg_claim_row_id", late=late)
    judged, seen = materialize_counted(
        marked.select(*bare.columns, "is_first"), "judged-stage", ["is_first"], losers=F.count_if(~F.col("is_first")))

    new_invalid = rejected_total = 0
    if keep_rejects:
        # Invalid rows are a filter of the stage, which is a written table already.
        invalid = invalid_rejects(bare, as_of, enforce_codes)
        lost = judged.filter(~F.col("is_first")).drop("is_first").withColumn("rejection_reason", F.lit(DUPLICATE_REASON))
        refused = late(invalid.unionByName(lost)).withColumn("rejected_at", F.lit(run_ts).cast("timestamp"))
        new_invalid, rejected_total = _write_rejects(
            spark, tables, load_id, refused.select(*REJECTS_SCHEMA.names), lambda: invalid.count(), seen["losers"])

    winners = judged.filter("is_first").drop("is_first")
    if single is not None:
        winners = winners.unionByName(single)
    upserted = upsert_version(
        spark, tables.target, winners, load_id, policy, run_ts, buckets=buckets, late=late)
    return {"rejected_rows": new_invalid, "rejected_total": rejected_total, "upserted_rows": upserted}


def _write_rejects(spark, tables: Tables, load_id, refused: DataFrame, count_invalid, losers) -> tuple[int, int]:
    """Insert the refused rows of a load that are not known yet, and drop known ones that no longer hold.

    Returns (invalid rows newly rejected, all rejects of the load).  A staged
    row is refused once, so (row, reason) is unique among ``refused``.
    """
    keys = ["stg_claim_row_id", "rejection_reason"]
    known = read_load_table(spark, tables.rejects, REJECTS_SCHEMA, load_id)
    if not path_exists(spark, f"{tables.rejects}/load_id={load_id}"):
        invalid = count_invalid()
        if invalid + losers:
            publish(spark, load_id, [Output(tables.rejects, f"load_id={load_id}", refused.drop("load_id"), invalid + losers)])
        return invalid, invalid + losers
    # Keys alone tell whether anything changed; a row without an identity is always new.
    both = refused.select(*keys, F.lit(1).alias("now"), F.lit(0).alias("then")).unionByName(
        known.select(*keys, F.lit(0).alias("now"), F.lit(1).alias("then")))
    pairs = both.groupBy(*keys).agg(F.sum("now").alias("now"), F.sum("then").alias("then"))
    unnamed = F.col("stg_claim_row_id").isNull()
    new = F.when(unnamed | (F.col("then") == 0), F.col("now")).otherwise(0)
    tally = pairs.agg(
        F.sum("now").alias("all"), F.sum(new).alias("new"),
        F.sum(F.when(F.col("rejection_reason") != DUPLICATE_REASON, new)).alias("invalid"),
        F.sum(F.when(unnamed | (F.col("now") == 0), F.col("then"))).alias("gone")).first()
    if not tally["new"] and not tally["gone"]:
        return 0, tally["all"] or 0
    # A reject that no longer holds, as its stage row was corrected, goes.
    still = known.join(refused.select(*keys), keys, "left_semi").select(*REJECTS_SCHEMA.names)
    now = materialize(insert_ignore(known, refused, keys).unionByName(still), "rejects")
    total = now.count()
    publish(spark, load_id, [Output(tables.rejects, f"load_id={load_id}", now.drop("load_id"), total)])
    return tally["invalid"] or 0, total


def upsert_version(spark, root, source, load_id, policy, run_ts, key="claim_id", schema=TARGET_SCHEMA,
                   stamp_column="ingested_at", buckets=TARGET_BUCKETS, stored=False, late=None) -> int:
    """Upsert into a versioned table; returns the rows inserted or updated.

    Rows lie in ``buckets`` folders by a hash of the key, a number fixed when
    the table is created: choose it so that a bucket holds some gigabytes.
    The changed rows are found by key and hash alone and written once; only
    buckets that hold one of them are read as a whole and written again, and
    without a change nothing is.  A table without rows takes the source as it
    is.  ``stored``: the source is read from a written table, so it is not
    written aside where all of it is taken.  ``late`` adds columns that need
    not be shuffled: to rows already dealt by key or bucket.
    """
    late = late or (lambda rows: rows)
    marker = current_marker(spark, root) or {"buckets": {}}
    held = marker["buckets"]
    buckets = marker.get("count", buckets)
    in_bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    version = next_version(spark, root, load_id)
    metrics = {"rows": F.count(F.lit(1)), "buckets": F.collect_set(BUCKET)}
    if not held:
        # Rebalancing gives a bucket one file, or several of even size where it is large.
        dealt = late(source.filter(F.col(key).isNotNull()).withColumn(BUCKET, in_bucket).hint("rebalance", F.col(BUCKET)))
        taken = taken_rows(dealt, schema, key, run_ts, stamp_column, [BUCKET])
        seen = Observation("new-target")
        write_aside(taken.observe(seen, *[c.alias(k) for k, c in metrics.items()]), root, version, [BUCKET])
        written = read_paths(spark, [f"{root}/{version}"], schema)
        got = observed(seen, lambda: written.withColumn(BUCKET, in_bucket).agg(
            *[c.alias(k) for k, c in metrics.items()]).first().asDict())
        if not got["rows"]:
            remove(spark, f"{root}/{version}")
            return 0
        switch_version(spark, root, version, {str(b): version for b in got["buckets"]}, buckets)
        return got["rows"]
    if policy == "always":
        changed = taken_rows(late(source), schema, key, run_ts, stamp_column).withColumn(BUCKET, in_bucket)
    else:
        target = read_version(spark, root, schema)
        changed = changed_rows(target, late(source.repartition(key)), key, policy, stamp=run_ts, stamp_column=stamp_column).withColumn(BUCKET, in_bucket)
    if policy == "always" and stored:
        seen = changed.agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict()
    else:
        changed, seen = materialize_counted(changed, "changed-rows", **metrics)
    # At most ``buckets`` numbers.
    touched = [str(b) for b in seen["buckets"] or []]
    if not touched:
        return 0
    old = read_paths(spark, [f"{root}/{held[b]}/{BUCKET}={b}" for b in touched if b in held], schema)
    if policy == "always":
        # Often all rows are replaced: the keys that stay are found by keys alone.
        stay = materialize(old.select(key).join(changed.select(key), key, "left_anti"), "kept-keys")
        merged = old.join(stay, key, "left_semi").withColumn(BUCKET, in_bucket).select(*changed.columns).unionByName(changed)
    else:
        merged = replace_rows(old.withColumn(BUCKET, in_bucket), changed, key)
    write_aside(merged.hint("rebalance", F.col(BUCKET)), root, version, [BUCKET])
    switch_version(spark, root, version, {**held, **{b: version for b in touched}}, buckets)
    return seen["rows"]


def chunked_rows(checked: DataFrame, chunk_size: int) -> DataFrame:
    """Checked source rows with ``source_row``, their place in the extract's order (claim_id and all columns, nulls last), and ``chunk``, from 1.

    The places come from ranges of the order and running sums of their
    counts, so no task holds the whole extract, and they do not change with
    the layout of the source files.
    """
    numbered = with_ordinal(checked, SOURCE_COLUMNS, name="source_row", label="source-rows", nulls_last=True)
    return numbered.drop("source_row_of").withColumn("chunk", (F.col("source_row") / F.lit(chunk_size)).cast("long") + 1)


def chunk_events(per_chunk: DataFrame, load_id, at, attempt=0) -> DataFrame:
    """A progress event per chunk, built where the counts are: (chunk, read, quarantined, staged)."""
    prefix = f"{attempt}/" if attempt else ""
    values = {
        "load_id": F.lit(load_id), "event_seq": F.col("chunk") + 1 + attempt * audit.ATTEMPT,
        "event_key": F.concat(F.lit(f"{prefix}batch-"), F.col("chunk").cast("string")), "process_name": F.lit(PROCESS_NAME),
        "source_rows_read": F.col("read"), "source_rows_quarantined": F.col("quarantined"), "staged_rows_loaded": F.col("staged"),
        "event_at": F.lit(at).cast("timestamp"),
    }
    return per_chunk.select(*[values.get(f.name, F.lit(0) if f.name in AUDIT_COUNTERS else F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIT_EVENT_SCHEMA])


def process_claims(spark: SparkSession, source: DataFrame, tables: Tables, load_id, as_of, run_ts,
                   policy="null_safe", hash_mode="md5", enforce_codes=False, chunk_size=None, buckets=TARGET_BUCKETS) -> dict:
    """Extract, quarantine, stage, merge, reconcile; always returns a result record.

    With ``chunk_size``, the extract in its order (claim_id, then every column)
    is cut into chunks of that many rows, as a database extract read in
    pieces would be: duplicates are found within a chunk, every chunk has its
    quarantine file, its progress event with its own counts, and its check
    that all its valid rows were staged.  A staged row is then named by its
    place in the extract.
    """
    if chunk_size:
        return _process_chunks(spark, source, tables, load_id, as_of, run_ts, policy, hash_mode, enforce_codes, chunk_size, buckets)
    at = run_ts
    counts = {"source_rows_read": 0, "source_rows_quarantined": 0, "staged_rows_loaded": 0}
    attempt = 0
    if path_exists(spark, tables.audit):
        attempt = audit.next_attempt(spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit), load_id)
    write_audit(spark, tables, audit.started(load_id, PROCESS_NAME, at, attempt))
    try:
        checked = surrogate_id(source_checked(source, as_of), "source_row")
        rows, refused = materialize_counted(checked, "source-rows", invalid=F.count_if(F.col("rejection_reason").isNotNull()))
        # Ranked and written once, and counted as they are written; rows with a reason stay in the table of checked rows.
        split, tally = materialize_counted(
            source_split(rows), "source-split", ["is_kept"], good=F.count_if("is_kept"), repeated=F.count_if(~F.col("is_kept")))
        good, quarantined = tally["good"], refused["invalid"] + tally["repeated"]
        # Every source row is kept or quarantined.
        counts.update(source_rows_read=good + quarantined, source_rows_quarantined=quarantined)

        bad = quarantined_rows(rows, split)
        files = Output(
            tables.quarantine_files, f"{load_id}_chunk_00001_bad_rows",
            bad.select(*SOURCE_COLUMNS, "rejection_reason"), quarantined, "csv")
        rows_out = publish(spark, load_id, [
            files,
            # A staged key has one row, so the key is its identity in every run and file layout.
            stage_output(split.filter("is_kept"), tables.stage, load_id, at, good, "claim_id"),
            # Replaced as a whole, also by no rows, so a corrected source leaves nothing behind.
            Output(tables.root, f"quarantine/load_id={load_id}", quarantine_rows(bad, load_id, at).drop("load_id"), quarantined),
        ])
        counts["staged_rows_loaded"] = rows_out[f"load_id={load_id}"]
        write_audit(spark, tables, audit.progress(load_id, PROCESS_NAME, at, 0, attempt, **counts))
        audit.check_batch(good, counts["staged_rows_loaded"])

        merged = merge_load(spark, tables, load_id, as_of, at, policy, hash_mode, enforce_codes, buckets=buckets)
        write_audit(spark, tables, audit.succeeded(
            load_id, PROCESS_NAME, at, merged["rejected_total"], merged["upserted_rows"], attempt))
        expected = counts["source_rows_read"] - counts["source_rows_quarantined"]
        status = "MATCH" if expected == counts["staged_rows_loaded"] else "MISMATCH"
        write_audit(spark, tables, audit.reconciled(load_id, PROCESS_NAME, at, status, attempt))
        return {
            "status": "SUCCESS", "load_id": load_id, **counts,
            "target_rows_rejected": merged["rejected_rows"],
            "target_rows_upserted": merged["upserted_rows"],
            "expected_staged": expected, "actual_staged": counts["staged_rows_loaded"],
            "reconciliation_status": status, "quarantine_files": [files.published],
        }
    except Exception as error:
        write_audit(spark, tables, audit.failed(load_id, PROCESS_NAME, at, error, attempt))
        return {"status": "FAILED", "load_id": load_id, "error": str(error), **counts, "quarantine_files": []}


def _process_chunks(spark, source, tables, load_id, as_of, at, policy, hash_mode, enforce_codes, chunk_size, buckets) -> dict:
    counts = {"source_rows_read": 0, "source_rows_quarantined": 0, "staged_rows_loaded": 0}
    attempt = 0
    if path_exists(spark, tables.audit):
        attempt = audit.next_attempt(spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit), load_id)
    write_audit(spark, tables, audit.started(load_id, PROCESS_NAME, at, attempt))
    try:
        rows = materialize(chunked_rows(source_checked(source, as_of), chunk_size), "source-chunks")
        split = materialize(source_split(rows, ["claim_id", "chunk"]), "source-split", ["is_kept"])
        bad = quarantined_rows(rows, split)
        # One row per chunk; summed in Spark, as chunks grow with the extract.
        verdicts = split.filter("is_kept").select("chunk", "is_kept").unionByName(bad.select("chunk", F.lit(False).alias("is_kept")))
        per_chunk = materialize(verdicts.groupBy("chunk").agg(
            F.count(F.lit(1)).alias("read"), F.count_if(~F.col("is_kept")).alias("quarantined"), F.count_if("is_kept").alias("valid")), "chunk-counts")
        total = per_chunk.agg(F.sum("read").alias("read"), F.sum("quarantined").alias("quarantined"), F.sum("valid").alias("valid")).first()
        good, quarantined = total["valid"] or 0, total["quarantined"] or 0
        counts.update(source_rows_read=total["read"] or 0, source_rows_quarantined=quarantined)

        chunk_file = F.concat(F.lit(f"{load_id}_chunk_"), F.format_string("%05d", F.col("chunk")), F.lit("_bad_rows"))
        # Dealt by chunk: a chunk has one file, not one per task.
        files = Output(
            tables.quarantine_files, f"{load_id}_bad_rows",
            bad.repartition("chunk").select(*SOURCE_COLUMNS, "rejection_reason", chunk_file.alias("chunk_file")),
            quarantined, "csv", partition_by=("chunk_file",))
        rows_out = publish(spark, load_id, [
            files,
            stage_output(split.filter("is_kept"), tables.stage, load_id, at, good, "source_row"),
            Output(tables.root, f"quarantine/load_id={load_id}", quarantine_rows(bad, load_id, at).drop("load_id"), quarantined),
        ])
        counts["staged_rows_loaded"] = rows_out[f"load_id={load_id}"]
        # Each chunk's valid rows against what the stage holds of it, read back.
        staged = read_load_table(spark, tables.stage, STAGE_SCHEMA, load_id).groupBy(
            ((F.col("stg_claim_row_id") / F.lit(chunk_size)).cast("long") + 1).alias("chunk")).agg(F.count(F.lit(1)).alias("staged"))
        checked = materialize(per_chunk.join(staged, "chunk", "left").fillna(0, ["staged"]), "chunk-check")
        append_rows(chunk_events(checked, load_id, at, attempt), tables.audit)
        wrong = checked.where("valid <> staged").orderBy("chunk").limit(1).collect()
        if wrong:
            audit.check_batch(wrong[0]["valid"], wrong[0]["staged"], f"chunk {wrong[0]['chunk']}")

        merged = merge_load(spark, tables, load_id, as_of, at, policy, hash_mode, enforce_codes, buckets=buckets)
        write_audit(spark, tables, audit.succeeded(
            load_id, PROCESS_NAME, at, merged["rejected_total"], merged["upserted_rows"], attempt))
        expected = counts["source_rows_read"] - counts["source_rows_quarantined"]
        status = "MATCH" if expected == counts["staged_rows_loaded"] else "MISMATCH"
        write_audit(spark, tables, audit.reconciled(load_id, PROCESS_NAME, at, status, attempt))
        return {
            "status": "SUCCESS", "load_id": load_id, **counts,
            "target_rows_rejected": merged["rejected_rows"],
            "target_rows_upserted": merged["upserted_rows"],
            "expected_staged": expected, "actual_staged": counts["staged_rows_loaded"],
            "reconciliation_status": status, "quarantine_files": [files.published],
        }
    except Exception as error:
        write_audit(spark, tables, audit.failed(load_id, PROCESS_NAME, at, error, attempt))
        return {"status": "FAILED", "load_id": load_id, "error": str(error), **counts, "quarantine_files": []}


def merge_by_hash(spark: SparkSession, tables: Tables, load_id, as_of, run_ts) -> int:
    """The plain merge: md5 change detection, no rejects table; rows upserted.

    Ranked by ingest time; the hash and the row id settle ties.
    """
    return merge_load(spark, tables, load_id, as_of, run_ts, keep_rejects=False)["upserted_rows"]


def result_frame(spark: SparkSession, result: dict) -> DataFrame:
    """A result record as one row."""
    flat = {k: (",".join(v) if isinstance(v, list) else v) for k, v in result.items()}
    return spark.createDataFrame([flat], ", ".join(
        f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in flat.items()))
