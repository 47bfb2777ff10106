"""Claims files to the stage: the strict load and the raw-line load."""

import csv
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions.coerce import to_amount, to_day
from sluice.functions.text import strip
from sluice.model import (
    CLAIM_COLUMNS_LINES, CLAIM_COLUMNS_STRICT, CLAIMS_FILE_SCHEMA, FILE_PROCEDURE_CODES,
    STAGE_SCHEMA,
)
from sluice.operators.once import compute_once
from sluice.operators.dedupe import flag_duplicates_sized, surrogate_id
from sluice.operators.rules import (
    any_missing, broken_names, claim_rules, final_claim_types, rule_counts, type_claims,
)
from sluice.operators.schema import (
    check_names, normalize_columns, normalize_names, out_of_order, tag_load,
)
from sluice.operators.structural import REASONS, check_lines, split_fields
from sluice.session import materialize, materialize_counted
from sluice.sinks.publish import Output, publish
from sluice.sources.delimited import read_typed_csv
from sluice.sources.lines import first_line, read_lines


def new_load_id(now) -> str:
    """Time stamp and eight hex digits; pass the same id to repeat a load."""
    return now.strftime("%Y%m%d%H%M%S") + "_" + uuid.uuid4().hex[:8]


def stage_rows(clean: DataFrame, load_id, run_ts, row_id="stg_claim_row_id") -> DataFrame:
    """Rows of the stage table; the hash is left to the merge."""
    df = tag_load(clean.withColumnRenamed("claim_amount", "amount"), load_id)
    df = df.withColumns({
        "amount": to_amount("amount"), "service_date": to_day("service_date"),
        "ingested_at": F.lit(run_ts).cast("timestamp"),
        "record_hash": F.lit(None).cast("string"),
        "stg_claim_row_id": F.col(row_id),
    })
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGE_SCHEMA])


def stage_output(clean, stage_path, load_id, run_ts, expected, row_id="stg_claim_row_id") -> Output:
    rows = stage_rows(clean, load_id, run_ts, row_id).drop("load_id")
    return Output(stage_path, f"load_id={load_id}", rows, expected)


def must_fit(name, value):
    """The converted column; text that does not convert ends the job."""
    message = F.concat(F.lit(f"{name}: value does not fit: "), F.col(name))
    error = F.raise_error(message).cast("string")
    return F.when(F.col(name).isNotNull(), F.coalesce(value.cast("string"), error))


def load_claims_strict(spark: SparkSession, path, stage_path, archive_path, load_id, run_ts) -> dict:
    """Header CSV with fixed columns and order; rows with a gap are archived.

    A value of a wrong type or another column order ends the load before
    anything is visible, and so does an amount or a date the stage cannot hold.
    """
    df = normalize_columns(read_typed_csv(spark, path, CLAIMS_FILE_SCHEMA))
    check_names(df.columns, CLAIM_COLUMNS_STRICT, "ordered")
    typed = surrogate_id(df).withColumn("is_gap", any_missing(CLAIM_COLUMNS_STRICT))
    rows = materialize(typed, "strict-claims", ["is_gap"])
    counts = {r["is_gap"]: r["count"] for r in rows.groupBy("is_gap").count().collect()}
    good, gaps = counts.get(False, 0), counts.get(True, 0)
    valid, invalid = rows.filter(~F.col("is_gap")), rows.filter("is_gap")
    valid = valid.withColumns({
        "claim_amount": must_fit("claim_amount", to_amount("claim_amount")),
        "service_date": must_fit("service_date", to_day("service_date")),
    })
    publish(spark, load_id, [
        Output(archive_path, f"invalid_records_{load_id}",
               invalid.select(*CLAIM_COLUMNS_STRICT), gaps, "csv"),
        stage_output(valid, stage_path, load_id, run_ts, good),
    ])
    return {"load_id": load_id, "rows_read": good + gaps, "rows_loaded": good, "rows_invalid": gaps}


def read_header(spark: SparkSession, paths, expected=CLAIM_COLUMNS_LINES):
    """Normalised header of the first file; raises on drift."""
    return header_names(first_line(spark, paths), expected)


def header_names(line, expected=CLAIM_COLUMNS_LINES):
    """Normalised names of a header line; raises on drift."""
    names = normalize_names(next(csv.reader([line]), []))
    check_names(names, expected, "set")
    return names


def by_file(header, value):
    """``value(names)`` of the header of a row's file.

    ``header``: the names all files share, or {names: files} where their
    orders differ.
    """
    if not isinstance(header, dict):
        return value(header)
    (names, _), *others = header.items()
    chosen = value(names)
    for names, files in others:
        chosen = F.when(F.col("file").isin(files), value(names)).otherwise(chosen)
    return chosen


def data_lines(lines: DataFrame, header) -> DataFrame:
    """Lines after each file's header; a file with another header ends the load."""
    found = F.transform(split_fields("raw_row"), lambda f: F.lower(strip(f)))
    same = found == by_file(header, lambda names: F.array(*[F.lit(h) for h in names]))
    other = F.raise_error(F.concat(F.lit("schema drift in "), F.col("file"))).cast("boolean")
    is_data = F.when(F.col("line_number") > 1, F.lit(True)).when(same, F.lit(False)).otherwise(other)
    return lines.filter(is_data)


def typed_lines(lines: DataFrame, header, integers="numeric", keep_truncated=True) -> DataFrame:
    """One narrow pass: structure, columns, types.

    ``structural`` holds the reasons of a bad line, ``is_row`` tells whether
    the line gives a row; the text is kept only where it is reported.
    """
    checked = check_lines(lines, len(CLAIM_COLUMNS_LINES))
    cut = F.when(F.col("truncated"), F.lit(REASONS[5]))
    checked = checked.withColumn("structural", F.array_compact(F.array("reason", cut)))
    is_row = F.col("reason").isNull()
    if not keep_truncated:
        is_row = is_row & ~F.col("truncated")
    columns = [
        F.when(is_row, F.get("fields", by_file(header, lambda names, c=c: F.lit(names.index(c))))).alias(c)
        for c in CLAIM_COLUMNS_LINES]
    rows = checked.select(
        "file", "line_number", "row_no", "structural", is_row.alias("is_row"),
        F.when(F.size("structural") > 0, F.col("raw_row")).alias("raw_row"), *columns)
    return type_claims(rows, integers)


def checked_claims(rows: DataFrame, as_of, integers="numeric", codes=FILE_PROCEDURE_CODES) -> DataFrame:
    """Typed rows of a written table with ``reasons`` and ``is_clean``; duplicates count per load."""
    flagged = flag_duplicates_sized(rows, ["claim_id"])
    rules = claim_rules(as_of, integers, codes)
    reasoned = compute_once(flagged, reasons=broken_names(rules)).drop("is_duplicate")
    return reasoned.withColumn("is_clean", F.size("reasons") == 0)


def load_claims_lines(spark: SparkSession, paths, stage_path, archive_path, load_id, as_of, run_ts,
                      integers="numeric", codes=FILE_PROCEDURE_CODES, keep_truncated=True,
                      count_rules=False, header=None) -> dict:
    """Raw claim lines to stage, business archive and structural archive.

    The text is read twice (once to number lines), typed rows are written once
    to the shared folder, and everything after reads columns of that table.
    ``integers="strict"`` wants digits only in the four integer columns.
    ``header`` tells the names of the files where they are known (``by_file``);
    else the first file's are those of all.
    """
    header = header or read_header(spark, paths)
    lines = data_lines(read_lines(spark, paths), header)
    table = materialize(typed_lines(lines, header, integers, keep_truncated), "claim-lines", ["is_row"])
    rows = table.filter("is_row")
    bad_lines = table.filter(F.size("structural") > 0).select(
        "row_no", "line_number", F.explode("structural").alias("reason"), "raw_row")
    # Flagged and judged once; the outputs read what was found, without the text.
    checked, tally = materialize_counted(
        checked_claims(rows.select("row_no", *CLAIM_COLUMNS_LINES), as_of, integers, codes), "checked-claims", ["is_clean"],
        clean=F.count_if("is_clean"), bad=F.count_if(~F.col("is_clean")))

    counts = table.agg(
        F.count("*").alias("rows_read"), F.count_if("is_row").alias("structurally_clean"),
        F.sum(F.size("structural")).alias("structurally_bad"),
    ).first()

    clean = final_claim_types(checked.filter("is_clean"))
    bad = tag_load(checked.filter(~F.col("is_clean")), load_id)
    publish(spark, load_id, [
        Output(archive_path, f"invalid_records_{load_id}",
               bad.select(*CLAIM_COLUMNS_LINES, "load_id", "row_no"), tally["bad"], "csv", ("row_no",), ("row_no",)),
        Output(archive_path, f"structural_bad_records_{load_id}", bad_lines,
               counts["structurally_bad"] or 0, "csv", ("row_no", "reason"), ("row_no",)),
        stage_output(clean, stage_path, load_id, run_ts, tally["clean"], "row_no"),
    ])
    result = {
        "load_id": load_id, "rows_read": counts["rows_read"],
        "structurally_clean": counts["structurally_clean"],
        "structurally_bad": counts["structurally_bad"] or 0,
        "business_bad": tally["bad"], "rows_loaded": tally["clean"],
        "reordered": any(out_of_order(h, CLAIM_COLUMNS_LINES) for h in (header if isinstance(header, dict) else [header])),
    }
    if count_rules:
        # One row per rule.
        result["rules"] = {r["reason"]: r["row_count"] for r in rule_counts(checked).collect()}
    return result
