"""Structural checks, key parts, and scans of files written from the tables."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.catalog.views import CLAIMS_LINES, CLAIMS_SRC, claims_lines, claims_src, duck, table
from sluice.functions import paths
from sluice.functions.coerce import to_amount
from sluice.operators import analysis, structural
from sluice.session import fresh_folder
from sluice.sources.delimited import read_csv, read_headerless, read_typed_csv
from sluice.sources.lines import read_lines

LINES = duck(CLAIMS_LINES)
HEADER = ["provider_id", "claim_amount", "claim_id", "service_date", "patient_id",
          "procedure_code", "diagnosis_code"]
# Fields = commas outside quoted fields + 1.
_COUNT = r"""length(regexp_replace(raw_row, '(^|,)"(?:[^"]|"")*(?:"|\z)', '\1', 'g'))
  - length(replace(regexp_replace(raw_row, '(^|,)"(?:[^"]|"")*(?:"|\z)', '\1', 'g'), ',', '')) + 1"""
_REASON = f"""case when regexp_full_match(raw_row, '\\s*') then 'empty row'
  when (length(raw_row) - length(replace(raw_row, '"', ''))) % 2 = 1 then 'broken quoted row'
  when {_COUNT} < 7 then 'row has too few columns' when {_COUNT} > 7 then 'row has extra columns' end"""
_FIELDS = '^([^,]*),([^,]*),([^,]*),([^,]*),"([^"]*)",([^,]*),([^,]*)$'
_PARSED = ", ".join(f"regexp_extract(raw_row, '{_FIELDS}', {i + 1}) {c}" for i, c in enumerate(HEADER))


@query(f"with claims_lines as {LINES} select line_key, raw_row, {_REASON} reason from claims_lines")
def structural_reasons(spark, sf_dir):
    checked = structural.check_lines(claims_lines(spark, sf_dir), len(HEADER))
    return checked.select("line_key", "raw_row", "reason")


@query(f"with claims_lines as {LINES} select {_PARSED} from claims_lines where {_REASON} is null")
def structural_clean(spark, sf_dir):
    clean, _ = structural.structural_split(claims_lines(spark, sf_dir), HEADER)
    return clean


@query(f"""with claims_lines as {LINES} select {_REASON} reason, raw_row from claims_lines
where {_REASON} is not null""")
def structural_bad(spark, sf_dir):
    _, bad = structural.structural_split(claims_lines(spark, sf_dir), HEADER)
    return bad


_KEYS = """concat(case when event_type = 'click' then 'success_split_files/' when event_type = 'view'
    then 'unprocessed_transactions/' else 'other/' end, 'a', cast(user_id as STR), '-', cast(event_id as STR), '_',
    'Prog-', event_type, case when event_type = 'error' then '_plain' else '_split_file' end, '_20250112.csv')"""


@query(f"""with keyed as (select event_id, {_KEYS.replace('STR', 'varchar')} object_key from events),
parts as (select *, split_part(object_key, '/', 1) folder, split_part(object_key, '/', 2) object_name from keyed)
select event_id, folder, object_name, nullif(regexp_extract(object_name, '_(.+?)_split_file', 1), '') program_name,
  case when regexp_matches(object_name, '^([A-Za-z0-9-]+)_([A-Za-z0-9-]+)_split_file')
    then regexp_extract(object_name, '^([A-Za-z0-9-]+)_([A-Za-z0-9-]+)_split_file', 1) || '_' ||
      regexp_extract(object_name, '^([A-Za-z0-9-]+)_([A-Za-z0-9-]+)_split_file', 2) end id_and_program,
  nullif(regexp_extract(object_name, '^[a-zA-Z0-9-]+'), '') leading_id,
  case when contains(object_key, 'split_file') then '|' else ',' end delimiter from parts""")
def file_name_parts(spark, sf_dir):
    keyed = table(spark, sf_dir, "events").select(
        "event_id", F.expr(_KEYS.replace("STR", "string")).alias("object_key"))
    name = paths.object_name("object_key")
    return keyed.select(
        "event_id", paths.folder_name("object_key").alias("folder"), name.alias("object_name"),
        paths.program_name(name).alias("program_name"), paths.id_and_program(name).alias("id_and_program"),
        paths.leading_id(name).alias("leading_id"), paths.delimiter("object_key").alias("delimiter"))


@query(f"""with claims_src as {duck(CLAIMS_SRC)} select coalesce(claim_id, 'nan') || ',' || coalesce(patient_id, 'nan')
  || ',' || coalesce(procedure_code, 'nan') || ',' || coalesce(service_date, 'nan') row_as_string from claims_src""")
def row_string(spark, sf_dir):
    values = F.array("claim_id", "patient_id", "procedure_code", "service_date")
    return claims_src(spark, sf_dir).select(analysis.row_text(values).alias("row_as_string"))


# -- scans of files ---------------------------------------------------------
#
# The tables are written as files to the shared folder and read back.


@query(f"""with claims_lines as {LINES} select raw_row, {_REASON} reason,
  true numbered_once, false truncated from claims_lines""")
def line_scan(spark, sf_dir):
    """Raw lines survive the scan, each file's lines number 1 to n, none is cut off."""
    folder = fresh_folder(spark, "lines")
    claims_lines(spark, sf_dir).select("raw_row").write.option("lineSep", "\n").text(folder)
    lines = read_lines(spark, folder)
    # One row per file: as many lines as the highest number, and no number twice.
    files = lines.groupBy("file").agg(
        F.count("*").alias("n"), F.max("line_number").alias("high"), F.min("line_number").alias("low"),
        F.sum("line_number").alias("total"))
    good = (F.col("n") == F.col("high")) & (F.col("low") == 1) & (
        F.col("total") * 2 == F.col("n") * (F.col("n") + 1))
    checked = structural.check_lines(lines, len(HEADER))
    return checked.join(files.select("file", good.alias("numbered_once")), "file").select(
        "raw_row", "reason", "numbered_once", "truncated")


_FILE_COLUMNS = ["claim_id", "patient_id", "provider_id", "diagnosis_code", "procedure_code",
                 "claim_amount", "service_date"]


def write_claims_csv(spark, sf_dir, label, **replace):
    folder = fresh_folder(spark, label)
    df = claims_src(spark, sf_dir).withColumn("claim_amount", to_amount("amount").cast("string"))
    df.withColumns(replace).select(*_FILE_COLUMNS).write.option("header", True).csv(folder)
    return folder


@query(f"""with claims_src as {duck(CLAIMS_SRC)} select claim_id, patient_id, provider_id, diagnosis_code,
  procedure_code, cast(try_cast(amount as decimal(18,2)) as varchar) claim_amount, service_date from claims_src""")
def header_csv_scan(spark, sf_dir):
    return read_csv(spark, write_claims_csv(spark, sf_dir, "header-csv"))


@query(f"""with claims_src as {duck(CLAIMS_SRC)} select cast(claim_id as bigint) claim_id,
  try_cast(patient_id as bigint) patient_id, cast(provider_id as bigint) provider_id, diagnosis_code,
  cast(procedure_code as bigint) procedure_code, cast(try_cast(amount as decimal(18,2)) as varchar) claim_amount,
  service_date from claims_src""")
def typed_csv_scan(spark, sf_dir):
    folder = write_claims_csv(
        spark, sf_dir, "typed-csv", patient_id=F.when(F.col("patient_id") != "UNK", F.col("patient_id")))
    return read_typed_csv(spark, folder)


@query("""select concat_ws('~', cast(event_id as varchar), cast(user_id as varchar), event_type,
  cast(cast(ts as date) as varchar)) row_text, case when event_type = 'click' then 'split_file' else 'plain' end kind
from events""")
def headerless_scan(spark, sf_dir):
    """Two kinds of files, the delimiter told by the name."""
    root = fresh_folder(spark, "headerless")
    events = table(spark, sf_dir, "events")
    fields = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"),
              F.to_date("ts").cast("string")]
    is_split = F.col("event_type") == "click"
    events.filter(is_split).select(F.concat_ws("|", *fields)).write.text(f"{root}/split_file")
    events.filter(~is_split).select(F.concat_ws(",", *fields)).write.text(f"{root}/plain")
    rows = read_headerless(spark, [f"{root}/split_file", f"{root}/plain"])
    kind = F.when(F.col("file_path").contains("/split_file/"), "split_file").otherwise("plain")
    return rows.select(F.array_join("values", "~").alias("row_text"), kind.alias("kind"))
