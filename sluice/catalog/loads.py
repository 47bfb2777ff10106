"""Whole loads, run over files and tables written from the driver tables."""

from pyspark.sql import functions as F

from sluice.catalog.claims import (
    FILE_CLAIMS, FULL_ORDER, TYPED, VALID, _NUMERIC, _REASON, _REFUSED, _SOURCE_REASON, _STRICT,
    file_claims, typed_claims,
)
from sluice.catalog.lines import write_claims_csv
from sluice.catalog.registry import query
from sluice.catalog.views import AS_OF, CLAIMS_SRC, EARLY, claims_src, duck, table
from sluice.model import AUDIT_EVENT_SCHEMA, CLAIM_COLUMNS_LINES, REJECTS_SCHEMA, STAGE_SCHEMA, TARGET_SCHEMA
from sluice.operators.audit import rejects_per_load
from sluice.operators.dedupe import surrogate_id
from sluice.plans.claims import load_claims_lines, load_claims_strict
from sluice.plans.migration import Tables, audit_state, merge_load, process_claims
from sluice.session import CODEC, fresh_folder
from sluice.sinks.publish import read_version
from sluice.sinks.tables import hadoop_path, read_load_table, write_load
from sluice.sources.tables import read_table
from sluice.streaming.claims import run_claims_intake
from sluice.streaming.split_files import commits_folder, read_committed, run_intake

RUN_TS = "2001-01-01 00:00:00"
STAGE_SHOWN = ["claim_id", "patient_id", "provider_id", "diagnosis_code", "procedure_code",
               "amount", "service_date"]


def stage_of(spark, path, load_id):
    return read_load_table(spark, path, STAGE_SCHEMA, load_id).select(*STAGE_SHOWN)


# -- strict file load -------------------------------------------------------

_STRICT_FILE = f"""file_rows as (select claim_id, case when patient_id <> 'UNK' then patient_id end patient_id,
  provider_id, diagnosis_code, procedure_code, try_cast(amount as decimal(18,2)) amount,
  case when service_date <> 'bad-date' then service_date end service_date from {duck(CLAIMS_SRC)} c)"""
_COMPLETE = """claim_id is not null and patient_id is not null and provider_id is not null
  and diagnosis_code is not null and procedure_code is not null and amount is not null and service_date is not null"""


def _strict_load(spark, sf_dir):
    root = fresh_folder(spark, "strict-load")
    files = write_claims_csv(
        spark, sf_dir, "strict-claims",
        patient_id=F.when(F.col("patient_id") != "UNK", F.col("patient_id")),
        service_date=F.when(F.col("service_date") != "bad-date", F.col("service_date")))
    load_claims_strict(spark, files, f"{root}/stage", f"{root}/archive", "load-1", RUN_TS)
    return root


@query(f"""with {_STRICT_FILE} select claim_id, patient_id, provider_id, diagnosis_code,
  cast(cast(procedure_code as bigint) as varchar) procedure_code, amount,
  cast(service_date as date) service_date from file_rows where {_COMPLETE}""")
def claims_strict_load(spark, sf_dir):
    return stage_of(spark, f"{_strict_load(spark, sf_dir)}/stage", "load-1")


@query(f"""with {_STRICT_FILE} select claim_id, patient_id, provider_id, diagnosis_code,
  cast(cast(procedure_code as bigint) as varchar) procedure_code, cast(amount as varchar) claim_amount, service_date from file_rows where not ({_COMPLETE})""")
def claims_strict_archive(spark, sf_dir):
    root = _strict_load(spark, sf_dir)
    return spark.read.option("header", True).csv(f"{root}/archive/invalid_records_load-1")


# -- raw-line loads ---------------------------------------------------------

# Rows with a malformed date get a structural fault that depends on the diagnosis.
_FAULT = """case when service_date = 'bad-date' then case diagnosis_code when 'D1' then 'extra' when 'D2' then 'few'
  when 'D3' then 'quote' when 'D4' then 'blank' end end"""
_FILE_LINES = f"""{FILE_CLAIMS}, faulty as (select *, {_FAULT} fault,
  concat_ws(',', coalesce(provider_id, ''), coalesce(claim_amount, ''), coalesce(claim_id, ''),
    coalesce(service_date, ''), coalesce(patient_id, ''), coalesce(procedure_code, ''),
    coalesce(diagnosis_code, '')) line from file_claims)"""
_LINE_SQL = """case fault when 'extra' then line || ',EXTRA_FIELD' when 'few' then coalesce(provider_id, '') || ',' || claim_id
  when 'quote' then '"' || line when 'blank' then ' ' else line end"""


def write_claim_lines(spark, sf_dir):
    """Text files with a header line each, as a partner would deliver them."""
    folder = fresh_folder(spark, "claim-lines")
    claims = file_claims(spark, sf_dir)
    fault = F.expr(_FAULT)
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in CLAIM_COLUMNS_LINES])
    text = (
        F.when(fault == "extra", F.concat(line, F.lit(",EXTRA_FIELD")))
        .when(fault == "few", F.concat_ws(",", F.coalesce("provider_id", F.lit("")), "claim_id"))
        .when(fault == "quote", F.concat(F.lit('"'), line)).when(fault == "blank", " ").otherwise(line))
    header = ",".join(CLAIM_COLUMNS_LINES)
    # The header is the only column's name; separator and quote never occur.
    (
        claims.select(text.alias(header)).write.option("header", True).option("sep", "\x01")
        .option("quote", "\x02").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(folder)
    )
    return folder


def _coerced(rule):
    # In raw lines a missing diagnosis is an empty text, which is a value.
    inner = rule.replace("from file_claims", "from (select * replace (coalesce(diagnosis_code, '') as diagnosis_code) "
                         "from faulty where fault is null)")
    return f"""{inner}, flagged as (select *, count(*) over (partition by claim_id) > 1 is_duplicate from coerced),
judged as (select *, coalesce(not is_duplicate and provider_id % 1 = 0 and patient_id % 1 = 0 and claim_id % 1 = 0
  and claim_amount >= 0 and service_date <= date '{AS_OF}'
  and procedure_code in (99213,80050,93000,71020,99214,36415), false) is_clean from flagged)"""


_STAGED = """ select cast(cast(claim_id as bigint) as varchar) claim_id,
  cast(cast(patient_id as bigint) as varchar) patient_id, cast(cast(provider_id as bigint) as varchar) provider_id,
  diagnosis_code, cast(cast(procedure_code as bigint) as varchar) procedure_code, claim_amount amount, service_date
from judged where is_clean"""


def _line_load(spark, sf_dir, integers):
    root = fresh_folder(spark, "line-load")
    load_claims_lines(
        spark, write_claim_lines(spark, sf_dir), f"{root}/stage", f"{root}/archive", "load-1",
        AS_OF, RUN_TS, integers)
    return root


@query(f"with {_FILE_LINES}, {_coerced(_NUMERIC)}{_STAGED}")
def claims_lines_load_v2(spark, sf_dir):
    return stage_of(spark, f"{_line_load(spark, sf_dir, 'numeric')}/stage", "load-1")


@query(f"with {_FILE_LINES}, {_coerced(_STRICT)}{_STAGED}")
def claims_lines_load_v3(spark, sf_dir):
    return stage_of(spark, f"{_line_load(spark, sf_dir, 'strict')}/stage", "load-1")


@query(f"""with {_FILE_LINES} select case fault when 'extra' then 'row has extra columns'
  when 'few' then 'row has too few columns' when 'quote' then 'broken quoted row' else 'empty row' end reason,
  {_LINE_SQL} raw_row from faulty where fault is not null""")
def claims_lines_structural_archive(spark, sf_dir):
    root = _line_load(spark, sf_dir, "numeric")
    schema = "line_number string, reason string, raw_row string"
    rows = (
        spark.read.schema(schema).option("header", True).option("escape", '"').option("lineSep", "\n")
        .option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False)
        .csv(f"{root}/archive/structural_bad_records_load-1"))
    return rows.select("reason", "raw_row")


@query(f"""with {_FILE_LINES}, {_coerced(_NUMERIC)} select cast(cast(claim_id as bigint) as varchar) claim_id,
  service_date, 'load-1' load_id from judged where not is_clean""")
def claims_lines_business_archive(spark, sf_dir):
    root = _line_load(spark, sf_dir, "numeric")
    rows = spark.read.option("header", True).option("escape", '"').csv(f"{root}/archive/invalid_records_load-1")
    return rows.select(
        F.col("claim_id").cast("decimal(38,10)").cast("bigint").cast("string").alias("claim_id"),
        F.col("service_date").cast("date").alias("service_date"), "load_id")


@query(f"with {_FILE_LINES}, {_coerced(_NUMERIC)}{_STAGED}")
def claims_stream_intake(spark, sf_dir):
    """The same files as a stream of arrivals, all in one batch."""
    root = fresh_folder(spark, "claims-stream")
    folder = write_claim_lines(spark, sf_dir)
    tables = Tables(root)
    run_claims_intake(spark, folder, tables, f"{root}/checkpoint", "stream", AS_OF, RUN_TS, max_files=100_000)
    return read_load_table(spark, tables.stage, STAGE_SCHEMA).select(*STAGE_SHOWN)


# -- migration and merge ----------------------------------------------------

_SOURCE_ORDER = """claim_id nulls last, patient_id nulls last, provider_id nulls last, diagnosis_code nulls last,
  procedure_code nulls last, amount nulls last, service_date nulls last"""


def _source_winners(name, where):
    return f"""{name} as (select * from (select *, row_number() over (partition by claim_id order by {_SOURCE_ORDER}) rn
  from hashed where {_SOURCE_REASON} is null and {where}) where rn = 1)"""


def _migrate(spark, sf_dir, loads=(("load-1", EARLY, "2000-01-01 00:00:00"), ("load-2", None, RUN_TS)), chunk_size=None):
    """An earlier extract, then all rows; returns the tables."""
    tables = Tables(fresh_folder(spark, "migration"))
    claims = claims_src(spark, sf_dir)
    for load_id, before, run_ts in loads:
        rows = claims.filter(F.col("ingested_at") < before) if before else claims
        path = f"{tables.root}/source-{load_id}"
        rows.drop("ingested_at").write.option("compression", CODEC).parquet(path)
        result = process_claims(spark, read_table(spark, path), tables, load_id, AS_OF, run_ts, chunk_size=chunk_size)
        if result["status"] != "SUCCESS":
            raise RuntimeError(result["error"])
    return tables


@query(f"""with {TYPED}, {_source_winners('one', f"ingested_at < timestamp '{EARLY}'")},
{_source_winners('two', 'true')}
select cast(two.claim_id as varchar) claim_id, cast(two.patient_id as varchar) patient_id, two.diagnosis_code,
  two.procedure_code, two.amount, two.service_date, two.record_hash,
  case when one.record_hash = two.record_hash then date '2000-01-01' else date '{AS_OF}' end loaded_on
from two left join one on one.claim_id = two.claim_id""")
def migration_load(spark, sf_dir):
    tables = _migrate(spark, sf_dir)
    return read_version(spark, tables.target, TARGET_SCHEMA).select(
        "claim_id", "patient_id", "diagnosis_code", "procedure_code", "amount", "service_date",
        "record_hash", F.to_date("ingested_at").alias("loaded_on"))


@query(f"""with {TYPED}, judged as (select *, {_SOURCE_REASON} reason, row_number() over (
    partition by claim_id, {_SOURCE_REASON} is null order by {_SOURCE_ORDER}) rn from hashed)
select 'load-1' load_id, count(*) source_rows_read,
  count(*) filter (where reason is not null or rn > 1) source_rows_quarantined,
  count(*) filter (where reason is null and rn = 1) staged_rows_loaded, cast(0 as bigint) target_rows_rejected,
  count(*) filter (where reason is null and rn = 1) target_rows_upserted,
  'MATCH' reconciliation_status, 'SUCCESS' status from judged""")
def migration_audit(spark, sf_dir):
    tables = _migrate(spark, sf_dir, (("load-1", None, RUN_TS),))
    return audit_state(spark, tables).select(
        "load_id", "source_rows_read", "source_rows_quarantined", "staged_rows_loaded",
        "target_rows_rejected", "target_rows_upserted", "reconciliation_status", "status")


@query(f"""with {TYPED}, judged as (select *, {_SOURCE_REASON} reason, row_number() over (
    partition by claim_id, {_SOURCE_REASON} is null order by {_SOURCE_ORDER}) rn from hashed)
select cast(claim_id as varchar) claim_id, amount, service_date,
  coalesce(reason, 'duplicate claim_id in source chunk') rejection_reason
from judged where reason is not null or rn > 1""")
def migration_quarantine(spark, sf_dir):
    tables = _migrate(spark, sf_dir, (("load-1", None, RUN_TS),))
    return spark.read.parquet(tables.quarantine).select(
        "claim_id", "amount", "service_date", "rejection_reason")


#: Rows of an extract chunk in the chunked queries: three chunks or more at the smallest scale.
MIGRATION_CHUNK = 2000
_CHUNKED = f"""{TYPED}, ordered as (select *, {_SOURCE_REASON} reason,
    (row_number() over (order by {_SOURCE_ORDER}) - 1) // {MIGRATION_CHUNK} + 1 chunk from hashed),
judged as (select *, row_number() over (partition by chunk, claim_id, reason is null order by {_SOURCE_ORDER}) rn from ordered)"""


@query(f"""with {_CHUNKED}
select chunk, count(*) source_rows_read, count(*) filter (where reason is not null or rn > 1) source_rows_quarantined,
  count(*) filter (where reason is null and rn = 1) staged_rows_loaded
from judged group by chunk""")
def migration_chunks(spark, sf_dir):
    """The progress event of every chunk of a chunked load: its own counts."""
    tables = _migrate(spark, sf_dir, (("load-1", None, RUN_TS),), chunk_size=MIGRATION_CHUNK)
    events = spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit).where(F.col("event_key").startswith("batch-"))
    return events.select(
        F.substring("event_key", 7, 20).cast("long").alias("chunk"), "source_rows_read", "source_rows_quarantined", "staged_rows_loaded")


@query(f"""with {_CHUNKED}
select 'load-1_chunk_' || lpad(cast(chunk as varchar), 5, '0') || '_bad_rows' chunk_file, count(*) bad_rows,
  count(*) filter (where reason is null) duplicates
from judged where reason is not null or rn > 1 group by chunk""")
def migration_chunk_files(spark, sf_dir):
    """The quarantine file of every chunk of a chunked load, read back: its rows and duplicates."""
    tables = _migrate(spark, sf_dir, (("load-1", None, RUN_TS),), chunk_size=MIGRATION_CHUNK)
    files = spark.read.option("header", True).option("escape", '"').csv(f"{tables.quarantine_files}/load-1_bad_rows")
    return files.groupBy("chunk_file").agg(
        F.count(F.lit(1)).alias("bad_rows"), F.count_if(F.col("rejection_reason").startswith("duplicate")).alias("duplicates"))


def _merge_staged(spark, sf_dir, **options):
    """Stage all rows, good or not, and merge them twice."""
    tables = Tables(fresh_folder(spark, "merge"))
    stage = surrogate_id(typed_claims(spark, sf_dir)).withColumn("load_id", F.lit("load-1"))
    stage = stage.withColumn("record_hash", F.lit(None).cast("string"))
    write_load(stage.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGE_SCHEMA]), tables.stage)
    for _ in range(2):
        merge_load(spark, tables, "load-1", AS_OF, RUN_TS, **options)
    return tables


@query(f"""with {TYPED}, ranked as (select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
  from hashed where {VALID})
select cast(claim_id as varchar) claim_id, cast(patient_id as varchar) patient_id, amount, service_date, record_hash
from ranked where rn = 1""")
def hash_merge_load(spark, sf_dir):
    tables = _merge_staged(spark, sf_dir, keep_rejects=False)
    return read_version(spark, tables.target, TARGET_SCHEMA).select(
        "claim_id", "patient_id", "amount", "service_date", "record_hash")


@query(f"""with {TYPED}, ranked as (select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
  from hashed where {VALID})
select cast(claim_id as varchar) claim_id, amount, service_date, record_hash,
  'duplicate claim_id in stage load' rejection_reason from ranked where rn > 1
union all select cast(claim_id as varchar), amount, service_date, record_hash, {_REASON} from hashed where {_REFUSED}""")
def merge_load_rejects(spark, sf_dir):
    tables = _merge_staged(spark, sf_dir)
    return read_load_table(spark, tables.rejects, REJECTS_SCHEMA).select(
        "claim_id", "amount", "service_date", "record_hash", "rejection_reason")


@query(f"""with {TYPED}, ranked as (select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
  from hashed where {VALID})
select 'load-1' load_id, (select count(*) from ranked where rn > 1)
  + (select count(*) from hashed where {_REFUSED}) target_rows_rejected""")
def merge_load_reject_count(spark, sf_dir):
    tables = _merge_staged(spark, sf_dir)
    return rejects_per_load(read_load_table(spark, tables.rejects, REJECTS_SCHEMA))


# -- arriving split files ---------------------------------------------------

_PROGRAMS = {"click": ("success_split_files", "a1b2-01", "Prog-Click", "|"),
             "view": ("unprocessed_transactions", "c3d4-02", "Prog-View", "|"),
             "purchase": ("success_split_files", "e5f6-03", "Prog-Buy", "|"),
             "signup": ("unprocessed_transactions", "g7h8-04", "Prog-Sign", "|"),
             # A folder that the intake does not watch.
             "error": ("foreign_files", "i9j0-05", "Prog-Err", "|")}


def _arrive(spark, sf_dir, root):
    """Event rows as arriving split files, one name per event type."""
    written = fresh_folder(spark, "arrivals")
    events = table(spark, sf_dir, "events")
    row = F.concat_ws("|", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                      "event_type", F.to_date("ts").cast("string"))
    events.select(row.alias("value"), "event_type").write.partitionBy("event_type").text(written)
    for kind, (folder, file_id, program, _) in _PROGRAMS.items():
        fs, source = hadoop_path(spark, f"{written}/event_type={kind}")
        if not fs.exists(source):
            continue
        _, target = hadoop_path(spark, f"{root}/{folder}")
        fs.mkdirs(target)
        # A handful of part files per type, renamed as the partner names them.
        for i, part in enumerate(fs.listStatus(source)):
            _, name = hadoop_path(spark, f"{root}/{folder}/{file_id}_{program}_split_file_{i}.csv")
            fs.rename(part.getPath(), name)


_CASES = " ".join(
    f"when '{k}' then '{p}'" for k, (_, _, p, _) in _PROGRAMS.items())
_IDS = " ".join(f"when '{k}' then '{i}'" for k, (_, i, _, _) in _PROGRAMS.items())
_FOLDERS = " ".join(f"when '{k}' then '{f}'" for k, (f, _, _, _) in _PROGRAMS.items())


@query(f"""with rows_in as (select case event_type {_CASES} end program_name,
  concat_ws(',', cast(event_id as varchar), cast(user_id as varchar), event_type, cast(cast(ts as date) as varchar))
    row_as_string, case event_type {_IDS} end file_uuid, case event_type {_FOLDERS} end folder
  from events)
select t.target, r.* from rows_in r, (values ('one'), ('two')) t(target)
where folder in ('success_split_files', 'unprocessed_transactions')""")
def split_file_intake(spark, sf_dir):
    """Arriving files to two targets; the second call finds nothing new."""
    root = fresh_folder(spark, "intake")
    _arrive(spark, sf_dir, f"{root}/in")
    targets = [f"{root}/one", f"{root}/two"]
    for _ in range(2):
        run_intake(spark, f"{root}/in", targets, f"{root}/failed", f"{root}/checkpoint")
    shown = ["program_name", "row_as_string", "file_uuid", "folder"]
    commits = commits_folder(targets)
    one, two = [read_committed(spark, t, commits).select(F.lit(t.rsplit("/", 1)[1]).alias("target"), *shown) for t in targets]
    return one.unionByName(two)
