"""Coercion, rules, duplicates, merge, quarantine and audit over dirty claims."""

from functools import reduce

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.catalog.views import AS_OF, CLAIMS_SRC, EARLY, claims_src, duck, table
from sluice.functions import coerce as K
from sluice.functions.hashing import record_hash
from sluice.model import (
    AUDIT_COUNTERS, AUDIT_EVENT_SCHEMA, CLAIM_COLUMNS_LINES, FILE_PROCEDURE_CODES,
    SOURCE_COLUMNS, STAGE_COLUMNS, TARGET_SCHEMA,
)
from sluice.operators import audit, dedupe, merge, quarantine, rules, schema
from sluice.session import materialize

SRC = duck(CLAIMS_SRC)
TYPED = f"""
claims_src as {SRC},
typed as (
  select try_cast(claim_id as bigint) claim_id, try_cast(patient_id as bigint) patient_id,
    try_cast(provider_id as bigint) provider_id, diagnosis_code, procedure_code,
    try_cast(amount as decimal(18,2)) amount, try_cast(service_date as date) service_date,
    ingested_at
  from claims_src),
hashed as (
  select *, md5(concat_ws('|', cast(claim_id as varchar), cast(patient_id as varchar),
    cast(provider_id as varchar), diagnosis_code, procedure_code, cast(amount as varchar),
    cast(service_date as varchar))) record_hash
  from typed)"""
VALID = f"""claim_id is not null and patient_id is not null and provider_id is not null
  and procedure_code is not null and amount is not null and amount >= 0
  and service_date is not null and service_date <= date '{AS_OF}'"""
SHOWN = ["claim_id", "patient_id", "provider_id", "diagnosis_code", "procedure_code",
         "amount", "service_date", "record_hash"]
SHOWN_SQL = ", ".join(SHOWN)
ON_DAY = "cast(ingested_at as date) ingested_on"
# A full order: rows that agree on all of it are equal in every column shown.
FULL_ORDER = """ingested_at desc nulls first, record_hash desc nulls first"""


def typed_claims(spark, sf_dir, row_id=False):
    return rules.type_source(claims_src(spark, sf_dir, row_id))


def hashed_claims(spark, sf_dir, row_id=False):
    return merge.add_hash(typed_claims(spark, sf_dir, row_id))


def shown(df, *more):
    return df.select(*SHOWN, F.to_date("ingested_at").alias("ingested_on"), *more)


def day(c="ingested_at"):
    return F.to_date(c)


# -- merge ------------------------------------------------------------------

@query(f"""with {TYPED}, ranked as (
  select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
  from hashed where {VALID})
select {SHOWN_SQL}, {ON_DAY} from ranked where rn = 1""")
def merge_winners(spark, sf_dir):
    return shown(merge.winners(hashed_claims(spark, sf_dir), AS_OF))


@query(f"""with {TYPED}, ranked as (
  select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
  from hashed where {VALID})
select {SHOWN_SQL}, {ON_DAY}, 'duplicate claim_id in stage load' rejection_reason
from ranked where rn > 1""")
def merge_losers(spark, sf_dir):
    lost = merge.losers(hashed_claims(spark, sf_dir, row_id=True), AS_OF)
    return shown(lost, "rejection_reason")


# The target after an earlier load, some of it without hashes; then all rows.
_TWO_LOADS = f"""with {TYPED}, early as (
  select * from (select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
    from hashed where {VALID} and ingested_at < timestamp '{EARLY}') where rn = 1),
t as (select claim_id, patient_id, provider_id, diagnosis_code, procedure_code, amount, service_date,
    ingested_at, case when procedure_code = '00000' then null else record_hash end record_hash from early),
s as (select * from (select *, row_number() over (partition by claim_id order by {FULL_ORDER}) rn
    from hashed where {VALID}) where rn = 1),
j as (select t.claim_id tk, s.claim_id sk, t.record_hash th, s.record_hash sh, t.amount ta, s.amount sa,
    t.service_date td, s.service_date sd, coalesce(s.claim_id, t.claim_id) claim_id
  from t full join s on t.claim_id = s.claim_id),
acted as (select *, case when sk is null then 'kept' when tk is null then 'insert'
    when CHANGED then 'update' else 'unchanged' end as "action" from j)"""
_MERGED = """ select claim_id, case when "action" in ('insert','update') then sh else th end record_hash,
 case when "action" in ('insert','update') then sa else ta end amount,
 case when "action" in ('insert','update') then sd else td end service_date, "action" from acted"""


def _two_loads(spark, sf_dir):
    claims = hashed_claims(spark, sf_dir)
    columns = TARGET_SCHEMA.names
    early = merge.winners(claims.filter(F.col("ingested_at") < EARLY), AS_OF)
    no_hash = F.when(F.col("procedure_code") != "00000", F.col("record_hash"))
    return early.withColumn("record_hash", no_hash).select(*columns), merge.winners(claims, AS_OF)


def _merged(spark, sf_dir, policy):
    target, source = _two_loads(spark, sf_dir)
    return merge.upsert(target, source, "claim_id", policy)


@query(_TWO_LOADS.replace("CHANGED", "th is distinct from sh") + _MERGED)
def merge_upsert_null_safe(spark, sf_dir):
    return _merged(spark, sf_dir, "null_safe").select(
        "claim_id", "record_hash", "amount", "service_date", "action")


@query(_TWO_LOADS.replace("CHANGED", "th <> sh") + _MERGED)
def merge_upsert_strict(spark, sf_dir):
    return _merged(spark, sf_dir, "strict").select(
        "claim_id", "record_hash", "amount", "service_date", "action")


@query(_TWO_LOADS.replace("CHANGED", "th is distinct from sh")
       + ' select "action", count(*) row_count from acted group by 1')
def merge_action_counts(spark, sf_dir):
    return merge.action_counts(_merged(spark, sf_dir, "null_safe"))


_REASON = f"""case when claim_id is null then 'missing claim_id'
  when patient_id is null then 'missing patient_id' when provider_id is null then 'missing provider_id'
  when procedure_code is null then 'missing procedure_code'
  when procedure_code not in ('J5502','99202','99203','99201') then 'invalid procedure_code'
  when amount is null then 'missing amount' when amount < 0 then 'negative amount'
  when service_date is null then 'missing service_date'
  when service_date > date '{AS_OF}' then 'future service_date'
  else 'unknown validation failure' end"""
_REFUSED = f"not coalesce({VALID}, false)"


@query(f"""with {TYPED} select {SHOWN_SQL}, {ON_DAY}, {_REASON} rejection_reason
from hashed where {_REFUSED}""")
def reject_reasons(spark, sf_dir):
    return shown(merge.invalid_rejects(hashed_claims(spark, sf_dir), AS_OF), "rejection_reason")


@query(f"""with {TYPED}, rejected as (
  select case when diagnosis_code is not null then claim_id end reject_key, {_REASON} rejection_reason,
    ingested_at from hashed where {_REFUSED}),
known as (select distinct reject_key, rejection_reason from rejected where ingested_at < timestamp '{EARLY}')
select distinct reject_key, rejection_reason from rejected r where reject_key is not null
  and not exists (select 1 from known k where k.reject_key = r.reject_key and k.rejection_reason = r.rejection_reason)
union all select reject_key, rejection_reason from rejected where reject_key is null""")
def rejects_insert_ignore(spark, sf_dir):
    rejected = merge.invalid_rejects(hashed_claims(spark, sf_dir), AS_OF).select(
        F.when(F.col("diagnosis_code").isNotNull(), F.col("claim_id")).alias("reject_key"),
        "rejection_reason", "ingested_at")
    # Used three times: typed and judged once.
    rejected = materialize(rejected, "rejected")
    known = rejected.filter(F.col("ingested_at") < EARLY)
    fresh = merge.insert_ignore(known, rejected, ["reject_key", "rejection_reason"])
    return fresh.select("reject_key", "rejection_reason")


@query(f"""with {TYPED} select claim_id, md5(concat_ws('|', coalesce(cast(claim_id as varchar), '~'),
  coalesce(cast(patient_id as varchar), '~'), coalesce(cast(provider_id as varchar), '~'),
  coalesce(diagnosis_code, '~'), coalesce(procedure_code, '~'), coalesce(cast(amount as varchar), '~'),
  coalesce(cast(service_date as varchar), '~'))) marked_hash, record_hash from hashed""")
def record_hashes(spark, sf_dir):
    return typed_claims(spark, sf_dir).select(
        "claim_id", record_hash(null_marker="~").alias("marked_hash"), record_hash().alias("record_hash"))


# -- rules ------------------------------------------------------------------

_SOURCE_REASON = f"""nullif(concat_ws('; ',
  case when claim_id is null then 'missing claim_id' end,
  case when patient_id is null then 'missing patient_id' end,
  case when provider_id is null then 'missing provider_id' end,
  case when procedure_code is null or trim(procedure_code) = '' then 'missing procedure_code' end,
  case when amount is null then 'missing amount' when amount < 0 then 'negative amount' end,
  case when service_date is null then 'missing/invalid service_date'
    when service_date > date '{AS_OF}' then 'future service_date' end), '')"""


def _with_source_reason(df):
    checks = rules.source_rules(AS_OF)
    return df.withColumns({"reasons": rules.broken_names(checks), "rejection_reason": rules.reasons_text(checks)})


@query(f"with {TYPED} select {SHOWN_SQL}, {ON_DAY}, {_SOURCE_REASON} rejection_reason from hashed")
def row_reasons(spark, sf_dir):
    return shown(_with_source_reason(hashed_claims(spark, sf_dir)), "rejection_reason")


@query(f"""with {TYPED}, judged as (select {_SOURCE_REASON} rejection_reason from hashed)
select reason, count(*) row_count from (
  select unnest(string_split(rejection_reason, '; ')) reason from judged where rejection_reason is not null)
group by reason""")
def rule_counts(spark, sf_dir):
    return rules.rule_counts(_with_source_reason(typed_claims(spark, sf_dir)))


@query(f"""with {TYPED}, judged as (select {_SOURCE_REASON} rejection_reason from hashed)
select count(*) rows_read, count(*) filter (where rejection_reason is null) rows_clean,
  count(*) filter (where rejection_reason is not null) rows_bad from judged""")
def load_counts(spark, sf_dir):
    return audit.stage_counts(_with_source_reason(typed_claims(spark, sf_dir)))


# The file form of the claims: text columns, some identifiers written as "12.0".
FILE_CLAIMS = f"""file_claims as (
  select case when procedure_code = '99213' then provider_id || '.0' else provider_id end provider_id,
    cast(try_cast(amount as decimal(18,2)) as varchar) claim_amount, claim_id, service_date,
    case when procedure_code = '80050' then patient_id || '.5' else patient_id end patient_id,
    procedure_code, diagnosis_code from {SRC})"""


def file_claims(spark, sf_dir):
    src = claims_src(spark, sf_dir)
    return src.select(
        F.when(F.col("procedure_code") == "99213", F.concat("provider_id", F.lit(".0")))
        .otherwise(F.col("provider_id")).alias("provider_id"),
        K.to_amount("amount").cast("string").alias("claim_amount"), "claim_id", "service_date",
        F.when(F.col("procedure_code") == "80050", F.concat("patient_id", F.lit(".5")))
        .otherwise(F.col("patient_id")).alias("patient_id"),
        "procedure_code", "diagnosis_code")


_NUMERIC = """coerced as (select try_cast(provider_id as decimal(28,10)) provider_id,
  try_cast(claim_amount as decimal(18,2)) claim_amount, try_cast(claim_id as decimal(28,10)) claim_id,
  try_cast(service_date as date) service_date, try_cast(patient_id as decimal(28,10)) patient_id,
  try_cast(procedure_code as decimal(28,10)) procedure_code, diagnosis_code from file_claims)"""
_DIGITS = "case when regexp_full_match(trim({0}), '[0-9]+') then cast({0} as bigint) end {0}"
_STRICT = f"""coerced as (select {_DIGITS.format('provider_id')},
  try_cast(claim_amount as decimal(18,2)) claim_amount, {_DIGITS.format('claim_id')},
  try_cast(service_date as date) service_date, {_DIGITS.format('patient_id')},
  {_DIGITS.format('procedure_code')}, trim(diagnosis_code) diagnosis_code from file_claims)"""


def _judged_sql(coerced):
    return f"""with {FILE_CLAIMS}, {coerced}, flagged as (
  select *, count(*) over (partition by claim_id) > 1 is_duplicate from coerced),
judged as (select *, concat_ws('; ',
  case when provider_id is null or claim_amount is null or claim_id is null or service_date is null
    or patient_id is null or procedure_code is null or diagnosis_code is null
    then 'missing required fields' end,
  case when is_duplicate then 'duplicate claim_id' end,
  case when claim_amount < 0 then 'negative claim_amount' end,
  case when not coalesce(procedure_code in (99213,80050,93000,71020,99214,36415), false)
    then 'invalid procedure_code' end,
  case when not coalesce(claim_id % 1 = 0, false) then 'invalid claim_id' end,
  case when not coalesce(patient_id % 1 = 0, false) then 'invalid patient_id' end,
  case when not coalesce(provider_id % 1 = 0, false) then 'invalid provider_id' end,
  case when service_date is null then 'malformed service_date' end,
  case when service_date > date '{AS_OF}' then 'future service_date' end) reasons from flagged)
select cast(provider_id as decimal(28,2)) provider_id, claim_amount, cast(claim_id as bigint) claim_id,
  service_date, cast(patient_id as decimal(28,2)) patient_id, cast(procedure_code as bigint) procedure_code,
  diagnosis_code, reasons, reasons = '' is_clean from judged"""


def _judged(spark, sf_dir, integers):
    typed = materialize(rules.type_claims(file_claims(spark, sf_dir), integers), "typed-claims")
    flagged = dedupe.flag_duplicates_sized(typed, ["claim_id"])
    df = flagged.withColumn("reasons", rules.broken_names(rules.claim_rules(AS_OF, integers)))
    return df.select(
        F.col("provider_id").cast("decimal(28,2)").alias("provider_id"),
        K.to_amount("claim_amount").alias("claim_amount"),
        F.col("claim_id").cast("bigint").alias("claim_id"), "service_date",
        F.col("patient_id").cast("decimal(28,2)").alias("patient_id"),
        F.col("procedure_code").cast("bigint").alias("procedure_code"), "diagnosis_code",
        F.array_join("reasons", "; ").alias("reasons"), (F.size("reasons") == 0).alias("is_clean"))


@query(_judged_sql(_NUMERIC))
def business_split_numeric(spark, sf_dir):
    return _judged(spark, sf_dir, "numeric")


@query(_judged_sql(_STRICT))
def business_split_strict(spark, sf_dir):
    return _judged(spark, sf_dir, "strict")


@query(f"""with claims_src as {SRC} select claim_id, patient_id, provider_id, diagnosis_code, procedure_code,
  service_date, not (claim_id is null or patient_id is null or provider_id is null or diagnosis_code is null
    or procedure_code is null or amount is null or service_date is null) is_complete from claims_src""")
def required_split(spark, sf_dir):
    good, bad = rules.split_required(claims_src(spark, sf_dir), SOURCE_COLUMNS)
    both = good.withColumn("is_complete", F.lit(True)).unionByName(bad.withColumn("is_complete", F.lit(False)))
    return both.drop("amount", "ingested_at")


@query(f"""with claims_src as {SRC} select claim_id, procedure_code from claims_src
where not coalesce(procedure_code in ('99213','80050','93000','71020','99214','36415'), false)""")
def allow_list(spark, sf_dir):
    bad = rules.not_allowed("procedure_code", FILE_PROCEDURE_CODES)
    return claims_src(spark, sf_dir).filter(bad).select("claim_id", "procedure_code")


@query(f"""with claims_src as {SRC},
codes as (select distinct cast(99200 + p_size as varchar) code from part)
select claim_id, procedure_code from claims_src
where not exists (select 1 from codes where code = procedure_code)""")
def allow_list_join(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select((F.col("p_size") + 99200).cast("string").alias("code"))
    claims = claims_src(spark, sf_dir).select("claim_id", "procedure_code")
    return rules.not_in_table(claims, "procedure_code", codes, "code").select("claim_id", "procedure_code")


# -- coercion ---------------------------------------------------------------

@query(f"""with {FILE_CLAIMS}, forms as (select claim_id, patient_id,
  case when diagnosis_code = 'D1' then '  ' || claim_amount || chr(9) when diagnosis_code = 'D2' then '1e2'
    when diagnosis_code = 'D3' then claim_amount || 'd' when diagnosis_code = 'D4' then 'nan'
    when diagnosis_code = 'D5' then '' else claim_amount end as amount_text from file_claims)
select claim_id, case when regexp_full_match(trim(amount_text, ' ' || chr(9)),
    '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
  then cast(try_cast(trim(amount_text, ' ' || chr(9)) as double) as decimal(18,2)) end amount,
  case when try_cast(patient_id as decimal(18,4)) % 1 = 0 then try_cast(patient_id as bigint) end patient_whole,
  coalesce(try_cast(patient_id as decimal(18,4)) % 1 = 0, false) is_whole from forms""")
def coerce_numeric(spark, sf_dir):
    d = F.col("diagnosis_code")
    amount = (
        F.when(d == "D1", F.concat(F.lit("  "), "claim_amount", F.lit("\t"))).when(d == "D2", "1e2")
        .when(d == "D3", F.concat("claim_amount", F.lit("d"))).when(d == "D4", "nan").when(d == "D5", "")
        .otherwise(F.col("claim_amount")))
    whole = K.is_whole(K.to_decimal("patient_id"))
    return file_claims(spark, sf_dir).select(
        "claim_id", K.to_amount(K.to_number(amount)).alias("amount"),
        K.to_whole("patient_id").alias("patient_whole"),
        F.coalesce(whole, F.lit(False)).alias("is_whole"))


@query(f"""with claims_src as {SRC}, parts as (select claim_id, diagnosis_code, service_date,
    substr(service_date, 1, 4) y, substr(service_date, 6, 2) m, substr(service_date, 9, 2) d from claims_src),
texts as (select claim_id, case when service_date = 'bad-date' then service_date
  when diagnosis_code = 'D1' then y || '/' || m || '/' || d when diagnosis_code = 'D2' then m || '/' || d || '/' || y
  when diagnosis_code = 'D3' then m || '-' || d || '-' || y
  when diagnosis_code = 'D4' then service_date || ' 10:30:00'
  when diagnosis_code = 'D5' then y || '-' || ltrim(m, '0') || '-' || ltrim(d, '0')
  when diagnosis_code = 'D6' then y || m || d when diagnosis_code = 'D7' then service_date || 'T10:30:00Z' else service_date end day_text,
  case when service_date <> 'bad-date' then cast(y || '-' || m || '-' || d as date) end as day from parts)
select claim_id, day_text, day, year(day) as "year", month(day) as "month", day(day) day_of_month from texts""")
def coerce_date(spark, sf_dir):
    s = F.col("service_date")
    y, m, d = F.substring(s, 1, 4), F.substring(s, 6, 2), F.substring(s, 9, 2)
    g = F.col("diagnosis_code")
    text = (
        F.when(s == "bad-date", s).when(g == "D1", F.concat_ws("/", y, m, d))
        .when(g == "D2", F.concat_ws("/", m, d, y)).when(g == "D3", F.concat_ws("-", m, d, y))
        .when(g == "D4", F.concat(s, F.lit(" 10:30:00")))
        .when(g == "D5", F.concat_ws("-", y, F.ltrim(m, F.lit("0")), F.ltrim(d, F.lit("0"))))
        .when(g == "D6", F.concat(y, m, d)).when(g == "D7", F.concat(s, F.lit("T10:30:00Z"))).otherwise(s))
    text = F.when(s.isNotNull(), text)
    df = claims_src(spark, sf_dir).select("claim_id", text.alias("day_text"))
    df = df.withColumn("day", K.to_day("day_text"))
    return df.select("*", F.year("day").alias("year"), F.month("day").alias("month"),
                     F.dayofmonth("day").alias("day_of_month"))


_SHOW_INT = "case when ok then cast(cast({0} as bigint) as varchar) else {0} end {0}"


@query(f"""with {FILE_CLAIMS}, tested as (select *, coalesce(regexp_full_match(claim_id, '[0-9]+'), false)
  and coalesce(regexp_full_match(patient_id, '[0-9]+'), false)
  and coalesce(regexp_full_match(provider_id, '[0-9]+'), false)
  and coalesce(regexp_full_match(procedure_code, '[0-9]+'), false) ok from file_claims)
select {_SHOW_INT.format('claim_id')}, {_SHOW_INT.format('patient_id')}, {_SHOW_INT.format('provider_id')},
  {_SHOW_INT.format('procedure_code')}, ok is_clean from tested""")
def integer_only(spark, sf_dir):
    columns = ["claim_id", "patient_id", "provider_id", "procedure_code"]
    good, bad = rules.integer_cleanup(file_claims(spark, sf_dir))
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    return good.select(*texts, F.lit(True).alias("is_clean")).unionByName(
        bad.select(*texts, F.lit(False).alias("is_clean")))


@query(f"""with {TYPED} select claim_id, patient_id, provider_id, diagnosis_code, procedure_code,
  cast(amount as decimal(18,2)) amount, cast(service_date as varchar) service_date from typed""")
def safe_values(spark, sf_dir):
    safe = quarantine.safe_values(typed_claims(spark, sf_dir))
    return safe.withColumn("amount", K.to_amount("amount"))


# -- duplicates -------------------------------------------------------------

@query(f"""with claims_src as {SRC} select claim_id, patient_id, service_date,
  count(*) over (partition by claim_id) > 1 is_duplicate from claims_src""")
def dup_flag_all(spark, sf_dir):
    flagged = dedupe.flag_duplicates(claims_src(spark, sf_dir), ["claim_id"])
    return flagged.select("claim_id", "patient_id", "service_date", "is_duplicate")


@query(f"""with {TYPED}, judged as (select *, {_SOURCE_REASON} rejection_reason from hashed),
ranked as (select *, row_number() over (partition by claim_id order by ingested_at nulls last,
  record_hash nulls last) rn from judged where rejection_reason is null)
select {SHOWN_SQL}, {ON_DAY}, rn = 1 is_first from ranked""")
def dup_keep_first(spark, sf_dir):
    judged = _with_source_reason(typed_claims(spark, sf_dir, row_id=True)).drop("reasons")
    good = judged.filter(F.col("rejection_reason").isNull())
    order = [("ingested_at", "asc"), ("record_hash", "asc")]
    # The hash is made of the row's own columns: after the shuffle, not sent through it.
    return shown(dedupe.mark_first(good, ["claim_id"], order, late=merge.add_hash), "is_first")


@query("""select o_custkey, o_orderkey, cast(o_orderdate as date) order_day from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls first, o_orderkey desc) rn
  from orders) where rn = 1""")
def latest_per_key(spark, sf_dir):
    latest = dedupe.keep_latest(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_day"))


# -- constraints and projections --------------------------------------------

@query("""select l_orderkey, l_linenumber, count(*) row_count from lineitem group by 1, 2 having count(*) > 1""")
def constraint_unique(spark, sf_dir):
    return schema.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"with claims_src as {SRC} " + " union all ".join(
    f"select '{c}' column_name, count(*) filter (where {c} is null) null_rows from claims_src"
    for c in SOURCE_COLUMNS))
def constraint_not_null(spark, sf_dir):
    return schema.null_counts(claims_src(spark, sf_dir), SOURCE_COLUMNS)


@query(f"""with claims_src as {SRC} select claim_id, patient_id from claims_src where patient_id is not null
  and not exists (select 1 from customer where cast(c_custkey as varchar) = patient_id)""")
def fk_orphans(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"))
    claims = claims_src(spark, sf_dir).select("claim_id", "patient_id")
    return schema.orphans(claims, customers, "patient_id", "c_custkey").select("claim_id", "patient_id")


@query(f"""with claims_src as {SRC} select claim_id, concat_ws(',', case when length(claim_id) > 5 then 'claim_id' end,
  case when length(patient_id) > 3 then 'patient_id' end) too_long from claims_src""")
def length_limits(spark, sf_dir):
    checked = schema.too_long(claims_src(spark, sf_dir), {"claim_id": 5, "patient_id": 3})
    return checked.select("claim_id", F.array_join("too_long", ",").alias("too_long"))


@query(f"""with {TYPED} select provider_id, amount, claim_id, service_date, patient_id, procedure_code,
  diagnosis_code, 'load-1' load_id from typed""")
def stage_projection(spark, sf_dir):
    df = typed_claims(spark, sf_dir).withColumnRenamed("amount", "claim_amount")
    df = schema.normalize_columns(df.toDF(*[f" {c.upper()} " for c in df.columns]))
    claims = schema.check_schema(schema.align(df, CLAIM_COLUMNS_LINES), CLAIM_COLUMNS_LINES, "ordered")
    return schema.stage_projection(claims, "load-1").select(*STAGE_COLUMNS)


# -- quarantine and audit ---------------------------------------------------

@query(f"""with {TYPED}, judged as (select *, {_SOURCE_REASON} rejection_reason from hashed)
select 'load-1' load_id, cast(claim_id as varchar) claim_id, amount, service_date, rejection_reason,
  cast(patient_id as varchar) payload_patient, procedure_code payload_code,
  amount payload_amount, cast(service_date as varchar) payload_date, rejection_reason payload_reason
from judged where rejection_reason is not null""")
def quarantine_payload(spark, sf_dir):
    bad = _with_source_reason(typed_claims(spark, sf_dir)).filter(F.col("rejection_reason").isNotNull())
    rows = quarantine.quarantine_rows(bad, "load-1", "2001-01-01 00:00:00")

    def part(name):
        return F.get_json_object("source_row_payload", f"$.{name}")

    return rows.select(
        "load_id", "claim_id", "amount", "service_date", "rejection_reason",
        part("patient_id").alias("payload_patient"), part("procedure_code").alias("payload_code"),
        K.to_amount(part("amount")).alias("payload_amount"), part("service_date").alias("payload_date"),
        part("rejection_reason").alias("payload_reason"))


# One load per ship year and one batch per ship month; good rows of 1999 stage short.
_BATCHES = f"""with {TYPED}, judged as (select *, {_SOURCE_REASON} rejection_reason from hashed),
batches as (select 'load-' || year(ingested_at) load_id, month(ingested_at) batch,
  count(*) n_read, count(*) filter (where rejection_reason is not null) n_bad,
  count(*) filter (where rejection_reason is null and (year(ingested_at) <> 1999 or amount > 50000)) n_staged
  from judged group by 1, 2),
totals as (select load_id, cast(sum(n_read) as bigint) source_rows_read,
  cast(sum(n_bad) as bigint) source_rows_quarantined, cast(sum(n_staged) as bigint) staged_rows_loaded
  from batches group by load_id)"""


def _batches(spark, sf_dir):
    judged = _with_source_reason(typed_claims(spark, sf_dir))
    good = F.col("rejection_reason").isNull()
    staged = good & ((F.year("ingested_at") != 1999) | (F.col("amount") > 50000))
    return judged.groupBy(
        F.concat(F.lit("load-"), F.year("ingested_at")).alias("load_id"),
        F.month("ingested_at").cast("bigint").alias("batch"),
    ).agg(F.count("*").alias("source_rows_read"), F.count_if(~good).alias("source_rows_quarantined"),
          F.count_if(staged).alias("staged_rows_loaded"))


@query(_BATCHES + """ select *, source_rows_read - source_rows_quarantined expected_staged,
  case when source_rows_read - source_rows_quarantined = staged_rows_loaded then 'MATCH' else 'MISMATCH' end
  reconciliation_status from totals""")
def reconcile(spark, sf_dir):
    counters = ["source_rows_read", "source_rows_quarantined", "staged_rows_loaded"]
    totals = _batches(spark, sf_dir).groupBy("load_id").agg(*[F.sum(c).alias(c) for c in counters])
    return audit.reconcile(totals)


def _event(df, key, seq, **set_columns):
    given = {"event_key": F.lit(key) if isinstance(key, str) else key, "event_seq": seq, **set_columns}
    out = []
    for field in AUDIT_EVENT_SCHEMA:
        if field.name in given:
            value = given[field.name]
        elif field.name == "load_id":
            value = F.col("load_id")
        elif field.name == "process_name":
            value = F.lit("claims")
        elif field.name == "event_at":
            value = F.lit("2001-01-01 00:00:00")
        else:
            value = F.lit(0) if field.name in AUDIT_COUNTERS else F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


@query(_BATCHES + """ select load_id, source_rows_read, source_rows_quarantined, staged_rows_loaded,
  case when source_rows_read - source_rows_quarantined = staged_rows_loaded then 'SUCCESS' else 'FAILED' end status,
  case when source_rows_read - source_rows_quarantined = staged_rows_loaded then 'MATCH' else 'MISMATCH' end
  reconciliation_status, case when source_rows_read - source_rows_quarantined <> staged_rows_loaded
    then 'counts differ' end error_message from totals""")
def audit_latest(spark, sf_dir):
    batches = materialize(_batches(spark, sf_dir), "batches")
    loads = batches.groupBy("load_id").agg(*[F.sum(c).alias(c) for c in AUDIT_COUNTERS[:3]])
    judged = audit.reconcile(loads)
    ok = F.col("reconciliation_status") == "MATCH"
    progress = _event(
        batches, F.concat(F.lit("batch-"), F.col("batch").cast("string")), F.col("batch"),
        **{c: F.col(c) for c in AUDIT_COUNTERS[:3]})
    parts = [
        _event(loads, "start", F.lit(0), status=F.lit("STARTED"), reconciliation_status=F.lit("PENDING")),
        progress, progress,  # every batch is reported twice, as after a replay
        _event(judged, "close", F.lit(2**40), status=F.when(ok, "SUCCESS").otherwise("FAILED"),
               reconciliation_status=F.col("reconciliation_status"),
               error_message=F.when(~ok, "counts differ")),
    ]
    events = reduce(lambda a, b: a.unionByName(b), parts)
    return audit.latest_state(events).select(
        "load_id", *AUDIT_COUNTERS[:3], "status", "reconciliation_status", "error_message")
