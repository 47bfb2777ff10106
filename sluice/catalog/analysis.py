"""Totals, filters and orders over the driver tables."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.catalog.views import CLAIMS_SRC, PATIENTS, claims_src, duck, patients, table
from sluice.functions.coerce import to_amount
from sluice.operators import analysis
from sluice.plans.patients import split_patients
from sluice.session import fresh_folder
from sluice.sinks.tables import append_patients
from sluice.sources.documents import join_pages


@query("""select l_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) amount
from lineitem where l_partkey is not null group by 1""")
def sum_by_product(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", to_amount("l_extendedprice").alias("amount"))
    return analysis.sum_by(lines, "l_partkey", "amount", "amount").select(
        "l_partkey", F.col("amount").cast("decimal(18,2)").alias("amount"))


@query(f"""with claims_src as {duck(CLAIMS_SRC)}
select diagnosis_code, cast(coalesce(sum(try_cast(amount as decimal(18,2))), 0) as decimal(18,2)) amount
from claims_src where diagnosis_code is not null group by 1""")
def sum_by_code(spark, sf_dir):
    claims = claims_src(spark, sf_dir).withColumn("amount", to_amount("amount"))
    return analysis.sum_by(claims, "diagnosis_code", "amount", "amount").select(
        "diagnosis_code", F.col("amount").cast("decimal(18,2)").alias("amount"))


@query("""select c_nationkey user_id, cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(18,2)) amount
from customer where c_acctbal > 0 group by 1 order by amount desc, user_id""")
def positive_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("user_id"), to_amount("c_acctbal").alias("amount"))
    return analysis.positive_totals(rows).select("user_id", F.col("amount").cast("decimal(18,2)").alias("amount"))


@query("""select o_custkey user_id, cast(sum(o_orderkey) as bigint) amount from orders
where o_orderstatus = 'F' and o_orderkey > 0 group by 1 order by amount, user_id""")
def nested_totals(spark, sf_dir):
    """Orders nested per customer and priority, then flattened and summed."""
    orders = table(spark, sf_dir, "orders")
    nested = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.collect_list(F.struct(F.col("o_orderkey").alias("amount"), F.col("o_orderstatus").alias("status")))
        .alias("transactions")).withColumnRenamed("o_custkey", "user_id")
    return analysis.nested_totals(nested, status="F")


@query("""select l_orderkey, l_linenumber, cast(cast(l_extendedprice as decimal(12,2)) * cast(l_quantity as decimal(6,0))
  as decimal(18,2)) total from lineitem""")
def line_total(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_quantity").cast("decimal(6,0)").alias("quantity"))
    totals = analysis.line_totals(lines, keep=("l_orderkey", "l_linenumber"))
    return totals.withColumn("total", F.col("total").cast("decimal(18,2)"))


@query("""select l_orderkey, l_linenumber, cast(l_shipdate as date) ship_day from lineitem
where year(l_shipdate) = 1997 and month(l_shipdate) = 3 and day(l_shipdate) = 28""")
def claims_on_date(spark, sf_dir):
    found = analysis.on_date(table(spark, sf_dir, "lineitem"), 1997, 3, 28, "l_shipdate")
    return found.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"))


@query("""select l_orderkey, l_linenumber, cast(l_shipdate as date) ship_day from lineitem
where month(l_shipdate) = 3 and day(l_shipdate) = 28""")
def claims_on_month_day(spark, sf_dir):
    found = analysis.on_date(table(spark, sf_dir, "lineitem"), None, 3, 28, "l_shipdate")
    return found.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"))


@query(f"""with claims_src as {duck(CLAIMS_SRC)}, dated as (
  select claim_id, try_cast(service_date as date) service_date from claims_src)
select claim_id, service_date, year(service_date) as "year", month(service_date) as "month",
  day(service_date) day_of_month from dated where service_date is not null""")
def claims_dated(spark, sf_dir):
    rows = analysis.dated(claims_src(spark, sf_dir).select("claim_id", "service_date"))
    return analysis.with_date_parts(rows)


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey % 2 = 0")
def even_keys(spark, sf_dir):
    return analysis.even(table(spark, sf_dir, "lineitem"), "l_orderkey").select("l_orderkey", "l_linenumber")


@query("""select l_orderkey, l_linenumber, array_to_string(list_filter([l_orderkey, l_partkey, l_suppkey, -l_partkey],
  lambda n: n % 2 = 0), ',') even_values from lineitem""")
def even_items(spark, sf_dir):
    items = F.array("l_orderkey", "l_partkey", "l_suppkey", -F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array_join(analysis.even_items(items).cast("array<string>"), ",").alias("even_values"))


@query("""select o_orderkey, cast(o_orderdate as date) order_day from orders
order by o_orderdate, o_orderkey limit 10""")
def first_n(spark, sf_dir):
    top = analysis.first_rows(table(spark, sf_dir, "orders"), 10, "o_orderdate", "o_orderkey")
    return top.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))


@query("""select c_custkey, c_name, cast(cast(c_acctbal as decimal(18,2)) as varchar) balance from customer""")
def json_records(spark, sf_dir):
    """Rows as JSON records, read back field by field."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", to_amount("c_acctbal").cast("string").alias("balance"))
    records = analysis.json_records(rows)
    back = F.from_json("record", "c_custkey long, c_name string, balance string")
    return records.select(back.alias("r")).select("r.*")


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""select conv_id doc_id, trim(string_agg(text, chr(10) order by turn), {_BLANK}) as "text" from conversations group by conv_id""")
def pages_concat(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text")
    return join_pages(pages)


@query(f"""select conv_id doc_id, trim(string_agg(chr(10) || '--- PAGE ' || cast(turn as varchar) || ' ---' || chr(10) || text,
  chr(10) order by turn), {_BLANK}) as "text" from conversations group by conv_id""")
def scanned_pages_concat(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text")
    return join_pages(pages, page_headers=True)


_PATIENTS = duck(PATIENTS)


@query(f"""select patient_id, name, dob, updated_at from (
  select *, row_number() over (partition by patient_id order by updated_at desc nulls first, name desc nulls first) rn
  from {_PATIENTS} p where patient_id is not null and name is not null and dob is not null) where rn = 1""")
def patient_latest(spark, sf_dir):
    valid, _ = split_patients(patients(spark, sf_dir), ["name"])
    return valid


@query(f"""select patient_id, name, dob, updated_at from {_PATIENTS} p
where patient_id is null or name is null or dob is null""")
def patient_invalid(spark, sf_dir):
    _, invalid = split_patients(patients(spark, sf_dir))
    return invalid


@query("""select c_custkey patient_id, c_name first_name, c_mktsegment last_name, '1970-01-01' dob, 'crm' source_system
from customer""")
def warehouse_patients(spark, sf_dir):
    """Patient rows appended to a warehouse table and read back."""
    folder = fresh_folder(spark, "warehouse")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"), F.lit("1970-01-01").alias("dob"),
        F.lit("crm").alias("source_system"), "c_acctbal")
    append_patients(rows, folder)
    return spark.read.parquet(folder)
