"""Test inputs over the driver tables, as one SQL text for both engines."""

from pyspark.sql import DataFrame, SparkSession

from sluice.sources.tables import with_row_id

AS_OF = "2001-01-01"
EARLY = "1998-07-01"

CLAIMS_SRC = """
select cast(l_orderkey*10+l_linenumber as STR) claim_id,
 case when o_custkey%29=0 then null when o_custkey%31=0 then 'UNK' else cast(o_custkey as STR) end patient_id,
 case when l_suppkey%23=0 then null else cast(l_suppkey as STR) end provider_id,
 case when l_partkey%19=0 then null else concat('D',cast(l_partkey%9 as STR)) end diagnosis_code,
 case when l_partkey%47=0 then null else case cast(l_partkey%7 as int) when 0 then '99213' when 1 then '80050'
   when 2 then '93000' when 3 then '71020' when 4 then '99214' when 5 then '36415' else '00000' end end procedure_code,
 case when l_partkey%37=0 then null when l_partkey%41=0 then -l_extendedprice else l_extendedprice end amount,
 case when l_partkey%43=0 then 'bad-date' when l_partkey%53=0 then null
   else cast(cast(l_shipdate as date) as STR) end service_date,
 l_shipdate ingested_at ROW_ID
from LINEITEM join ORDERS on l_orderkey=o_orderkey
"""

CLAIMS_LINES = """
select l_orderkey*10+l_linenumber line_key, l_partkey, case
 when l_partkey%71=0 then '  '
 when l_partkey%67=0 then concat(cast(l_suppkey as STR),',"',cast(cast(l_extendedprice as decimal(18,2)) as STR),',',cast(l_orderkey as STR))
 when l_partkey%61=0 then concat_ws(',',cast(l_suppkey as STR),cast(l_orderkey as STR),cast(cast(l_shipdate as date) as STR))
 else concat(concat_ws(',',cast(l_suppkey as STR),cast(cast(l_extendedprice as decimal(18,2)) as STR),cast(l_orderkey as STR),
   cast(cast(l_shipdate as date) as STR),'"77,1"','99213','R51'), case when l_partkey%59=0 then ',EXTRA_FIELD' else '' end) end raw_row
from LINEITEM
"""

NOTES_SRC = """
select o_orderkey doc_id, concat(
 case cast(o_orderkey%5 as int) when 0 then 'Discharge Summary' when 1 then 'Consult Note' when 2 then 'LABORATORY REPORT'
   when 3 then 'Informed consent' else 'Memo' end, chr(10), chr(10),
 case when o_orderkey%7=0 then '' else concat('Patient Name:  Pat ', o_orderpriority, chr(10)) end,
 case when o_orderkey%3=0 then '' else concat('MRN: ', cast(o_custkey as STR), chr(10)) end,
 case when o_orderkey%11=0 then '' else concat('DOB: 1/2/19', cast(10+o_orderkey%80 as STR), chr(10)) end,
 'Sex: ', case when o_custkey%2=0 then 'Male' else 'F' end, chr(10),
 case when o_orderkey%4=0 then '' else concat('Admit Date: 3/4/2020', chr(10), 'Discharge Date: 3-9-2020', chr(10)) end,
 case when o_orderkey%6=0 then '' else concat('Diagnosis: code ', o_orderstatus, chr(9), ' end', chr(10)) end,
 case when o_orderkey%8=0 then '' else 'Provider: Dr. O''Neil' end) txt
from ORDERS
"""

PATIENTS = """
select cast(c_nationkey*100 as bigint)+cast(c_custkey%100 as bigint) patient_id,
 case when c_acctbal<0 then null else c_name end as name, c_mktsegment dob,
 case when c_custkey%17=0 then null else cast(c_acctbal as decimal(18,2)) end updated_at
from CUSTOMER
"""

TABLES = ("lineitem", "orders", "customer")


def duck(view: str) -> str:
    """The view as a subquery for DuckDB."""
    text = view.replace("STR", "varchar").replace("ROW_ID", "")
    for name in TABLES:
        text = text.replace(name.upper(), name)
    return f"({text})"


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    """A driver table; dates do not depend on the zone of the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark, sf_dir, view, row_id=False):
    text = view.replace("STR", "string").replace("ROW_ID", ", row_id" if row_id else "")
    frames = {}
    for name in TABLES:
        if name.upper() in text:
            text = text.replace(name.upper(), "{" + name + "}")
            df = table(spark, sf_dir, name)
            frames[name] = with_row_id(df) if row_id and name == "lineitem" else df
    return spark.sql(text, **frames)


def claims_src(spark, sf_dir, row_id=False) -> DataFrame:
    return _view(spark, sf_dir, CLAIMS_SRC, row_id)


def claims_lines(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, CLAIMS_LINES)


def notes_src(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, NOTES_SRC)


def patients(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, PATIENTS)
