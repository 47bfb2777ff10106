import csv
import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.model import REJECTS_SCHEMA, STAGE_SCHEMA, TARGET_SCHEMA
from sluice.plans import claims as C
from sluice.plans import migration as M
from sluice.plans.claims import load_claims_lines, load_claims_strict, new_load_id
from sluice.plans.patients import process_patient_file
from sluice.sinks import publish as P
from sluice.sinks.tables import append_patients, read_load_table, write_load
from sluice.sources.tables import read_table

AS_OF, TS = "2025-12-31", "2026-01-01 00:00:00"
HEADER = "provider_id,claim_amount,claim_id,service_date,patient_id,procedure_code,diagnosis_code\n"


def csv_rows(path):
    out = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, newline="", encoding="utf-8") as f:
            out += list(csv.DictReader(f))
    return out


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


LINES = (
    HEADER
    + "10,5.5,300001.0,2025-06-22,7,99213,E11\n"
    + "\n"
    + '9031,"68.16,300017.0,2025-06-22,74925,80050,R51\n'
    + "5198,1076.86,300098.0,2025-08-22,15258\n"
    + "3356,778.22,300251.0,2025-06-20,12049,36415,I10,EXTRA_FIELD\n"
    + "10,-5.5,300002,2025-06-22,7,99213,E11\n"
    + "10,5.5,300003,2025-06-22,UNK,99213,E11\n"
    + "10,1,300004,2025-06-22,7,99213,\n"
    + "10,1,300005,2025-06-22,7,99213,E11\n"
    + "10,1,300005,2025-06-22,7,99213,E11\n"
    + '9999,100.5,399999,2025-12-31,12345,99213,"E11')


def test_line_load_numeric(spark, tmp_path, folder):
    path = put(tmp_path / "claims.csv", LINES)
    got = load_claims_lines(spark, path, f"{folder}/stage", f"{folder}/archive", "L1", AS_OF, TS, count_rules=True)
    assert got["rows_read"] == 11 and got["structurally_clean"] == 6 and got["structurally_bad"] == 6
    assert got["business_bad"] == 4 and got["rows_loaded"] == 2
    assert got["rules"]["duplicate claim_id"] == 2 and got["rules"]["negative claim_amount"] == 1
    stage = read_load_table(spark, f"{folder}/stage", STAGE_SCHEMA, "L1").orderBy("claim_id").collect()
    assert [(r["claim_id"], r["diagnosis_code"], r["stg_claim_row_id"]) for r in stage] == [
        ("300001", "E11", 2), ("300004", "", 9)]
    bad = csv_rows(f"{folder}/archive/structural_bad_records_L1")
    assert list(bad[0]) == ["line_number", "reason", "raw_row"]
    assert [(int(r["line_number"]), r["reason"]) for r in bad] == [
        (3, "empty row"), (4, "broken quoted row"), (5, "row has too few columns"),
        (6, "row has extra columns"), (12, "broken quoted row"), (12, "truncated final row")]
    assert bad[1]["raw_row"] == '9031,"68.16,300017.0,2025-06-22,74925,80050,R51'
    invalid = csv_rows(f"{folder}/archive/invalid_records_L1")
    assert len(invalid) == 4 and list(invalid[0])[-1] == "load_id"


def test_line_load_strict_and_rerun(spark, tmp_path, folder):
    path = put(tmp_path / "claims.csv", LINES)
    for _ in range(2):
        got = load_claims_lines(spark, path, f"{folder}/stage", f"{folder}/archive", "L1", AS_OF, TS, "strict")
    assert got["rows_loaded"] == 1  # 300001.0 is not digits only
    load_claims_lines(spark, path, f"{folder}/stage", f"{folder}/archive", "L2", AS_OF, TS, "numeric")
    stage = read_load_table(spark, f"{folder}/stage", STAGE_SCHEMA)
    assert {r["load_id"]: r["count"] for r in stage.groupBy("load_id").count().collect()} == {"L1": 1, "L2": 2}


def test_line_load_reorders_and_refuses(spark, tmp_path, folder):
    swapped = "Claim_ID ,provider_id,claim_amount,service_date,patient_id,procedure_code,diagnosis_code\n"
    path = put(tmp_path / "a.csv", swapped + "1,10,5,2025-01-01,7,99213,E11\n")
    got = load_claims_lines(spark, path, f"{folder}/s", f"{folder}/a", "L", AS_OF, TS)
    assert got["reordered"] and got["rows_loaded"] == 1
    with pytest.raises(ValueError, match="missing"):
        load_claims_lines(spark, put(tmp_path / "b.csv", "x,y\n1,2\n"), f"{folder}/s", f"{folder}/a", "L", AS_OF, TS)
    with pytest.raises(ValueError, match="empty"):
        load_claims_lines(spark, put(tmp_path / "c.csv", ""), f"{folder}/s", f"{folder}/a", "L", AS_OF, TS)
    many = tmp_path / "many"
    many.mkdir()
    put(many / "1.csv", LINES)
    put(many / "2.csv", swapped + "1,10,5,2025-01-01,7,99213,E11\n")
    with pytest.raises(Exception, match="schema drift"):
        load_claims_lines(spark, str(many), f"{folder}/s", f"{folder}/a", "L", AS_OF, TS)


STRICT = "claim_id,patient_id,provider_id,diagnosis_code,procedure_code,claim_amount,service_date\n"


def test_strict_load(spark, tmp_path, folder):
    path = put(tmp_path / "s.csv", STRICT + "1,2,3,E11,99213,10.5,2025-01-01\n2,2,3,,99213,1,2025-01-01\n3,2,3,E11,99213,NA,2025-01-01\n")
    got = load_claims_strict(spark, path, f"{folder}/stage", f"{folder}/arch", "L", TS)
    assert (got["rows_read"], got["rows_loaded"], got["rows_invalid"]) == (3, 1, 2)
    assert len(csv_rows(f"{folder}/arch/invalid_records_L")) == 2
    for text in ["CLM1,2,3,E11,99213,1,2025-01-01\n", "1.5,2,3,E11,99213,1,2025-01-01\n", "1,2,3,E11,99213,1,soon\n"]:
        with pytest.raises(Exception):
            load_claims_strict(spark, put(tmp_path / "x.csv", STRICT + text), f"{folder}/stage", f"{folder}/arch", "X", TS)
    with pytest.raises(ValueError, match="drift"):
        load_claims_strict(spark, put(tmp_path / "y.csv", HEADER + "1,2,3,4,5,6,7\n"), f"{folder}/stage", f"{folder}/arch", "Y", TS)
    assert {r["load_id"] for r in read_load_table(spark, f"{folder}/stage", STAGE_SCHEMA).collect()} == {"L"}
    assert not glob.glob(f"{folder}/stage/_staging/*") and not glob.glob(f"{folder}/arch/_staging/*")


def test_load_id():
    got = new_load_id(datetime(2026, 3, 29, 22, 59, 32))
    assert got.startswith("20260329225932_") and len(got) == 23


def test_publish_leaves_nothing_of_a_failed_load(spark, folder):
    df = spark.range(5)
    good, wrong = P.Output(f"{folder}/a", "x", df, 5), P.Output(f"{folder}/b", "y", df, 6, "csv")
    with pytest.raises(ValueError, match="should hold 6"):
        P.publish(spark, "L", [good, wrong])
    assert not glob.glob(f"{folder}/a/x") and not glob.glob(f"{folder}/b/y")
    assert not glob.glob(f"{folder}/*/_staging/*")
    assert P.publish(spark, "L", [good]) == {"x": 5}


def test_versions(spark, folder):
    one = P.next_version(spark, folder, "L")
    P.write_aside(spark.range(3), folder, one)
    assert P.read_version(spark, folder, spark.range(1).schema).count() == 0
    P.switch_version(spark, folder, one)
    assert P.read_version(spark, folder, spark.range(1).schema).count() == 3
    with pytest.raises(OSError):
        P.switch_version(spark, folder, "00000001-other")


def source(spark, folder, rows):
    cols = "claim_id int, patient_id int, provider_id int, diagnosis_code string, procedure_code string, amount decimal(18,2), service_date string"
    from decimal import Decimal
    fixed = [tuple(Decimal(str(v)) if i == 5 and v is not None else v for i, v in enumerate(r)) for r in rows]
    spark.createDataFrame(fixed, cols).write.mode("overwrite").parquet(folder)
    return read_table(spark, folder)


ROWS = [
    (1, 2, 3, "D", "99201", 5, "2025-01-01"), (1, 2, 3, "D", "99201", 9, "2025-01-01"),
    (2, None, 3, "D", "99201", 5, "2025-01-01"), (3, 2, 3, None, "77777", 0, "2025-12-31"),
    (4, 2, 3, "D", " ", -1, "bad"), (None, 2, 3, "D", "99201", 5, "2030-01-01")]


def test_migration_and_rerun(spark, folder):
    tables = M.Tables(f"{folder}/m")
    got = M.process_claims(spark, source(spark, f"{folder}/src", ROWS), tables, "L1", AS_OF, TS)
    assert got["status"] == "SUCCESS", got
    assert (got["source_rows_read"], got["source_rows_quarantined"], got["staged_rows_loaded"]) == (6, 4, 2)
    assert got["target_rows_upserted"] == 2 and got["reconciliation_status"] == "MATCH"
    reasons = sorted(r["rejection_reason"] for r in spark.read.parquet(tables.quarantine).collect())
    assert reasons == ["duplicate claim_id in source chunk", "missing claim_id; future service_date",
                       "missing patient_id", "missing procedure_code; negative amount; missing/invalid service_date"]
    assert len(csv_rows(got["quarantine_files"][0])) == 4
    again = M.process_claims(spark, source(spark, f"{folder}/src2", ROWS), tables, "L1", AS_OF, "2026-02-02 00:00:00")
    assert again["target_rows_upserted"] == 0
    target = P.read_version(spark, tables.target, TARGET_SCHEMA)
    assert {(r["claim_id"], float(r["amount"]), r["ingested_at"].year) for r in target.collect()} == {("1", 5.0, 2026), ("3", 0.0, 2026)}
    assert spark.read.parquet(tables.quarantine).count() == 4
    state = M.audit_state(spark, tables).first()
    assert (state["source_rows_read"], state["status"]) == (6, "SUCCESS")
    assert M.result_frame(spark, got).first()["reconciliation_status"] == "MATCH"


def test_migration_failure_is_recorded(spark, folder):
    tables = M.Tables(f"{folder}/m")
    got = M.process_claims(spark, spark.range(3), tables, "L", AS_OF, TS)
    assert got["status"] == "FAILED" and "schema check" in got["error"]
    assert M.audit_state(spark, tables).first()["status"] == "FAILED"


def staged(spark, tables, load_id, rows):
    cols = "claim_id string, patient_id string, amount double, service_date string, ingested_at string, stg_claim_row_id long"
    df = spark.createDataFrame(rows, cols).withColumns({
        "load_id": F.lit(load_id), "provider_id": F.lit("3"), "diagnosis_code": F.lit(None),
        "procedure_code": F.lit("99201"), "record_hash": F.lit(None)})
    write_load(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGE_SCHEMA]), tables.stage)


def test_merge_rejects_and_variants(spark, folder):
    tables = M.Tables(f"{folder}/m")
    staged(spark, tables, "L1", [
        ("1", "2", 5.0, "2025-01-01", "2025-01-01 00:00:00", 1), ("1", "2", 6.0, "2025-01-01", "2025-01-02 00:00:00", 2),
        ("1", "2", 7.0, "2025-01-01", None, 3), (None, "2", 5.0, "2025-01-01", "2025-01-01 00:00:00", 4),
        ("5", None, -1.0, "2025-01-01", "2025-01-01 00:00:00", 5)])
    first = M.merge_load(spark, tables, "L1", AS_OF, TS)
    assert first == {"rejected_rows": 2, "rejected_total": 4, "upserted_rows": 1}
    # A missing ingest time ranks as the latest.
    assert float(P.read_version(spark, tables.target, TARGET_SCHEMA).first()["amount"]) == 7.0
    assert M.merge_load(spark, tables, "L1", AS_OF, TS) == {"rejected_rows": 0, "rejected_total": 4, "upserted_rows": 0}
    rejects = read_load_table(spark, tables.rejects, REJECTS_SCHEMA)
    assert rejects.count() == 4
    # Without hashes the strict policy never updates; random hashes always do.
    staged(spark, tables, "L2", [("1", "2", 8.0, "2025-01-01", "2025-01-01 00:00:00", 1)])
    assert M.merge_load(spark, tables, "L2", AS_OF, TS, policy="strict", hash_mode="keep")["upserted_rows"] == 0
    assert M.merge_load(spark, tables, "L2", AS_OF, TS, hash_mode="random")["upserted_rows"] == 1
    assert M.merge_load(spark, tables, "L2", AS_OF, TS, hash_mode="random")["upserted_rows"] == 1
    assert M.merge_by_hash(spark, tables, "L2", AS_OF, TS) == 1


def test_patient_file_and_warehouse(spark, tmp_path, folder):
    path = put(tmp_path / "p.csv", "patient_id,name,dob,updated_at\n101,John,1990-01-01,2024-01-01\n101,John,1990-01-01,2024-02-01\n103,,1970-01-01,2024-01-01\n")
    valid, invalid = process_patient_file(spark, path)
    assert [r["updated_at"] for r in valid.collect()] == ["2024-02-01"] and invalid.count() == 1
    rows = spark.createDataFrame([(1, "a", "b", "c", "d", "e")], "patient_id int, first_name string, last_name string, dob string, source_system string, other string")
    for _ in range(2):
        append_patients(rows, f"{folder}/w")
    assert spark.read.parquet(f"{folder}/w").count() == 2


def test_header_with_quotes(spark, tmp_path):
    names = C.read_header(spark, put(tmp_path / "q.csv", '"provider_id", Claim_Amount ,claim_id,service_date,patient_id,procedure_code,diagnosis_code\n'))
    assert names[:2] == ["provider_id", "claim_amount"]


def test_merge_buckets_are_the_callers(spark, folder):
    tables = M.Tables(f"{folder}/b")
    staged(spark, tables, "L1", [(str(k), "2", 5.0, "2025-01-01", "2025-01-01 00:00:00", k) for k in range(1, 200)])
    assert M.merge_load(spark, tables, "L1", AS_OF, TS, buckets=64)["upserted_rows"] == 199
    marker = P.current_marker(spark, tables.target)
    assert marker["count"] == 64 and len(marker["buckets"]) == 64
    staged(spark, tables, "L2", [("7", "2", 9.0, "2025-01-01", "2025-01-02 00:00:00", 1)])
    assert M.merge_load(spark, tables, "L2", AS_OF, TS, buckets=8)["upserted_rows"] == 1
    after = P.current_marker(spark, tables.target)
    # The target keeps its own count; one bucket is written anew.
    assert after["count"] == 64 and sum(after["buckets"][b] != marker["buckets"][b] for b in marker["buckets"]) == 1
    assert P.read_version(spark, tables.target, TARGET_SCHEMA).count() == 199


def test_every_chunk_has_one_quarantine_file(spark, folder):
    """A file per task and chunk made the number of files grow with the square of the extract (F2, F3)."""
    few = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4000"}
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        tables = M.Tables(f"{folder}/m")
        rows = [(i, None, 3, "D", "99201", 5, "2025-01-01") for i in range(60)]
        got = M.process_claims(spark, source(spark, f"{folder}/src", rows), tables, "L1", AS_OF, TS, chunk_size=20)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got["status"] == "SUCCESS", got
    chunks = sorted(glob.glob(f"{got['quarantine_files'][0]}/chunk_file=*"))
    assert [c.rsplit("=", 1)[1] for c in chunks] == [f"L1_chunk_0000{i}_bad_rows" for i in (1, 2, 3)]
    assert [(len(glob.glob(f"{c}/part-*")), len(csv_rows(c))) for c in chunks] == [(1, 20)] * 3
