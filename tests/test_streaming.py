import glob
import os

from sluice.model import AUDIT_EVENT_SCHEMA, STAGE_SCHEMA
from sluice.operators.audit import latest_state
from sluice.plans.migration import Tables
from sluice.sinks.tables import read_load_table, write_load
from sluice.streaming.claims import claims_batch, judge_files, run_claims_intake
from sluice.streaming.split_files import archive_processed, run_intake

HEADER = "provider_id,claim_amount,claim_id,service_date,patient_id,procedure_code,diagnosis_code\n"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_split_files_twice(spark, folder):
    root = f"{folder}/in"
    put(f"{root}/success_split_files/aa-1_Prog-A_split_file_1.csv", "1|x|\n2||z\n\n")
    put(f"{root}/unprocessed_transactions/aa-1_Prog-A_20250101.csv", "3,y,w\n")
    put(f"{root}/other/bb-2_Prog-B_split_file_1.csv", "9|9\n")
    targets = [f"{folder}/one", f"{folder}/two"]

    def run():
        run_intake(spark, root, targets, f"{folder}/failed", f"{folder}/cp")
        shown = ["program_name", "row_as_string", "file_uuid"]
        return [sorted((tuple(r) for r in spark.read.parquet(t).select(*shown).collect()), key=str) for t in targets]

    one, two = run()
    assert one == two == sorted([
        ("Prog-A", "1,x,nan", "aa-1"), ("Prog-A", "2,nan,z", "aa-1"), (None, "3,y,w", "aa-1")], key=str)
    assert run() == [one, two]
    put(f"{root}/success_split_files/cc-3_Prog-C_split_file_1.csv", "7|7\n")
    assert len(run()[0]) == 4


def test_failed_batch_goes_to_neither_target(spark, folder):
    root = f"{folder}/in"
    put(f"{root}/success_split_files/aa-1_Prog-A_split_file_1.csv", "1|x\n2|y\n")

    def write(df, path, keys):
        if path.endswith("two"):
            raise RuntimeError("no connection")
        write_load(df, path, keys)

    run_intake(spark, root, [f"{folder}/one", f"{folder}/two"], f"{folder}/failed", f"{folder}/cp",
               database="db", stamp="20250101_000000", write=write)
    assert not glob.glob(f"{folder}/one/batch_id=*/*.parquet")
    kept = spark.read.option("header", True).csv(f"{folder}/failed")
    assert {r["archive"] for r in kept.collect()} == {"aa-1_Prog-A_db_20250101_000000"} and kept.count() == 2


def test_archive_processed(spark, folder):
    put(f"{folder}/in/success_split_files/a.csv", "1\n")
    assert archive_processed(spark, ["success_split_files/a.csv"], f"{folder}/in", f"{folder}/archive_files") == 1
    assert os.path.exists(f"{folder}/archive_files/success_split_files/a.csv")
    assert not os.path.exists(f"{folder}/in/success_split_files/a.csv")


def test_claims_intake_by_batches(spark, folder):
    root, tables = f"{folder}/in", Tables(f"{folder}/t")
    for i in range(3):
        put(f"{root}/f{i}.csv", HEADER + "".join(
            f"10,5,{i * 100 + j},2025-01-01,7,{'99213' if j else '11111'},E11\n" for j in range(4)))

    def run():
        run_claims_intake(spark, root, tables, f"{folder}/cp", "S", "2025-12-31", "2026-01-01 00:00:00", max_files=2)
        return read_load_table(spark, tables.stage, STAGE_SCHEMA).count()

    assert run() == 9
    assert run() == 9
    loads = latest_state(spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit)).collect()
    assert sum(r["source_rows_read"] for r in loads) == 12 and len(loads) == 2
    assert sum(r["source_rows_quarantined"] for r in loads) == 3
    # A replayed batch changes nothing.
    batch = spark.createDataFrame([(f"{root}/f0.csv",), (f"{root}/f1.csv",)], "path string")
    before = {r["load_id"]: r["staged_rows_loaded"] for r in loads}
    claims_batch(tables, "S", "2025-12-31", "2026-01-01 00:00:00")(batch, 0)
    after = latest_state(spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit)).collect()
    assert {r["load_id"]: r["staged_rows_loaded"] for r in after} == before
    assert read_load_table(spark, tables.stage, STAGE_SCHEMA).count() == 9
    put(f"{root}/f3.csv", HEADER + "10,5,900,2025-01-01,7,99213,E11\n")
    assert run() == 10


def test_a_bad_file_does_not_stop_the_stream(spark, folder):
    root, tables = f"{folder}/in", Tables(f"{folder}/t")
    put(f"{root}/a.csv", HEADER + "10,5,1,2025-01-01,7,99213,E11\n")
    put(f"{root}/b.csv", "claim_id,Provider_ID,claim_amount,service_date,patient_id,procedure_code,diagnosis_code\n"
                         "2,10,5,2025-01-01,7,99213,E11\n2x,10,5\n")
    put(f"{root}/c.csv", "claim_id,other\n3,4\n")
    put(f"{root}/d.csv", "\n")

    def run():
        run_claims_intake(spark, root, tables, f"{folder}/cp", "S", "2025-12-31", "2026-01-01 00:00:00")
        stage = read_load_table(spark, tables.stage, STAGE_SCHEMA)
        return sorted((r.claim_id, r.provider_id, r.stg_claim_row_id) for r in stage.collect())

    assert [r[:2] for r in run()] == [("1", "10"), ("2", "10")] and len({r[2] for r in run()}) == 2
    refused = {os.path.basename(r.file): r.reason for r in spark.read.parquet(tables.file_rejects).collect()}
    assert set(refused) == {"c.csv", "d.csv"} and all("missing" in reason for reason in refused.values())
    put(f"{folder}/none.csv", "")  # the stream itself passes over a file without bytes
    assert judge_files(spark, [f"{folder}/none.csv"]) == ({}, {f"{folder}/none.csv": "input is empty"})
    # A batch of nothing else is audited and passed.
    put(f"{root}/e.csv", "nothing\n")
    run()
    states = {r.load_id: r.status for r in latest_state(spark.read.schema(AUDIT_EVENT_SCHEMA).parquet(tables.audit)).collect()}
    assert states["S-000001"] == "FAILED"
    put(f"{root}/f.csv", HEADER + "10,5,9,2025-01-01,7,99213,E11\n")
    assert len(run()) == 3


def test_empty_batch_is_no_load(spark, folder):
    tables = Tables(f"{folder}/x")
    claims_batch(tables, "S", "2025-12-31", "2026-01-01 00:00:00")(spark.createDataFrame([], "path string"), 0)
    assert not os.path.exists(tables.stage)


def test_both_targets_or_neither(spark, folder):
    from sluice.streaming.split_files import read_committed, write_both

    rows = spark.createDataFrame([("P", "1,2", "u", "success_split_files", "u_P")], "program_name string, row_as_string string, file_uuid string, folder string, id_and_program string")
    targets, commits = [f"{folder}/one", f"{folder}/two"], f"{folder}/_commits"

    class Stop(BaseException):
        """The driver dies: no handler runs."""

    def dies_before_two(df, path, keys):
        if path.endswith("two"):
            raise Stop
        write_load(df, path, keys)

    try:
        write_both(rows, 3, targets, dies_before_two, commits)
    except Stop:
        pass
    assert spark.read.parquet(targets[0]).count() == 1
    assert [read_committed(spark, t, commits).count() for t in targets[:1]] == [0]
    write_both(rows, 3, targets, commits=commits)
    assert [read_committed(spark, t, commits).count() for t in targets] == [1, 1]
    # A replay that dies again hides the batch in both, never one of them.
    try:
        write_both(rows.union(rows), 3, targets, dies_before_two, commits)
    except Stop:
        pass
    assert [read_committed(spark, t, commits).count() for t in targets] == [0, 0]
    write_both(rows.union(rows), 3, targets, commits=commits)
    write_both(rows, 4, targets, commits=commits)
    assert [read_committed(spark, t, commits).count() for t in targets] == [3, 3]
