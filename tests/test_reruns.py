"""Re-runs, undo and scans that must not lose anything."""

from datetime import date
from decimal import Decimal

import pytest

from sluice.functions import coerce as K
from sluice.operators import audit
from sluice.plans import migration as M
from sluice.plans.migration import Tables, process_claims
from sluice.sinks import publish as P
from sluice.sources.delimited import read_csv, read_typed_csv

AS_OF, TS = "2025-12-31", "2026-01-01 00:00:00"
COLUMNS = "claim_id int, patient_id int, provider_id int, diagnosis_code string, procedure_code string, amount decimal(18,2), service_date string"


def source(spark, *rows):
    return spark.createDataFrame([(*r[:5], Decimal(r[5]), r[6]) for r in rows], COLUMNS)


def claim(k, amount="5.50"):
    return (k, 7, 10, "E11", "99213", amount, "2025-06-22")


def test_a_failed_load_that_succeeds_reads_success(spark, folder, monkeypatch):
    tables = Tables(folder)
    rows = source(spark, claim(1), claim(2), claim(3))
    with monkeypatch.context() as broken:
        broken.setattr(M, "merge_load", lambda *a, **k: 1 / 0)
        assert process_claims(spark, rows, tables, "L", AS_OF, TS)["status"] == "FAILED"
    state = M.audit_state(spark, tables).first()
    assert (state.status, state.source_rows_read) == ("FAILED", 3) and "division" in state.error_message
    assert process_claims(spark, rows, tables, "L", AS_OF, TS)["status"] == "SUCCESS"
    state = M.audit_state(spark, tables).first()
    assert (state.status, state.error_message, state.source_rows_read, state.target_rows_upserted) == ("SUCCESS", None, 3, 3)
    # A third run merges nothing new, and says so.
    assert process_claims(spark, rows, tables, "L", AS_OF, TS)["target_rows_upserted"] == 0
    assert M.audit_state(spark, tables).first().target_rows_upserted == 0


def test_a_corrected_source_leaves_no_quarantine(spark, folder):
    tables = Tables(folder)
    process_claims(spark, source(spark, claim(1), claim(2, "-1.00")), tables, "L", AS_OF, TS)
    assert spark.read.parquet(tables.quarantine).where("load_id = 'L'").count() == 1
    process_claims(spark, source(spark, claim(1), claim(2)), tables, "L", AS_OF, TS)
    assert spark.read.parquet(f"{tables.quarantine}/load_id=L").count() == 0


def test_replayed_events_count_once_per_attempt(spark):
    events = [audit.started("L", "p", TS), audit.progress("L", "p", TS, 0, source_rows_read=6), audit.failed("L", "p", TS, "no"),
              audit.started("L", "p", TS, 1), *[audit.progress("L", "p", TS, 0, 1, source_rows_read=4)] * 2, audit.succeeded("L", "p", TS, 0, 4, 1)]
    frame = audit.events_frame(spark, events)
    state = audit.latest_state(frame).first()
    assert (state.status, state.source_rows_read, state.error_message) == ("SUCCESS", 4, None)
    assert audit.next_attempt(frame, "L") == 2 and audit.next_attempt(frame, "other") == 0


@pytest.mark.parametrize("broken", ["second rename", "recount"])
def test_publish_takes_back_what_it_promoted(spark, folder, monkeypatch, broken):
    old, new = spark.range(3), spark.range(5)
    outputs = lambda df, n: [P.Output(f"{folder}/a", "x", df, n), P.Output(f"{folder}/b", "y", df, n)]
    P.publish(spark, "L", outputs(old, 3))
    if broken == "recount":
        real = P.Output.check
        monkeypatch.setattr(P.Output, "check", lambda self, path, what: 1 / 0 if what.startswith("recount after") else real(self, path, what))
    else:
        move = P.rename
        monkeypatch.setattr(P, "rename", lambda s, a, b: 1 / 0 if b.endswith("/b/y") and "_staging" in a and "replaced" not in a else move(s, a, b))
    with pytest.raises(ZeroDivisionError):
        P.publish(spark, "M", outputs(new, 5))
    assert spark.read.parquet(f"{folder}/a/x").count() == 3 and spark.read.parquet(f"{folder}/b/y").count() == 3
    monkeypatch.undo()
    P.publish(spark, "M", outputs(new, 5))
    assert spark.read.parquet(f"{folder}/b/y").count() == 5


def test_one_number_has_one_writer(spark, folder):
    mine, other = P.next_version(spark, folder, "A"), P.next_version(spark, folder, "B")
    P.write_aside(spark.range(2), folder, mine)
    P.switch_version(spark, folder, mine)
    with pytest.raises(OSError, match="another writer"):
        P.switch_version(spark, folder, other)
    assert P.current_marker(spark, folder)["version"] == mine


def test_csv_rows_are_not_cut(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a,b"\n2\n3,c,EXTRA\n')
    df = read_csv(spark, str(tmp_path / "a.csv"))
    with pytest.raises(Exception, match="extra columns: 3,c,EXTRA"):
        df.select("y").collect()
    (tmp_path / "b.csv").write_text('x,y\n1,"a,b"\n2\n"4 ""q"", r",\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "b.csv")).collect()] == [("1", "a,b"), ("2", None), ('4 "q", r', None)]


def test_csv_columns_are_not_swapped(spark, tmp_path):
    names = "claim_id,patient_id,provider_id,diagnosis_code,procedure_code,claim_amount,service_date"
    swapped = names.replace("claim_id,patient_id", "patient_id,claim_id")
    (tmp_path / "1.csv").write_text(f"{names}\n5,777,1,E11,99213,1.0,2025-01-01\n")
    (tmp_path / "2.csv").write_text(f"{swapped}\n777,5,1,E11,99213,1.0,2025-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_typed_csv(spark, str(tmp_path)).collect()


DATES = {
    "2025-1-5": date(2025, 1, 5), "20250105": date(2025, 1, 5), "2025-01-05T10:00:00Z": date(2025, 1, 5), "2025-01-05 10:00+02:00": date(2025, 1, 5),
    "5 Jan 2025": date(2025, 1, 5), "05-JAN-2025": date(2025, 1, 5), "Jan 5, 2025": date(2025, 1, 5), "january 5 2025": date(2025, 1, 5),
    "2025-13-01": None, "20251301": None, "5 Foo 2025": None, "2025-1": None, "": None,
}


def test_date_layouts(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d string")
    assert {r.d: r.day for r in df.select("d", K.to_day("d").alias("day")).collect()} == DATES


def test_tiny_fractions_are_no_whole_numbers(spark):
    texts = {"300017.00000000001": False, "-5.00000000000000000001": False, "300017.0": True, "300017.00000000000000": True, "7": True, "1.5": False, "0.99999999999": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.ok, r.n) for r in df.select("t", K.is_whole(K.to_decimal("t")).alias("ok"), K.to_whole("t").alias("n")).collect()}
    assert {t: v[0] for t, v in got.items()} == texts
    assert got["300017.00000000001"][1] is None and got["300017.0"][1] == 300017


def test_validity_reaches_the_scan(spark, folder):
    from sluice.operators import rules

    stage = "claim_id string, patient_id string, provider_id string, procedure_code string, amount decimal(18,2), service_date date"
    spark.createDataFrame([], stage).write.parquet(f"{folder}/s")
    plan = spark.read.schema(stage).parquet(f"{folder}/s").filter(rules.is_target_valid(AS_OF))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull" in plan


@pytest.mark.parametrize("dies_at", [1, 2, 3, 4])
def test_publish_survives_a_dead_driver(spark, folder, monkeypatch, dies_at):
    """The driver dies at the n-th move, with no undo; a re-run whose recount fails loses nothing either."""
    old, new = spark.range(3), spark.range(5)
    outputs = lambda df, n: [P.Output(f"{folder}/a", "x", df, n), P.Output(f"{folder}/b", "y", df, n)]
    P.publish(spark, "L", outputs(old, 3))

    class Dead(BaseException):
        pass

    move, calls = P.rename, []

    def dying(s, a, b):
        calls.append(a)
        if len(calls) >= dies_at:
            raise Dead
        move(s, a, b)

    monkeypatch.setattr(P, "rename", dying)
    with pytest.raises(Dead):
        P.publish(spark, "M", outputs(new, 5))
    monkeypatch.undo()
    # The re-run fails its recount; the earlier rows are still published.
    real = P.Output.check
    monkeypatch.setattr(P.Output, "check", lambda self, path, what: 1 / 0 if what.startswith("recount after") else real(self, path, what))
    with pytest.raises(ZeroDivisionError):
        P.publish(spark, "M", outputs(new, 5))
    assert spark.read.parquet(f"{folder}/a/x").count() == 3 and spark.read.parquet(f"{folder}/b/y").count() == 3
    monkeypatch.undo()
    P.publish(spark, "M", outputs(new, 5))
    assert spark.read.parquet(f"{folder}/a/x").count() == 5 and spark.read.parquet(f"{folder}/b/y").count() == 5
    assert not P.take_back(spark, "M", outputs(new, 5))


def test_a_merge_writes_no_hash_aside_and_a_rerun_no_rejects(spark, folder, monkeypatch):
    tables, written = Tables(folder), []
    for name in ("materialize", "materialize_counted"):
        kept = getattr(M, name)
        monkeypatch.setattr(M, name, lambda df, label, *a, kept=kept, **k: written.append((label, df.columns)) or kept(df, label, *a, **k))
    rows = source(spark, claim(1), claim(2), claim(2, "6.50"), claim(3, "7.50"))
    stage = M.source_checked(rows, AS_OF).drop("rejection_reason").selectExpr(
        "cast(claim_id as string) claim_id", "cast(patient_id as string) patient_id", "cast(null as string) provider_id",
        "diagnosis_code", "procedure_code", "amount", "service_date", "timestamp '2026-01-01' ingested_at",
        "cast(null as string) record_hash", "monotonically_increasing_id() stg_claim_row_id")
    stage = stage.withColumn("provider_id", M.F.expr("if(claim_id = '3', null, '10')"))
    stage.write.parquet(f"{tables.stage}/load_id=L")
    first = M.merge_load(spark, tables, "L", AS_OF, TS)
    assert first == {"rejected_rows": 1, "rejected_total": 2, "upserted_rows": 2}
    assert all("record_hash" not in columns for label, columns in written if label == "judged-stage")
    written.clear()
    assert M.merge_load(spark, tables, "L", AS_OF, TS) == {"rejected_rows": 0, "rejected_total": 2, "upserted_rows": 0}
    assert "rejects" not in [label for label, _ in written]
    kept = spark.read.parquet(tables.rejects).select("claim_id", "rejection_reason", "record_hash").collect()
    assert {(r[0], r[1]) for r in kept} == {("3", "missing provider_id"), ("2", M.DUPLICATE_REASON)} and all(len(r[2]) == 32 for r in kept)


def test_a_load_writes_aside_only_what_is_ranked(spark, folder, monkeypatch):
    """Refused rows were written again beside the passed ones, and the merge shuffled and wrote every staged row, repeated or not (F14)."""
    tables, aside = Tables(folder), {}
    kept = M.materialize_counted
    def counted(df, label, *a, **k):  # noqa: E306
        out = kept(df, label, *a, **k)
        aside[label] = out[0].count()
        return out
    monkeypatch.setattr(M, "materialize_counted", counted)
    rows = source(spark, *[claim(i) for i in range(1, 41)], claim(7, "9.00"), claim(50, "-1.00"), claim(51, "-2.00"))
    got = process_claims(spark, rows, tables, "L", AS_OF, TS)
    assert got["status"] == "SUCCESS", got
    assert (got["source_rows_read"], got["source_rows_quarantined"], got["staged_rows_loaded"], got["target_rows_upserted"]) == (43, 3, 40, 40)
    assert (aside["source-rows"], aside["source-split"], aside["judged-stage"]) == (43, 41, 0)
    reasons = sorted(r.rejection_reason for r in spark.read.parquet(tables.quarantine).collect())
    assert reasons == [M.SOURCE_DUPLICATE, "negative amount", "negative amount"]


def test_a_merge_ranks_the_rows_of_repeated_keys_alone(spark, folder, monkeypatch):
    tables, aside = Tables(folder), {}
    kept = M.materialize_counted
    def counted(df, label, *a, **k):  # noqa: E306
        out = kept(df, label, *a, **k)
        aside[label] = out[0].count()
        return out
    monkeypatch.setattr(M, "materialize_counted", counted)
    stage = spark.range(1, 42).selectExpr(
        "cast(if(id = 41, 7, id) as string) claim_id", "'2' patient_id", "'3' provider_id", "'E11' diagnosis_code", "'99213' procedure_code",
        "cast(id as decimal(18,2)) amount", "date '2025-06-22' service_date", "timestamp '2026-01-01' + make_interval(0, 0, 0, cast(id as int)) ingested_at",
        "cast(null as string) record_hash", "id stg_claim_row_id")
    stage.write.parquet(f"{tables.stage}/load_id=L")
    assert M.merge_load(spark, tables, "L", AS_OF, TS) == {"rejected_rows": 0, "rejected_total": 1, "upserted_rows": 40}
    assert aside["judged-stage"] == 2
    target = P.read_version(spark, tables.target, M.TARGET_SCHEMA).select("claim_id", "amount", "record_hash").collect()
    assert {r[0]: int(r[1]) for r in target} == {str(i): 41 if i == 7 else i for i in range(1, 41)} and all(len(r[2]) == 32 for r in target)
    reject = spark.read.parquet(tables.rejects).first()
    assert (reject.claim_id, reject.stg_claim_row_id, reject.rejection_reason) == ("7", 7, M.DUPLICATE_REASON)
    assert M.merge_load(spark, tables, "L", AS_OF, TS) == {"rejected_rows": 0, "rejected_total": 1, "upserted_rows": 0}
