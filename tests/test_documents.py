import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import documents as D
from sluice.plans.documents import run_documents, run_folder, run_labelled
from sluice.sinks.publish import read_version
from sluice.sources.documents import read_documents

NOTE = """Discharge Summary
Patient Name: Ann O'Hara
MRN: A-17
DOB: 1/2/1970
Sex: Female
Admission Date: 3/4/2020
Discharge Date: 3-9-2020
Visit Date: 3/4/2020
Primary Diagnosis: chest  pain
Attending Physician: Dr. Lee
"""


def docs(spark, *texts):
    rows = [(f"/in/{i}.pdf", f"{i}.pdf", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file_path string, file_name string, text string")


@pytest.mark.parametrize("text,want", [
    ("Hospital Discharge", "discharge_summary"), ("consultation", "consult_note"), ("Progress Note", "progress_note"),
    ("OPERATION PERFORMED", "operative_report"), ("history and physical", "history_and_physical"),
    ("Lab result", "lab_report"), ("lab results", "lab_report"), ("Findings: none", "radiology_report"),
    ("I consent", "consent_form"), ("H&P", None), ("nothing", None), ("consultations", None),
    ("findings and consultation", "consult_note")])
def test_classes(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(D.classify("t")).first()[0] == want
    if text == "H&P":
        assert df.select(D.classify("t", parity=False)).first()[0] == "history_and_physical"


def test_full_record(spark):
    row = D.parse_documents(docs(spark, NOTE), "r", "now").first()
    assert row["patient_name"] == "Ann O'Hara" and row["mrn"] == "A-17" and row["dob"] == "1/2/1970"
    # The first alternative that matches wins, as text is read from the left.
    assert row["sex"] == "Female" and row["admit_date"] == "3/4/2020" and row["discharge_date"] == "3-9-2020"
    assert row["encounter_date"] == "3/4/2020" and row["diagnosis"] == "chest pain" and row["provider"] == "Dr. Lee"
    assert row["confidence_score"] == 1.0 and not row["needs_review"]
    assert row["extraction_method"] == "direct_pdf_text" and row["document_type"] == "discharge_summary"
    assert len(row) == 19


def test_scores_around_the_threshold(spark):
    five = "MRN: 1\nDOB: 1/1/2000\nSex: F\nDiagnosis: x\nProvider: Yo\n"
    rows = D.parse_documents(docs(spark, five, "Progress Note\n" + five, "", "Diagnosis:  "), "r", "now").orderBy("file_name").collect()
    assert [(r["confidence_score"], r["needs_review"]) for r in rows] == [
        (0.56, True), (0.66, False), (0.0, True), (0.0, True)]
    assert rows[3]["diagnosis"] == "" or rows[3]["diagnosis"] is None
    queue = D.review_queue(D.parse_documents(docs(spark, five), "r", "now"), "then").first()
    assert queue["reason"] == "Low confidence score: 0.56"
    assert json.loads(queue["payload"])["parsed_document"]["mrn"] == "1"


def test_fallback_text(spark):
    df = docs(spark, "short", "x" * 100).withColumn("scan", F.lit("Progress Note from the scan"))
    rows = D.parse_documents(df, "r", "now", fallback_text="scan").orderBy("file_name").collect()
    assert [(r["extraction_method"], r["document_type"]) for r in rows] == [
        ("ocr_fallback", "progress_note"), ("direct_pdf_text", None)]
    assert D.parse_documents(docs(spark, "short"), "r", "n").first()["extraction_method"] == "direct_pdf_text_weak"


def test_labelled_variant(spark):
    rows = D.parse_labelled(docs(spark, "Document Type: Consult Note\nName: Al Bo\n", "intro\nOperative Report\nx", "x")).orderBy("file_name").collect()
    # The label pattern takes letters, blanks, slashes and hyphens up to the line end.
    assert rows[0]["document_type"] == "Consult Note" and rows[0]["patient_name"].startswith("Al Bo")
    assert rows[1]["document_type"] == "Operative Report"
    assert rows[2]["document_type"] is None
    assert rows[2]["extraction_method"] == "direct_pdf_text_failed_no_ocr"


def test_run_twice(spark, folder):
    df = docs(spark, NOTE, "weak", None)
    schema = D.parse_documents(df, "r", "n").schema
    for run in ("r1", "r2"):
        got = run_documents(spark, df, f"{folder}/out", run, "now", target=f"{folder}/target")
        assert (got["succeeded"], got["failed"], got["review_needed"], got["upserted"]) == (2, 1, 1, 2)
    assert {r["run_id"] for r in read_version(spark, f"{folder}/target", schema).collect()} == {"r2"}
    assert spark.read.json(f"{folder}/out/quarantine/r1").count() == 2
    summary = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        f"{folder}/out/summaries/run_r1_summary")
    assert len(summary.columns) == 19 and summary.count() == 2
    record = spark.read.json(f"{folder}/out/parsed_json/r1").filter("file_name = '0.pdf'").first()
    assert record["full_text"].startswith("Discharge Summary")
    assert run_documents(spark, df.limit(0), f"{folder}/none", "r", "now")["succeeded"] == 0


def test_folder_scan(spark, tmp_path, folder):
    (tmp_path / "a.txt").write_text(NOTE)
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe broken")
    (tmp_path / "c.csv").write_text("no")
    got = {r["file_name"]: r["text"] for r in read_documents(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == NOTE and got["b.txt"] is None and len(got) == 2
    out = run_folder(spark, str(tmp_path), f"{folder}/o", "r", "now")
    assert (out["succeeded"], out["failed"]) == (1, 1)
    run_labelled(read_documents(spark, str(tmp_path)), f"{folder}/labelled")
    assert spark.read.json(f"{folder}/labelled").first()["parsed_fields"]["mrn"] == "A-17"
    assert spark.read.json(f"{folder}/labelled_failures").first()["file_name"] == "b.txt"


def test_only_wanted_columns_are_parsed(spark):
    def plan(*columns):
        return D.parse_documents(docs(spark, NOTE), "r", "n", columns=columns)._jdf.queryExecution().optimizedPlan().toString()

    assert "Medical Record Number" not in plan("document_type") and "discharge summary" in plan("document_type")
    assert "Medical Record Number" in plan("mrn") and "discharge summary" not in plan("mrn")
    assert "inline" not in plan("document_id", "run_id") and "Medical Record Number" in plan("needs_review")


def test_filters_do_not_repeat_the_patterns(spark):
    plan = D.review_queue(D.parse_documents(docs(spark, NOTE), "r", "n"), "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Medical Record Number") == 1


def test_a_run_writes_each_document_once_and_packs_its_archives(spark, folder, monkeypatch):
    from pathlib import Path

    from sluice.plans import documents as plan
    written, kept = [], plan.materialize
    monkeypatch.setattr(plan, "materialize", lambda df, label, *a: written.append((label, set(df.columns))) or kept(df, label, *a))
    df = spark.createDataFrame([("n/1.txt", "1.txt", "Patient Name: Pat Low\nMRN: 5"), ("n/2.txt", "2.txt", None)], "file_path string, file_name string, text string")
    got = run_documents(spark, df, f"{folder}/out", "r", "now", target=f"{folder}/target")
    assert got == {"run_id": "r", "succeeded": 1, "failed": 1, "review_needed": 1, "upserted": 1}
    assert [label for label, _ in written] == ["parsed-documents"] and not {"document_id", "raw_text_preview"} & written[0][1]
    assert list(Path(folder, "out/parsed_json/r").glob("*.json.gz")) and list(Path(folder, "out/summaries").rglob("*.csv.gz"))
    record = spark.read.json(f"{folder}/out/parsed_json/r").first()
    assert record.raw_text_preview == record.full_text and len(record.document_id) == 64
    assert {r.file_name: r.reason[:10] for r in spark.read.json(f"{folder}/out/quarantine/r").collect()} == {"1.txt": "Low confid", "2.txt": "Processing"}


def test_text_is_normalised_once(spark):
    """A strip looks at its text several times; the normalising patterns must not run again for each look (F18)."""
    for parsed in (D.parse_documents(docs(spark, NOTE), "r", "n"), D.parse_labelled(docs(spark, NOTE))):
        plan = parsed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == 2
