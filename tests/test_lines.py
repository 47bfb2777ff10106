import csv
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import structural
from sluice.sources.lines import first_line, read_lines

HEADER = ["provider_id", "claim_amount", "claim_id", "service_date", "patient_id", "procedure_code", "diagnosis_code"]


def write(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_golden_reasons(spark):
    rows = [
        ('9031,"68.16,300017.0,2025-06-22,74925,80050,R51', "broken quoted row"),
        ("5198,1076.86,300098.0,2025-08-22,15258", "row has too few columns"),
        ("3356,778.22,300251.0,2025-06-20,12049,36415,I10,EXTRA_FIELD", "row has extra columns"),
        ("", "empty row"), (" \t", "empty row"), ("a\0,b,c,d,e,f,g", "unparseable row"),
        ("x" * 131073 + ",b,c,d,e,f,g", "unparseable row"), ("1,2,3,4,5,6,7", None), (',,,,,,', None),
        ('"a,b",2,3,4,5,6,7\r', None),
    ]
    df = structural.check_lines(spark.createDataFrame(rows, "raw_row string, want string"), 7)
    for r in df.collect():
        assert r["reason"] == r["want"], r["raw_row"][:40]


def test_fields_agree_with_a_csv_reader(spark):
    rng = random.Random(7)
    lines = set()
    while len(lines) < 4000:
        line = "".join(rng.choice('ab ",') for _ in range(rng.randint(1, 14)))
        if line.count('"') % 2 == 0 and line.strip():
            lines.add(line)
    df = spark.createDataFrame([(x,) for x in lines], "raw_row string")
    for r in df.select("raw_row", structural.split_fields("raw_row").alias("f")).collect():
        assert r["f"] == next(csv.reader([r["raw_row"]])), r["raw_row"]


def test_line_numbers_over_many_splits(spark, tmp_path):
    body = {f"f{k}.csv": [f"{k}-{i}" if i % 7 else "" for i in range(1, 2001 + k)] for k in range(3)}
    for name, lines in body.items():
        write(tmp_path / name, "\n".join(lines) + ("" if name == "f1.csv" else "\n"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {}
    for r in got:
        by_file.setdefault(r["file"].rsplit("/", 1)[1], {})[r["line_number"]] = r["raw_row"]
    for name, lines in body.items():
        assert [by_file[name][i + 1] for i in range(len(lines))] == lines
    assert [(r["file"][-6:], r["line_number"]) for r in got if r["truncated"]] == [("f1.csv", 2001)]
    assert sorted(r["row_no"] for r in got) == list(range(1, len(got) + 1))


@pytest.mark.parametrize("text,cut", [
    ("a\nb\n", False), ("a\nb", True), ("a\n\n", False), ("﻿a\nb", True), ("﻿a\nb\n", False),
    ("hé\nb\r\n", False), ("a", True)])
def test_cut_off_last_line(spark, tmp_path, text, cut):
    path = write(tmp_path / "x.csv", text)
    assert [r["truncated"] for r in read_lines(spark, path).collect() if r["truncated"]] == ([True] if cut else [])


def test_truncated_row_is_an_additional_record(spark, tmp_path):
    last = '9999,100.5,399999,2025-12-31,12345,99213,"E11'
    path = write(tmp_path / "x.csv", "1,2,3,4,5,6,7\n" + last)
    _, bad = structural.structural_split(read_lines(spark, path), HEADER)
    assert sorted((r["line_number"], r["reason"]) for r in bad.collect()) == [
        (2, "broken quoted row"), (2, "truncated final row")]
    path = write(tmp_path / "y.csv", "1,2,3,4,5,6,7\n1,2,3,4,5,6,8")
    lines = read_lines(spark, path)
    assert structural.structural_split(lines, HEADER, keep_truncated=False)[0].count() == 1
    assert structural.structural_split(lines, HEADER)[0].count() == 2


def test_first_line(spark, tmp_path):
    write(tmp_path / "a.csv", "")
    write(tmp_path / "b.csv", "h1,h2\n1,2\n")
    assert first_line(spark, str(tmp_path)) == "h1,h2"
    with pytest.raises(ValueError, match="empty"):
        first_line(spark, str(tmp_path / "a.csv"))


def test_clean_keeps_empty_fields(spark):
    df = spark.createDataFrame([("1,,3,4,5,6,",)], "raw_row string")
    clean, _ = structural.structural_split(df, HEADER)
    row = clean.first()
    assert row["claim_amount"] == "" and row["diagnosis_code"] == ""
    assert clean.filter(F.col("claim_amount").isNull()).count() == 0


def test_a_line_load_judges_its_rows_once(spark, folder, monkeypatch):
    from pathlib import Path

    from sluice.plans import claims as plan
    written = []
    for name in ("materialize", "materialize_counted"):
        kept = getattr(plan, name)
        monkeypatch.setattr(plan, name, lambda df, label, *a, kept=kept, **k: written.append((label, set(df.columns))) or kept(df, label, *a, **k))
    lines = ["provider_id,claim_amount,claim_id,service_date,patient_id,procedure_code,diagnosis_code",
             "7,5.50,1,2025-06-22,9,99213,E11", "7,5.50,2,2025-06-22,9,99213,E11", "7,6.50,2,2025-06-22,9,99213,E11", "7,-1,3,2025-06-22,9,99213,E11", "short,1"]
    Path(folder, "in.csv").write_text("\n".join(lines) + "\n")
    got = plan.load_claims_lines(spark, f"{folder}/in.csv", f"{folder}/stage", f"{folder}/archive", "L", "2025-12-31", "2026-01-01 00:00:00", count_rules=True)
    assert (got["rows_loaded"], got["business_bad"], got["structurally_bad"]) == (1, 3, 1)
    assert got["rules"] == {"duplicate claim_id": 2, "negative claim_amount": 1}
    assert [label for label, _ in written] == ["claim-lines", "checked-claims"]
    assert "reasons" in written[1][1] and "raw_row" not in written[1][1]
