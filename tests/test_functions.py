import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions import coerce as K
from sluice.functions import hashing, paths
from sluice.functions.text import first_capture, is_blank, normalize_text, strip
from sluice.operators.analysis import row_text


def one(spark, text, make, kind="string"):
    df = spark.createDataFrame([(text,)], f"c {kind}")
    return df.select(make("c").alias("r")).first()["r"]


@pytest.mark.parametrize("text", ["  a b ", "\ta\r\n", " x ", "\x1cq\x1f", "　", "", "plain", "\x0b\x85z"])
def test_strip_is_python_strip(spark, text):
    assert one(spark, text, strip) == text.strip()
    assert one(spark, text, is_blank) == (text.strip() == "")


@pytest.mark.parametrize("text,want", [
    ("12.5", 12.5), (" 7 ", 7.0), ("+3", 3.0), ("-.5", -0.5), ("1e3", 1000.0), ("5.", 5.0),
    ("1d", None), ("nan", None), ("inf", None), ("1e999", None), ("UNK", None), ("", None),
    ("1,000", None), ("0x10", None), (None, None), ("None", None)])
def test_to_number(spark, text, want):
    assert one(spark, text, K.to_number) == want


@pytest.mark.parametrize("text,want", [
    ("300017.0", 300017), ("300017", 300017), ("1.5", None), (" 42 ", 42), ("UNK", None), ("3e2", 300),
    ("9007199254740993", 9007199254740993), ("99999999999999999999", None), (None, None), ("-4", -4)])
def test_to_whole(spark, text, want):
    assert one(spark, text, K.to_whole) == want


@pytest.mark.parametrize("text,want", [
    ("123", 123), (" 123 ", 123), ("123.0", None), ("-1", None), ("", None), (None, None), ("12a", None)])
def test_digits(spark, text, want):
    assert one(spark, text, K.to_digits) == want
    assert one(spark, text, K.is_digits) == (want is not None)


@pytest.mark.parametrize("text,want", [
    ("2025-06-22", dt.date(2025, 6, 22)), ("2025/06/22", dt.date(2025, 6, 22)),
    ("06/22/2025", dt.date(2025, 6, 22)), ("6/2/2025", dt.date(2025, 6, 2)), ("6-22-2025", dt.date(2025, 6, 22)),
    ("2025-06-22 10:15:00", dt.date(2025, 6, 22)), ("2025-06-22T10:15", dt.date(2025, 6, 22)),
    ("2025-02-30", None), ("bad-date", None), ("2025", None), ("2025-06-22 junk", None), ("13/40/2025", None),
    ("", None), (None, None), ("2025-6-1xx", None)])
def test_to_day(spark, text, want):
    assert one(spark, text, K.to_day) == want


def test_amount_rounds_half_up_on_the_shown_digits(spark):
    assert one(spark, 1.005, K.to_amount, "double") == Decimal("1.01")
    assert one(spark, "1.005", K.to_amount) == Decimal("1.01")
    assert one(spark, "x", K.to_amount) is None


def test_missing_tokens(spark):
    for text in ["", "NA", "N/A", "null", "NaN", "<NA>", "None"]:
        assert one(spark, text, K.missing_to_null) is None
    assert one(spark, "UNK", K.missing_to_null) == "UNK"


def test_captures(spark):
    assert one(spark, "x mrn:  A-1 z", lambda c: first_capture(c, r"(?:MRN)[:\s#]+([A-Za-z0-9\-]+)")) == "A-1"
    assert one(spark, "none", lambda c: first_capture(c, "MRN: (.+)")) is None
    # only a line feed ends a line
    assert one(spark, "Diagnosis: a b\nc", lambda c: first_capture(c, r"Diagnosis[:\s]+(.+)")) == "a b"


def test_normalize(spark):
    assert one(spark, "  a \t b\r\n\r\nc\n\n\nd ", normalize_text) == "a b\nc\nd"


def test_hash_collides_on_nulls_unless_marked(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = {r[0] for r in df.select(hashing.record_hash(["x", "y", "z"])).collect()}
    marked = {r[0] for r in df.select(hashing.record_hash(["x", "y", "z"], "~")).collect()}
    assert len(plain) == 1 and len(marked) == 2


def test_paths(spark):
    key = "success_split_files/2e37-4eg7-ad_Prog-X-C_split_file_20250112_121021.csv"
    df = spark.createDataFrame([(key,), ("plain.csv",)], "k string")
    name = paths.object_name("k")
    rows = df.select(paths.folder_name("k"), paths.program_name(name), paths.leading_id(name),
                     paths.id_and_program(name), paths.delimiter("k")).collect()
    assert tuple(rows[0]) == (
        "success_split_files", "Prog-X-C", "2e37-4eg7-ad",
        "2e37-4eg7-ad_Prog-X-C", "|")
    assert tuple(rows[1]) == (None, None, "plain", None, ",")


def test_row_text(spark):
    df = spark.createDataFrame([(["a", None, "c"],)], "v array<string>")
    assert df.select(row_text("v")).first()[0] == "a,nan,c"
    assert df.select(F.size("v")).first()[0] == 3


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_integer_cleanup_tests_each_column_once(spark):
    from sluice.operators import rules

    df = spark.createDataFrame([(" 1 ", "2", "3", "4"), ("1.0", "2", "3", "4"), ("1", None, "3", "4")], "claim_id string, patient_id string, provider_id string, procedure_code string")
    good, bad = rules.integer_cleanup(df)
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3, 4)] and bad.count() == 2 and bad.columns == good.columns == df.columns
    assert _optimized(good).count("RLIKE") == 4


def test_labelled_fields_run_each_pattern_once(spark):
    from sluice.operators import documents as D

    df = spark.createDataFrame([("a", "Patient Name: Pat Low\nMRN: 5"), ("b", "Name: Jo"), ("c", "Consult Note\n")], "file_name string, text string")
    parsed = D.parse_labelled(df)
    assert {r.file_name: (r.patient_name, r.mrn, r.document_type) for r in parsed.collect()} == {
        "a": ("Pat Low", "5", None), "b": ("Jo", None, None), "c": (None, None, "Consult Note")}
    assert _optimized(parsed).count("regexp_extract(") == sum(len(p) for p in D.LABELLED_PATTERNS.values())
