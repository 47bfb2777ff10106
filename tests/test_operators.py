import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import analysis, audit, dedupe, merge, quarantine, rules, schema
from sluice.plans.patients import split_patients
from sluice.sources.documents import join_pages
from sluice.sources.nested import flatten, records
from sluice.sources.tables import jdbc_options

AS_OF = "2025-06-30"


# -- schema -----------------------------------------------------------------

def test_schema_policies():
    schema.check_names(["a", "b"], ["b", "a"], "set")
    with pytest.raises(ValueError, match="drift"):
        schema.check_names(["a", "b"], ["b", "a"], "ordered")
    with pytest.raises(ValueError, match=r"missing \['b'\], unexpected \['c'\]"):
        schema.check_names(["a", "c"], ["a", "b"], "set")
    with pytest.raises(ValueError):
        schema.check_names(["a", "a", "b"], ["a", "b"], "set")


def test_constraints(spark):
    df = spark.createDataFrame([(1, "x"), (1, "yy"), (None, "x"), (None, "x")], "k int, v string")
    assert [tuple(r) for r in schema.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        schema.assert_unique(df, ["k"])
    with pytest.raises(ValueError):
        schema.assert_not_null(df, ["k", "v"])
    with pytest.raises(ValueError):
        schema.assert_widths(df, {"v": 1})
    parents = spark.createDataFrame([(2,)], "id int")
    assert schema.orphans(df, parents, "k", "id").count() == 2
    with pytest.raises(ValueError):
        schema.assert_no_orphans(df, parents, "k", "id")


# -- rules ------------------------------------------------------------------

CASES = [
    # claim, provider, amount, date, patient, code, diagnosis -> reasons numeric, strict
    (("1", "10", "5", "2025-01-01", "7", "99213", "E11"), [], []),
    (("2", "10", "0", "2025-06-30", "7", "99213", ""), [], []),
    (("3", "10", "-1", "2025-01-01", "7", "99213", "E11"), ["negative claim_amount"], ["negative claim_amount"]),
    (("4", "10", "5", "2025-07-01", "7", "99213", "E11"), ["future service_date"], ["future service_date"]),
    (("5", "10", "5", "soon", "7", "99213", "E11"),
     ["missing required fields", "malformed service_date"], ["missing required fields", "malformed service_date"]),
    (("6", "10", "5", "2025-01-01", "UNK", "99213", "E11"),
     ["missing required fields", "invalid patient_id"], ["missing required fields", "invalid patient_id"]),
    (("7.0", "10", "5", "2025-01-01", "7", "99213", "E11"), [], ["missing required fields", "invalid claim_id"]),
    (("8", "1.5", "5", "2025-01-01", "7", "99213", "E11"),
     ["invalid provider_id"], ["missing required fields", "invalid provider_id"]),
    (("9", "10", "5", "2025-01-01", "7", "11111", "E11"), ["invalid procedure_code"], ["invalid procedure_code"]),
    (("10", "10", "5", "2025-01-01", "7", "None", "E11"),
     ["missing required fields", "invalid procedure_code"], ["missing required fields", "invalid procedure_code"]),
    (("11", "10", "5", "2025-01-01", "7", "99213", "E11"), ["duplicate claim_id"], ["duplicate claim_id"]),
    (("11", "10", "-5", "2025-01-01", "7", "99213", "E11"),
     ["duplicate claim_id", "negative claim_amount"], ["duplicate claim_id", "negative claim_amount"]),
]


@pytest.mark.parametrize("integers", ["numeric", "strict"])
def test_claim_rules(spark, integers):
    names = ["claim_id", "provider_id", "claim_amount", "service_date", "patient_id", "procedure_code", "diagnosis_code"]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(CASES)], "n int, " + ", ".join(f"{c} string" for c in names))
    typed = dedupe.flag_duplicates(rules.type_claims(df, integers), ["claim_id"])
    out = typed.withColumn("reasons", rules.broken_names(rules.claim_rules(AS_OF, integers)))
    for r in out.collect():
        assert r["reasons"] == CASES[r["n"]][1 if integers == "numeric" else 2], CASES[r["n"]]
    clean, bad = rules.split_by_reasons(out)
    assert clean.count() + bad.count() == len(CASES)
    counts = {r["reason"]: r["row_count"] for r in rules.rule_counts(bad).collect()}
    assert counts["duplicate claim_id"] == 2


def test_source_rules_and_target_chain(spark):
    rows = [("1", "2", "3", None, " ", -1.0, "2025-01-01"), (None, "2", "3", "D", "99201", None, "2099-01-01")]
    df = spark.createDataFrame(rows, "claim_id string, patient_id string, provider_id string, diagnosis_code string, "
                               "procedure_code string, amount double, service_date string")
    typed = rules.type_source(df)
    got = typed.select(rules.joined_reasons(rules.broken_names(rules.source_rules(AS_OF)))).collect()
    assert [r[0] for r in got] == [
        "missing procedure_code; negative amount",
        "missing claim_id; missing amount; future service_date"]
    chain = [r[0] for r in typed.select(rules.target_reason(AS_OF)).collect()]
    assert chain == ["invalid procedure_code", "missing claim_id"]


def test_codes_alone_do_not_reject(spark):
    df = spark.createDataFrame([("1", "2", "3", "D", "77777", 1.0, "2025-01-01")],
                               "claim_id string, patient_id string, provider_id string, diagnosis_code string, "
                               "procedure_code string, amount double, service_date string")
    typed = rules.type_source(df)
    assert typed.filter(rules.is_target_valid(AS_OF)).count() == 1
    assert typed.filter(rules.is_target_valid(AS_OF, enforce_codes=True)).count() == 0


def test_code_table_both_ways(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    codes = spark.createDataFrame([("a",), (None,)], "code string")
    for limit in (10, 0):
        got = rules.not_in_table(df, "c", codes, "code", max_broadcast=limit)
        assert Counter(r["c"] for r in got.collect()) == Counter(["b", None])


def test_integer_cleanup(spark):
    df = spark.createDataFrame([("1", "2"), ("1.0", "2"), (None, "3"), (" 4 ", "5")], "a string, b string")
    good, bad = rules.integer_cleanup(df, ["a", "b"])
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2), (4, 5)]
    assert bad.count() == 2


# -- duplicates -------------------------------------------------------------

def test_flag_duplicates_hot_and_cold(spark):
    keys = ["hot"] * 300 + [None] * 200 + ["twice"] * 2 + [f"k{i}" for i in range(100)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(6)
    counts = Counter(keys)
    for hot_rows in (1, 100, 10**9):
        got = dedupe.flag_duplicates(df, ["k"], hot_rows=hot_rows).collect()
        assert len(got) == len(keys)
        assert all(r["is_duplicate"] == (counts[r["k"]] > 1) for r in got)
    for limit in (0, 10**6):
        got = dedupe.flag_duplicates_sized(df, ["k"], max_broadcast=limit).collect()
        assert len(got) == len(keys) and all(r["is_duplicate"] == (counts[r["k"]] > 1) for r in got)


def test_rows_without_known_key(spark):
    from sluice.operators.lookup import rows_without
    keys = ["UNK"] * 300 + ["ok"] * 300 + [None] * 3 + ["x"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    known = spark.createDataFrame([("ok",), ("other",)], "k string")
    for hot_rows in (1, 10**9):
        got = Counter(r["k"] for r in rows_without(df, ["k"], known, hot_rows).collect())
        assert got == Counter({"UNK": 300, None: 3, "x": 1})


def test_hot_rows_are_spread(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("i")).repartition(8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = dedupe.flag_duplicates(df, ["k"], hot_rows=10)
        per_task = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_task) == 4000
    assert max(r["count"] for r in per_task) < 4000


def test_mark_first_keeps_every_row(spark):
    rows = [("a", 1, 10), ("a", 3, 11), ("a", None, 12), ("b", 1, 13), ("b", 1, 14), (None, 5, 15)]
    df = spark.createDataFrame(rows, "k string, t int, row_id long")
    got = {r["row_id"]: r["is_first"] for r in dedupe.mark_first(df, ["k"], [("t", "desc")]).collect()}
    assert got == {10: False, 11: False, 12: True, 13: True, 14: False, 15: True}
    assert {r["row_id"] for r in dedupe.keep_first(df, ["k"], [("t", "asc"), ("row_id", "asc")]).collect()} == {10, 13, 15}


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.keep_first(df, ["k"], [("id", "desc")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_patients(spark):
    rows = [(101, "John", "1990-01-01", "2024-01-01"), (101, "John", "1990-01-01", "2024-02-01"),
            (102, "Mary", "1985-05-05", "2024-01-15"), (103, None, "1970-07-07", "2024-01-20")]
    df = spark.createDataFrame(rows, "patient_id long, name string, dob string, updated_at string")
    valid, invalid = split_patients(df)
    assert sorted((r["patient_id"], r["updated_at"]) for r in valid.collect()) == [
        (101, "2024-02-01"), (102, "2024-01-15")]
    assert [r["patient_id"] for r in invalid.collect()] == [103]


# -- merge ------------------------------------------------------------------

def test_upsert_policies(spark):
    cols = "claim_id string, amount int, record_hash string, ingested_at string"
    target = spark.createDataFrame([("same", 1, "h", "t0"), ("diff", 1, "h", "t0"), ("null", 1, None, "t0"), ("old", 1, "h", "t0")], cols)
    source = spark.createDataFrame([("same", 2, "h", "t1"), ("diff", 2, "g", "t1"), ("null", 2, "g", "t1"), ("new", 2, "h", "t1")], cols)

    def actions(policy):
        rows = merge.upsert(target, source, policy=policy, stamp="now").collect()
        return {r["claim_id"]: (r["action"], r["amount"], r["ingested_at"]) for r in rows}

    assert actions("null_safe") == {
        "same": ("unchanged", 1, "t0"), "diff": ("update", 2, "now"), "null": ("update", 2, "now"),
        "old": ("kept", 1, "t0"), "new": ("insert", 2, "now")}
    assert actions("strict")["null"] == ("unchanged", 1, "t0")
    assert actions("always")["same"] == ("update", 2, "now")
    counts = {r["action"]: r["row_count"] for r in merge.action_counts(merge.upsert(target, source)).collect()}
    assert counts == {"unchanged": 1, "update": 2, "kept": 1, "insert": 1}
    with pytest.raises(ValueError):
        merge.upsert(target, source, policy="other")


def test_insert_ignore(spark):
    old = spark.createDataFrame([(1, "x"), (None, "x")], "id long, why string")
    new = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x"), (None, "x"), (None, "x")], "id long, why string")
    got = Counter(tuple(r) for r in merge.insert_ignore(old, new, ["id", "why"]).collect())
    assert got == Counter({(1, "y"): 1, (2, "x"): 1, (None, "x"): 2})


# -- audit, quarantine, analysis --------------------------------------------

def test_audit_counts_a_replay_once(spark):
    at = "2025-01-01 00:00:00"
    events = [
        audit.started("L", "p", at), audit.progress("L", "p", at, 0, source_rows_read=5, staged_rows_loaded=4),
        audit.progress("L", "p", at, 0, source_rows_read=5, staged_rows_loaded=4),
        audit.progress("L", "p", at, 1, source_rows_read=2, staged_rows_loaded=2),
        audit.succeeded("L", "p", at, 1, 3), audit.reconciled("L", "p", at, "MISMATCH"),
        audit.started("M", "p", at), audit.failed("M", "p", at, "x" * 5000)]
    rows = {r["load_id"]: r for r in audit.latest_state(audit.events_frame(spark, events)).collect()}
    assert rows["L"]["source_rows_read"] == 7 and rows["L"]["target_rows_upserted"] == 3
    assert (rows["L"]["status"], rows["L"]["reconciliation_status"]) == ("SUCCESS", "MISMATCH")
    assert rows["M"]["status"] == "FAILED" and len(rows["M"]["error_message"]) == 4000
    assert rows["M"]["reconciliation_status"] == "PENDING"
    with pytest.raises(ValueError):
        audit.check_batch(2, 1)


def test_payload_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 3, "D", "9", None, dt.date(2025, 1, 1), "why")],
                               "claim_id long, patient_id long, provider_id long, diagnosis_code string, "
                               "procedure_code string, amount decimal(18,2), service_date date, rejection_reason string")
    row = quarantine.quarantine_rows(df, "L", "2025-01-01").first()
    assert row["source_row_payload"] == (
        '{"claim_id":1,"patient_id":null,"provider_id":3,"diagnosis_code":"D","procedure_code":"9",'
        '"amount":null,"service_date":"2025-01-01","rejection_reason":"why"}')


def test_analyses(spark):
    sales = spark.createDataFrame([("A", 100), ("B", 200), ("A", 150), (None, 1), ("C", None)], "product string, amount long")
    assert {tuple(r) for r in analysis.sum_by(sales, "product", "amount", "amount").collect()} == {("A", 250), ("B", 200), ("C", 0)}
    users = spark.createDataFrame([(1, 100), (1, -50), (2, 200), (1, 100)], "user_id long, amount long")
    assert [tuple(r) for r in analysis.positive_totals(users).collect()] == [(1, 200), (2, 200)]
    nested = records(spark, [
        (1, [(100, "completed"), (-50, "failed"), (200, "completed")]), (2, [(300, "completed"), (None, "completed")]),
        (1, [(50, "completed")]), (3, [])])
    assert [tuple(r) for r in analysis.nested_totals(nested).collect()] == [(2, 300), (1, 350)]
    assert flatten(nested).count() == 6
    lines = spark.createDataFrame([(1, 10, 2), (2, 5, 4), (3, 8, 1)], "id long, price long, quantity long")
    assert [tuple(r) for r in analysis.line_totals(lines).orderBy("id").collect()] == [(1, 20), (2, 20), (3, 8)]
    numbers = spark.createDataFrame([(n,) for n in [1, 2, 3, 4, 5, 6, -2]], "n long")
    assert sorted(r["n"] for r in analysis.even(numbers).collect()) == [-2, 2, 4, 6]


def test_on_date_is_a_range(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 28),), (dt.date(2025, 3, 29),), (dt.date(2024, 3, 28),)], "service_date date")
    assert analysis.on_date(df, 2025, 3, 28).count() == 1
    assert analysis.on_date(df, 2025, 3).count() == 2
    assert analysis.on_date(df, 2025).count() == 2
    assert analysis.on_date(df, None, 3, 28).count() == 2
    plan = analysis.on_date(df, 2025, 3, 28)._jdf.queryExecution().optimizedPlan().toString()
    assert "year(" not in plan and "cast(service_date" not in plan


def test_pages_in_order_over_chunks(spark):
    pages = [("d", i, f"p{i}") for i in range(25)] + [("e", 1, None), ("e", 2, "x")]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, text string").repartition(5)
    got = {r["doc_id"]: r["text"] for r in join_pages(df, pages_per_chunk=4).collect()}
    assert got == {"d": "\n".join(f"p{i}" for i in range(25)), "e": "x"}


def test_empty_input(spark):
    from sluice.sources.delimited import require_rows
    assert require_rows(spark.range(1)).count() == 1
    with pytest.raises(ValueError, match="empty"):
        require_rows(spark.range(0))


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "claims", ["a", "b"], "a", 1, 100, 8)
    assert got["dbtable"] == "(select a, b from claims) source_rows" and got["numPartitions"] == "8"


def test_mark_first_spreads_hot_keys(spark):
    rows = [(k, t, i) for i, (k, t) in enumerate([("a", n % 7) for n in range(40)] + [("b", 1), ("b", 2), (None, 1), (None, 3), ("c", None)])]
    df = spark.createDataFrame(rows, "k string, t int, row_id long")
    plain = dedupe.mark_first(df, ["k"], [("t", "desc")])
    hot = dedupe.mark_first(df, ["k"], [("t", "desc")], hot_rows=10)
    want = {6, 41, 43, 44}
    assert {r.row_id for r in plain.collect() if r.is_first} == want
    assert {r.row_id for r in hot.collect() if r.is_first} == want and hot.columns == plain.columns and hot.count() == 45
    # The rows of the hot key meet in no task: the window is by key and spread.
    assert "_spread" in hot._jdf.queryExecution().executedPlan().toString()


def test_the_reason_of_a_row_is_compiled_and_its_conversions_stay_small(spark):
    """A lambda in the reasons, or one method for all conversions, is interpreted for every row (F6, F13, F14, F19)."""
    from sluice.plans.migration import source_checked

    rows = spark.createDataFrame(
        [("1", "2", "3", None, "99213", 5.0, "2025-01-01"), ("1.5", " 7 ", None, "D", " ", -1.0, "bad")],
        "claim_id string, patient_id string, provider_id string, diagnosis_code string, procedure_code string, amount double, service_date string")
    checked = source_checked(rows, "2025-12-31")
    assert "lambda" not in checked._jdf.queryExecution().executedPlan().toString()
    steps = checked._jdf.queryExecution().debug().codegenToSeq()
    assert max(steps.apply(i)._3().maxMethodCodeSize() for i in range(steps.size())) < 8000
    both = rules.type_source(rows)
    checks = rules.source_rules("2025-12-31")
    for r in both.select(rules.reasons_text(checks), rules.joined_reasons(rules.broken_names(checks))).collect():
        assert r[0] == r[1]
    assert [r.rejection_reason for r in checked.collect()] == [None, "missing claim_id; missing provider_id; missing procedure_code; negative amount; missing/invalid service_date"]


def test_insert_ignore_compares_in_one_aggregate(spark):
    """A distinct, two sorts and a join held four copies of a task's rows (F12)."""
    old = spark.createDataFrame([(1, "a")], "id long, why string")
    new = spark.createDataFrame([(1, "a", "x", 1), (2, "a", "y", 2), (2, "a", "z", 3), (None, "a", "n", 4)], "id long, why string, text string, n long")
    got = merge.insert_ignore(old, new, ["id", "why"])
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert len(rows) == 2 and rows[0][0] in (2, None) and {r[2:] for r in rows if r[0] == 2} <= {("y", 2), ("z", 3)}


def test_the_hash_is_made_after_the_shuffle(spark):
    from sluice.catalog import QUERIES

    plan = QUERIES["dup_keep_first"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # The plan is a tree: what is made after the shuffle stands above it.
    assert plan.index("md5(") < plan.index("RepartitionByExpression")


def test_rows_of_repeated_keys_are_parted(spark):
    df = spark.createDataFrame([(i, None if i in (3, 4) else f"k{min(i, 98)}") for i in range(100)], "row_id int, k string")
    single, shared = dedupe.part_repeated(df, ["k"])
    assert {r.row_id for r in shared.collect()} == {3, 4, 98, 99}
    assert sorted(r.row_id for r in single.collect()) == [i for i in range(98) if i not in (3, 4)]
    # Many repeated keys, by share or by number, are left to the ranking of all rows.
    for few in ({"share": 0.01}, {"max_broadcast": 1}):
        single, shared = dedupe.part_repeated(df, ["k"], **few)
        assert single is None and shared.count() == 100
    single, shared = dedupe.part_repeated(df.filter("row_id < 3"), ["k"])
    assert (single.count(), shared.count()) == (3, 0)
    single, shared = dedupe.part_repeated(df.filter("row_id < 0"), ["k"])
    assert (single.count(), shared.count()) == (0, 0)
