"""Row rules: named predicates, reasons per row, and the clean/bad split.

A rule set runs in one narrow pass.  A predicate that is null counts as not
broken, so rules on missing values say so themselves.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions import coerce as K
from sluice.functions.text import column, strip
from sluice.model import (
    CLAIM_COLUMNS_LINES, FILE_PROCEDURE_CODES, INTEGER_COLUMNS, REASON_WIDTH,
    TARGET_PROCEDURE_CODES,
)
from sluice.operators.lookup import rows_without
from sluice.operators.once import compute_in_steps, compute_once


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column


def broken_names(rules) -> Column:
    """Array of the names of all broken rules, in rule order."""
    return F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules]))


def first_broken(rules, default=None) -> Column:
    """Name of the first broken rule."""
    chain = F.when(rules[0].broken, rules[0].name)
    for rule in rules[1:]:
        chain = chain.when(rule.broken, rule.name)
    return chain.otherwise(default) if default is not None else chain


def joined_reasons(reasons="reasons") -> Column:
    """All reasons joined by ``; ``; null when there is none."""
    return F.when(F.size(column(reasons)) > 0, F.array_join(column(reasons), "; "))


def reasons_text(rules) -> Column:
    """``joined_reasons(broken_names(rules))`` without the array, whose compaction is interpreted for every row."""
    return F.nullif(F.concat_ws("; ", *[F.when(r.broken, F.lit(r.name)) for r in rules]), F.lit(""))


def any_missing(columns) -> Column:
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return test


def not_allowed(c, codes) -> Column:
    """Not in a short code list; a missing code counts as not allowed."""
    return ~F.coalesce(column(c).isin(list(codes)), F.lit(False))


def not_in_table(df: DataFrame, c, codes: DataFrame, code_column, max_broadcast=100_000):
    """Rows whose code a reference table does not hold.

    The table is broadcast only if a count bounded by ``max_broadcast`` shows
    it small; otherwise distinct codes are compared.
    """
    keys = codes.select(F.col(code_column).alias(c)).dropna().distinct()
    if keys.limit(max_broadcast + 1).count() <= max_broadcast:
        return df.join(F.broadcast(keys), c, "left_anti").select(*df.columns)
    return rows_without(df, [c], keys)


def split_required(df: DataFrame, fields):
    """(complete rows, rows with a missing required field)."""
    missing = any_missing(fields)
    return df.filter(~missing), df.filter(missing)


def split_by_reasons(df: DataFrame, reasons="reasons"):
    """(clean, bad) of a frame that has its reasons column.

    Both are filters on one frame; pass a materialised one to use both.
    """
    none = F.size(F.col(reasons)) == 0
    return df.filter(none).drop(reasons), df.filter(~none)


def apply_rules(df: DataFrame, rules):
    """(clean, bad with ``reasons``)."""
    return split_by_reasons(df.withColumn("reasons", broken_names(rules)))


def rule_counts(df: DataFrame, reasons="reasons") -> DataFrame:
    """Rows per broken rule; a row counts once for each of its rules."""
    return (
        df.select(F.explode(reasons).alias("reason")).groupBy("reason")
        .agg(F.count("*").alias("row_count"))
    )


# -- claims files -----------------------------------------------------------

def type_claims(df: DataFrame, integers="numeric") -> DataFrame:
    """Typed claim columns; other columns pass through.

    ``numeric`` accepts ``300017.0`` as an identifier, ``strict`` wants digits
    only and strips every text column.
    """
    if integers == "numeric":
        typed = {c: K.to_decimal(c, True) for c in INTEGER_COLUMNS}
    elif integers == "strict":
        typed = {c: K.to_digits(c, True) for c in INTEGER_COLUMNS}
        df = df.withColumn("diagnosis_code", strip("diagnosis_code"))
    else:
        raise ValueError(f"unknown integer policy: {integers}")
    typed["claim_amount"] = K.to_number("claim_amount", True)
    typed["service_date"] = K.to_day("service_date", True)
    stripped = df.withColumns({c: strip(c) for c in typed})
    return compute_once(stripped, **typed)


def claim_rules(as_of, integers="numeric", codes=FILE_PROCEDURE_CODES, duplicate="is_duplicate"):
    """Rules of a typed claims file, in report order.

    After strict typing a value that was not an integer is null, so the
    integer rules coincide with missing values there.
    """
    as_numbers = [int(c) for c in codes]
    rules = [
        Rule("missing required fields", any_missing(CLAIM_COLUMNS_LINES)),
        Rule("duplicate claim_id", F.col(duplicate)),
        Rule("negative claim_amount", F.col("claim_amount") < 0),
        Rule("invalid procedure_code", not_allowed("procedure_code", as_numbers)),
    ]
    for c in ("claim_id", "patient_id", "provider_id"):
        whole = F.col(c).isNotNull() if integers == "strict" else F.coalesce(K.is_whole(F.col(c)), F.lit(False))
        rules.append(Rule(f"invalid {c}", ~whole))
    rules.append(Rule("malformed service_date", F.col("service_date").isNull()))
    rules.append(Rule("future service_date", F.col("service_date") > as_day(as_of)))
    return rules


def final_claim_types(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("bigint") for c in INTEGER_COLUMNS})


def integer_cleanup(df: DataFrame, columns=INTEGER_COLUMNS):
    """(clean with bigint columns, bad): every listed column digits only.

    Every column is stripped once and tested once, each in a step of its own,
    so that the generated code stays small enough to be compiled.
    """
    tested = df
    for c in columns:
        tested = compute_once(tested, **{f"_bare_{c}": strip(F.col(c).cast("string"))})
    for c in columns:
        tested = compute_once(tested, **{f"_ok_{c}": K.is_digits(f"_bare_{c}", True)})
    good = reduce(lambda a, b: a & b, [F.col(f"_ok_{c}") for c in columns])
    clean = tested.filter(good).withColumns({c: F.col(f"_bare_{c}").try_cast("bigint") for c in columns})
    return clean.select(*df.columns), tested.filter(~good).select(*df.columns)


# -- source table -----------------------------------------------------------

def type_source(df: DataFrame) -> DataFrame:
    """Types of the extracted source columns."""
    kinds = dict(df.dtypes)
    texts = [c for c in ("claim_id", "patient_id", "provider_id", "service_date") if kinds[c] == "string"]
    stripped = df.withColumns({
        **{c: strip(c) for c in texts},
        "diagnosis_code": F.col("diagnosis_code").cast("string"),
        "procedure_code": F.col("procedure_code").cast("string"),
    })

    def whole(c):
        return F.col(c).cast("bigint") if kinds[c] in ("int", "bigint") else K.to_whole(c, kinds[c] == "string")

    return compute_in_steps(
        stripped, claim_id=whole("claim_id"), patient_id=whole("patient_id"),
        provider_id=whole("provider_id"), amount=K.to_amount("amount"),
        service_date=F.col("service_date") if kinds["service_date"] == "date" else K.to_day("service_date", kinds["service_date"] == "string"))


def source_rules(as_of):
    """Reasons that keep a source row out of the stage; diagnosis is optional."""
    blank = F.coalesce(strip("procedure_code") == "", F.lit(True))
    return [
        Rule("missing claim_id", F.col("claim_id").isNull()),
        Rule("missing patient_id", F.col("patient_id").isNull()),
        Rule("missing provider_id", F.col("provider_id").isNull()),
        Rule("missing procedure_code", blank),
        Rule("missing amount", F.col("amount").isNull()),
        Rule("negative amount", F.col("amount") < 0),
        Rule("missing/invalid service_date", F.col("service_date").isNull()),
        Rule("future service_date", F.col("service_date") > as_day(as_of)),
    ]


# -- target side ------------------------------------------------------------

def as_day(as_of) -> Column:
    """Date column from a date, an ISO text or a column."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def target_rules(as_of, codes=TARGET_PROCEDURE_CODES):
    """The ordered reason chain of target-side rejects."""
    known = F.col("procedure_code").isin(list(codes))
    return [
        Rule("missing claim_id", F.col("claim_id").isNull()),
        Rule("missing patient_id", F.col("patient_id").isNull()),
        Rule("missing provider_id", F.col("provider_id").isNull()),
        Rule("missing procedure_code", F.col("procedure_code").isNull()),
        Rule("invalid procedure_code", ~known),
        Rule("missing amount", F.col("amount").isNull()),
        Rule("negative amount", F.col("amount") < 0),
        Rule("missing service_date", F.col("service_date").isNull()),
        Rule("future service_date", F.col("service_date") > as_day(as_of)),
    ]


def target_reason(as_of, codes=TARGET_PROCEDURE_CODES) -> Column:
    return first_broken(target_rules(as_of, codes), "unknown validation failure")


def is_target_invalid(as_of, enforce_codes=False, codes=TARGET_PROCEDURE_CODES) -> Column:
    """Rows the merge refuses: all that are not valid, also where a test is null."""
    return ~F.coalesce(is_target_valid(as_of, enforce_codes, codes), F.lit(False))


def is_target_valid(as_of, enforce_codes=False, codes=TARGET_PROCEDURE_CODES) -> Column:
    """Rows the merge accepts, as bare conjuncts that a scan can take over.

    A procedure code outside the list does not reject a row by itself, though
    it is the reason shown if the row is rejected; ``enforce_codes`` changes
    that.
    """
    valid = (
        F.col("claim_id").isNotNull() & F.col("patient_id").isNotNull()
        & F.col("provider_id").isNotNull() & F.col("procedure_code").isNotNull()
        & F.col("amount").isNotNull() & (F.col("amount") >= 0)
        & F.col("service_date").isNotNull() & (F.col("service_date") <= as_day(as_of))
    )
    if enforce_codes:
        valid = valid & F.col("procedure_code").isin(list(codes))
    return valid


def reason_fits(reason="rejection_reason") -> Column:
    return F.length(column(reason)) <= REASON_WIDTH
