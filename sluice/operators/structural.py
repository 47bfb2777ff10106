"""Checks of raw lines, before any column exists."""

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.text import column, is_blank
from sluice.model import CSV_FIELD_LIMIT
from sluice.operators.once import compute_once

# One match per field of "," + line: a quoted field with what follows it, a
# plain field, or an empty field.
FIELD_PATTERN = r',("(?:[^"]|"")*+(?:"|\z)[^,]*|[^",][^,]*|)'
QUOTED_BODY = r'^"((?:[^"]|"")*+)(?:"|\z)'
AFTER_QUOTE = r'^"(?:[^"]|"")*+"(.*)$'

REASONS = [
    "empty row", "broken quoted row", "unparseable row",
    "row has too few columns", "row has extra columns", "truncated final row",
]


def without_return(line) -> Column:
    return F.rtrim(column(line), F.lit("\r"))


def split_fields(line) -> Column:
    """Fields of one comma-separated line; empty fields stay ``''``.

    Lines without a quote, the common case, need no pattern.
    """
    text = without_return(line)

    def unquote(field):
        body = F.replace(F.regexp_extract(field, QUOTED_BODY, 1), F.lit('""'), F.lit('"'))
        tail = F.regexp_extract(field, AFTER_QUOTE, 1)
        return F.when(field.startswith('"'), F.concat(body, tail)).otherwise(field)

    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(FIELD_PATTERN), 1), unquote)
    return F.when(F.instr(text, '"') == 0, F.split(text, ",", -1)).otherwise(quoted)


def has_odd_quotes(line) -> Column:
    c = column(line)
    return (F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))) % 2 == 1


def is_unparseable(line, fields) -> Column:
    """A NUL character, or a field beyond the reader's limit."""
    c, f = column(line), column(fields)
    long_field = (F.length(c) > CSV_FIELD_LIMIT) & F.exists(
        f, lambda v: F.length(v) > CSV_FIELD_LIMIT)
    return (F.instr(c, "\0") > 0) | long_field


def structural_reason(line, fields, n_columns: int) -> Column:
    """The first reason that fits, or null."""
    count = F.size(column(fields))
    return (
        F.when(is_blank(line), REASONS[0])
        .when(has_odd_quotes(line), REASONS[1])
        .when(is_unparseable(line, fields), REASONS[2])
        .when(count < n_columns, REASONS[3])
        .when(count > n_columns, REASONS[4])
    )


def check_lines(lines: DataFrame, n_columns: int) -> DataFrame:
    """Add ``fields`` and ``reason`` to (…, raw_row)."""
    with_fields = compute_once(lines, fields=split_fields("raw_row"))
    return with_fields.withColumn("reason", structural_reason("raw_row", "fields", n_columns))


def structural_split(lines: DataFrame, header, keep_truncated=True):
    """(clean, bad) of data lines.

    ``clean`` has the header's columns as text; ``bad`` has one row per reason.
    A truncated last line is reported in addition to its own reason, and is
    left out of ``clean`` if ``keep_truncated`` is false.
    """
    checked = check_lines(lines, len(header))
    has_cut = "truncated" in lines.columns
    cut = F.col("truncated") if has_cut else F.lit(False)
    reasons = F.array_compact(F.array(F.col("reason"), F.when(cut, F.lit(REASONS[5]))))
    place = [c for c in ("file", "line_number") if c in lines.columns]
    bad = (
        checked.select(*place, F.explode(reasons).alias("reason"), "raw_row")
    )
    good = F.col("reason").isNull()
    if not keep_truncated:
        good = good & ~cut
    clean = checked.filter(good).select(
        *place, *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(header)])
    return clean, bad
