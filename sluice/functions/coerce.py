"""Text to typed values; what does not fit becomes null, never an error."""

from pyspark.sql import Column, functions as F

from sluice.functions.text import column, strip

NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DIGITS_PATTERN = "^[0-9]+$"
# Accepted layouts other than yyyy-MM-dd: shape test and format.
ISO_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"
DATE_LAYOUTS = [
    (r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "M-d-yyyy"),
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    (r"^[0-9]{8}$", "yyyyMMdd"),
    (r"^[0-9]{1,2}[ -][A-Za-z]{3}[ -][0-9]{4}$", "d MMM yyyy"),
    (r"^[A-Za-z]{3} [0-9]{1,2},? [0-9]{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,9} [0-9]{1,2},? [0-9]{4}$", "MMMM d yyyy"),
]
# Texts that a header CSV scan reads as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


# Each conversion strips its text first; a caller that has stripped a column
# in a projection of its own passes ``bare=True``, so that the text, which a
# conversion looks at several times, is stripped once.


def _text(c, bare):
    return column(c) if bare else strip(column(c).cast("string"))


def to_number(c, bare=False) -> Column:
    """Double, or null for text that is not a finite decimal number."""
    text = _text(c, bare)
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER_PATTERN) & (F.abs(value) < float("inf")), value)


def to_decimal(c, bare=False, precision=38, scale=10) -> Column:
    """Exact decimal; identifiers keep all their digits.

    A fraction too small for the scale stays one: its last place is 1, so that
    no number becomes whole by rounding.
    """
    text = _text(c, bare)
    value = text.try_cast(f"decimal({precision},{scale})")
    fine = text.rlike(f"^[^eE]*[.][0-9]{{{scale}}}[0-9]*[1-9]") & (value % 1 == 0)
    cut = F.concat(F.regexp_extract(text, f"^[^.]*[.][0-9]{{{scale - 1}}}", 0), F.lit("1"))
    return F.when(fine, cut.try_cast(f"decimal({precision},{scale})")).otherwise(value)


def to_amount(c) -> Column:
    """Amount as staged, from text or a number."""
    return column(c).try_cast("decimal(18,2)")


def is_whole(number: Column) -> Column:
    """True for a number without a fraction; null for null."""
    return number % 1 == 0


def to_whole(c, bare=False) -> Column:
    """Bigint from integer text or text such as ``300017.0``; else null.

    Plain integers, the common case, take the first cast.
    """
    value = to_decimal(c, bare)
    return F.coalesce(
        _text(c, bare).try_cast("bigint"),
        F.when(is_whole(value), value.try_cast("bigint")))


def is_digits(c, bare=False) -> Column:
    """Digits only after stripping; false, not null, for a missing value."""
    return F.coalesce(_text(c, bare).rlike(DIGITS_PATTERN), F.lit(False))


def to_digits(c, bare=False) -> Column:
    """Bigint where the text is digits only, else null."""
    return F.when(is_digits(c, bare), _text(c, bare).try_cast("bigint"))


def to_day(c, bare=False) -> Column:
    """Date from the accepted layouts, ISO first; times of day and zones are dropped.

    Each format is tried only on text of its shape; plain ISO text costs one
    cast and no pattern.
    """
    text = _text(c, bare)
    plain = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    day = F.when(plain, text.try_cast("date")).when(
        text.rlike(ISO_TIME_PATTERN), F.substring(text, 1, 10).try_cast("date"))
    for shape, layout in DATE_LAYOUTS:
        words = text
        if "MMM" in layout:
            # One blank between the parts, and the month as the format spells it.
            words = F.initcap(F.regexp_replace(F.replace(text, F.lit(","), F.lit("")), "[ -]", " "))
        day = day.when(text.rlike(shape), F.try_to_date(words, layout))
    return day


def missing_to_null(c) -> Column:
    value = column(c)
    return F.when(~value.isin(MISSING_TOKENS), value)


def as_int(c) -> Column:
    return column(c).try_cast("bigint")


def as_float(c) -> Column:
    return column(c).try_cast("double")


def as_text(c) -> Column:
    return column(c).cast("string")


def date_text(c) -> Column:
    return column(c).cast("string")
