"""Whitespace, captures and other text expressions."""

from pyspark.sql import Column, functions as F

# Fixed value: the code point ranges that count as white space when a value is
# stripped.
WHITE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
WHITE = "".join(chr(c) for low, high in WHITE_RANGES for c in range(low, high + 1))


def column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove white space of any kind at both ends.

    Text that starts and ends with a printable ASCII character, as nearly all
    does, is passed on after a look at these two.
    """
    text = column(c)
    bare = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    return F.when(bare, text).otherwise(F.trim(text, F.lit(WHITE)))


def is_blank(c) -> Column:
    return strip(c) == ""


def capture(c, pattern: str, flags: str = "i") -> Column:
    """First group of the first match, ``''`` without a match.

    ``d`` makes only a line feed end a line.
    """
    return F.regexp_extract(column(c), f"(?d{flags}){pattern}", 1)


def captured(c) -> Column:
    """A capture stripped; null without a match.

    The group must not match the empty text, so that empty means no match.
    """
    return F.when(column(c) != "", strip(c))


def first_capture(c, pattern: str, flags: str = "i") -> Column:
    """First group of the first match, stripped; null without a match."""
    return captured(capture(c, pattern, flags))


def normalize_text(c) -> Column:
    """Carriage returns to line feeds, runs of blanks or line feeds to one, strip."""
    return strip(even_blanks(c))


def even_blanks(c) -> Column:
    """``normalize_text`` without its last step: a strip looks at its text several times, so make this a column before."""
    lines = F.replace(column(c), F.lit("\r"), F.lit("\n"))
    # Tabs as blanks first, so that the pattern has to look at longer runs only.
    blanks = F.regexp_replace(F.replace(lines, F.lit("\t"), F.lit(" ")), " {2,}", " ")
    return F.regexp_replace(blanks, r"\n{2,}", "\n")


def cut(c, n: int) -> Column:
    return F.substring(column(c), 1, n)
