"""Change-detection hashes and stable row identities."""

from pyspark.sql import Column, functions as F

from sluice.functions.text import column
from sluice.model import SOURCE_COLUMNS


def record_hash(columns=SOURCE_COLUMNS, null_marker=None) -> Column:
    """md5 of the columns joined by ``|``.

    Nulls are skipped, as in SQL ``concat_ws``; a ``null_marker`` keeps rows
    apart that differ only in which column is null.
    """
    parts = [column(c).cast("string") for c in columns]
    if null_marker is not None:
        parts = [F.coalesce(p, F.lit(null_marker)) for p in parts]
    return F.md5(F.concat_ws("|", *parts))


def random_hash() -> Column:
    """A new value for every row and run: every upsert counts as a change."""
    return F.uuid()


def document_key(path) -> Column:
    """The same document gets the same identity in every run."""
    return F.sha2(column(path), 256)
