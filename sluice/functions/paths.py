"""Parts of object keys and file names."""

from pyspark.sql import Column, functions as F

from sluice.functions.text import column

# Fixed patterns of the split-file naming scheme.
PROGRAM_PATTERN = "_(.+?)_split_file"
ID_PROGRAM_PATTERN = "^([A-Za-z0-9-]+)_([A-Za-z0-9-]+)_split_file"
LEADING_ID_PATTERN = "^[a-zA-Z0-9-]+"


def _capture(c, pattern, group):
    got = F.regexp_extract(c, pattern, group)
    return F.when(got != "", got)


def folder_name(path) -> Column:
    """Second last path element; null when there is none."""
    return F.try_element_at(F.split(column(path), "/"), F.lit(-2))


def object_name(path) -> Column:
    return F.element_at(F.split(column(path), "/"), -1)


def program_name(name) -> Column:
    return _capture(column(name), PROGRAM_PATTERN, 1)


def id_and_program(name) -> Column:
    """``<id>_<program>``, used to name a failed-record archive."""
    first = _capture(column(name), ID_PROGRAM_PATTERN, 1)
    second = _capture(column(name), ID_PROGRAM_PATTERN, 2)
    return F.when(first.isNotNull() & second.isNotNull(), F.concat_ws("_", first, second))


def leading_id(name) -> Column:
    return _capture(column(name), LEADING_ID_PATTERN, 0)


def delimiter(path) -> Column:
    """``|`` if folder or file name tell of a split file, else a comma.

    Folders further up do not count: they are the bucket, not the key.
    """
    key = F.concat_ws("/", folder_name(path), object_name(path))
    return F.when(key.contains("split_file"), F.lit("|")).otherwise(F.lit(","))
