"""Projections that later filters cannot duplicate."""

from pyspark.sql import DataFrame, functions as F


def compute_once(df: DataFrame, **columns) -> DataFrame:
    """Add (or replace) columns that a filter further up cannot pull down.

    A filter on an ordinary column is moved below the projection with the
    whole expression copied into it, once per mention; parsing and patterns
    would then run many times per row.  Columns of a generated row stay where
    they are, and filters on the other columns still move down.
    """
    made = F.struct(*[c.alias(f"_once_{n}") for n, c in columns.items()])
    kept = [F.col(c) for c in df.columns]
    out = df.select(*kept, F.inline(F.array(made)))
    order = df.columns + [n for n in columns if n not in df.columns]
    return out.select(*[
        F.col(f"_once_{n}").alias(n) if n in columns else F.col(n) for n in order])


def compute_in_steps(df: DataFrame, **columns) -> DataFrame:
    """As ``compute_once``, each column in a step of its own; none may use another.

    The generated code of a step is a method of its own.  One method for many
    conversions or patterns outgrows what the JVM compiles (8000 bytes), and
    is then interpreted for every row.
    """
    for name, made in columns.items():
        df = compute_once(df, **{name: made})
    return df
