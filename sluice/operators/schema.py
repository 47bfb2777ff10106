"""Header policies, projections and table constraints."""

from pyspark.sql import DataFrame, functions as F

from sluice.model import STAGE_COLUMNS, WIDTHS
from sluice.operators.lookup import rows_without


def normalize_names(names):
    return [n.strip().lower() for n in names]


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def check_names(actual, expected, policy="set"):
    """``ordered`` wants the same names in the same order, ``set`` the same names."""
    if policy == "ordered":
        if list(actual) != list(expected):
            raise ValueError(f"schema drift: columns should be {list(expected)}, found {list(actual)}")
        return
    missing = [c for c in expected if c not in actual]
    extra = [c for c in actual if c not in expected]
    if missing or extra or len(actual) != len(expected):
        raise ValueError(f"schema check: missing {missing}, unexpected {extra}, found {list(actual)}")


def check_schema(df: DataFrame, expected, policy="set") -> DataFrame:
    check_names(df.columns, expected, policy)
    return df


def out_of_order(actual, expected) -> bool:
    return list(actual) != list(expected)


def align(df: DataFrame, expected) -> DataFrame:
    return df.select(*expected)


def tag_load(df: DataFrame, load_id: str) -> DataFrame:
    return df.withColumn("load_id", F.lit(load_id))


def stage_projection(df: DataFrame, load_id: str) -> DataFrame:
    """Rename the amount, tag the load and fix the column order."""
    return tag_load(df.withColumnRenamed("claim_amount", "amount"), load_id).select(*STAGE_COLUMNS)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row; rows with a null key never clash."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def null_counts(df: DataFrame, columns) -> DataFrame:
    """(column_name, null_rows) for each column that must be filled."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def orphans(child: DataFrame, parent: DataFrame, child_key, parent_key) -> DataFrame:
    """Child rows whose key is not in the parent; null keys pass."""
    known = parent.select(F.col(parent_key).alias(child_key)).dropna().distinct()
    return rows_without(child.filter(F.col(child_key).isNotNull()), [child_key], known)


def too_long(df: DataFrame, widths=WIDTHS) -> DataFrame:
    """Add ``too_long``: the names of the columns over their width."""
    marks = [F.when(F.length(F.col(c)) > n, F.lit(c)) for c, n in widths.items() if c in df.columns]
    return df.withColumn("too_long", F.array_compact(F.array(*marks)))


def assert_unique(df: DataFrame, keys) -> DataFrame:
    found = duplicate_keys(df, keys).first()
    if found is not None:
        raise ValueError(f"duplicate key {[found[k] for k in keys]} for {list(keys)}")
    return df


def assert_not_null(df: DataFrame, columns) -> DataFrame:
    bad = {r["column_name"]: r["null_rows"] for r in null_counts(df, columns).collect() if r["null_rows"]}
    if bad:
        raise ValueError(f"missing values: {bad}")
    return df


def assert_no_orphans(child, parent, child_key, parent_key) -> DataFrame:
    if not orphans(child, parent, child_key, parent_key).isEmpty():
        raise ValueError(f"{child_key} not found in {parent_key}")
    return child


def assert_widths(df: DataFrame, widths=WIDTHS) -> DataFrame:
    found = too_long(df, widths).filter(F.size("too_long") > 0).first()
    if found is not None:
        raise ValueError(f"value too long in {found['too_long']}")
    return df
