"""Small analyses: totals, nested totals, filters by day, even numbers."""

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.coerce import to_day, to_number
from sluice.functions.text import column
from sluice.sources.nested import flatten


def sum_by(df: DataFrame, key, value, name) -> DataFrame:
    """Sum per key: missing keys are left out, a sum of nothing is 0."""
    total = F.coalesce(F.sum(value), F.lit(0))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(total.alias(name))


def positive(df: DataFrame, value="amount") -> DataFrame:
    return df.filter(F.col(value) > 0)


def positive_totals(df: DataFrame, key="user_id", value="amount", name="amount") -> DataFrame:
    """Sum of the positive values per key, largest first."""
    return sum_by(positive(df, value), key, value, name).orderBy(F.desc(name), key)


def nested_totals(df: DataFrame, key="user_id", items="transactions", status="completed",
                  name="amount") -> DataFrame:
    """Sum of positive amounts of one status over nested items, smallest first."""
    flat = flatten(df, key, items)
    kept = flat.filter((F.col("status") == status) & (F.col("amount") > 0))
    return sum_by(kept, key, "amount", name).orderBy(name, key)


def numeric_amount(df: DataFrame, value="amount") -> DataFrame:
    return df.withColumn(value, to_number(value))


def line_totals(df: DataFrame, price="price", quantity="quantity", keep=("id",), name="total") -> DataFrame:
    return df.select(*keep, (F.col(price) * F.col(quantity)).alias(name))


def with_date_parts(df: DataFrame, day="service_date") -> DataFrame:
    return df.withColumns({
        "year": F.year(day), "month": F.month(day), "day_of_month": F.dayofmonth(day)})


def dated(df: DataFrame, day="service_date") -> DataFrame:
    """Coerce the date and drop rows without one."""
    return df.withColumn(day, to_day(day)).dropna(subset=[day])


def on_date(df: DataFrame, year=None, month=None, day=None, column_name="service_date") -> DataFrame:
    """Rows of a year, a month or a day.

    Parts given from the year down become one range on the column itself,
    which a scan can use to skip files; other combinations test the parts.
    """
    c = F.col(column_name)
    if year is not None and (month is not None or day is None):
        if month is None:
            low, step = f"{year:04d}-01-01", "1 year"
        elif day is None:
            low, step = f"{year:04d}-{month:02d}-01", "1 month"
        else:
            low, step = f"{year:04d}-{month:02d}-{day:02d}", "1 day"
        # A bound of the column's own type, so that no cast hides the column.
        start = F.lit(low).cast(df.schema[column_name].dataType)
        return df.filter((c >= start) & (c < start + F.expr(f"interval {step}")))
    parts = [(F.year(c), year), (F.month(c), month), (F.dayofmonth(c), day)]
    for part, want in parts:
        if want is not None:
            df = df.filter(part == want)
    return df


def even(df: DataFrame, number="n") -> DataFrame:
    return df.filter(F.col(number) % 2 == 0)


def even_items(items) -> Column:
    return F.filter(column(items), lambda n: n % 2 == 0)


def first_rows(df: DataFrame, n, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ordered(df: DataFrame, *order) -> DataFrame:
    """Sorted output; only for what is written or shown."""
    return df.orderBy(*order)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def row_text(values, missing="nan") -> Column:
    """Array of values joined by commas; a missing value prints as ``nan``."""
    return F.array_join(column(values), ",", missing)
