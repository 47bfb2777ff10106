"""Row numbers within groups, without one ordered task per group.

Rows are dealt by ranges of (group, order) and sorted within each range;
each range counts its rows per group, and a running sum over those small
counts gives each range its first number.  A group that holds a third of all
rows is spread over many ranges, so no task holds more than a range.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import materialize

#: Range counts that are broadcast back to the rows: at most this many (range, group) pairs.
BROADCAST_COUNTS = 1_000_000


def with_ordinal(df: DataFrame, order, groups=(), name="ordinal", partitions=None, label="ordinal", nulls_last=False) -> DataFrame:
    """``df`` with ``name``: the 0-based place of a row within its group by ``order``, and ``<name>_of``: the group's rows.

    ``order`` and ``groups`` are column names; ``order`` should make rows
    unique where their order matters, since equal rows take their places
    in an arbitrary but fixed order.  Nulls of ``order`` sort first, or last
    with ``nulls_last``; null groups are a group of their own.  The numbered rows are written once, so that a
    re-run of a lost task finds the same numbers.
    """
    order, groups = list(order), list(groups)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in groups] + [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # After the sort, the increasing id counts the rows of a range in order.
    tagged = materialize(ranged.withColumn("_ord_range", F.spark_partition_id()).withColumn("_ord_row", F.monotonically_increasing_id()), label)
    counts = tagged.groupBy("_ord_range", *groups).agg(F.count(F.lit(1)).alias("_rows"), F.min("_ord_row").alias("_first"))
    by_group = Window.partitionBy(*[F.col(g) for g in groups]).orderBy("_ord_range")
    counts = counts.select(
        "_ord_range", *[F.col(g).alias(f"_g_{g}") for g in groups], "_first",
        (F.sum("_rows").over(by_group.rowsBetween(Window.unboundedPreceding, -1))).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*[F.col(g) for g in groups])).alias(f"{name}_of"))
    counts = materialize(counts, f"{label}-counts")
    side = F.broadcast(counts) if counts.count() <= BROADCAST_COUNTS else counts
    same = [tagged["_ord_range"] == side["_ord_range"]] + [tagged[g].eqNullSafe(side[f"_g_{g}"]) for g in groups]
    joined = tagged.join(side, same)
    place = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_ord_row") - F.col("_first")
    return joined.select(*[tagged[c] for c in df.columns], place.alias(name), F.col(f"{name}_of"))
