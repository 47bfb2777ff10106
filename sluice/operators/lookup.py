"""Look rows up in a list of keys, however unevenly rows are spread over keys."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sluice.session import materialize, truncate_lineage

HOT_ROWS = 100_000
# A hot key holds at least this share of the looked-up rows, so there are at
# most as many of them as shares.
HOT_SHARES = 10_000
# Groups of keys by hash that are counted first: only keys of a group with a hot key's rows are counted themselves.
SLOTS = 1 << 16


def key_counts(df: DataFrame, keys) -> DataFrame:
    """Rows per key, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("key_rows"))


def hot_keys(df: DataFrame, keys, hot_rows=HOT_ROWS):
    """The keys with ``hot_rows`` rows and one of ``HOT_SHARES`` parts of all rows, hence at most ``HOT_SHARES``; None without any.

    Groups of keys are counted first, which shuffles a number per group and
    task; only a group with as many rows can hold such a key.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    slots = materialize(df.groupBy(slot.alias("_slot")).agg(F.count("*").alias("slot_rows")), "key-slots")
    least = max(hot_rows, (slots.agg(F.sum("slot_rows")).first()[0] or 0) / HOT_SHARES)
    crowded = slots.filter(F.col("slot_rows") >= least).select("_slot")
    if crowded.isEmpty():
        return None
    inside = df.select(*keys, slot.alias("_slot")).join(F.broadcast(crowded), "_slot", "left_semi")
    hot = truncate_lineage(key_counts(inside, keys).filter(F.col("key_rows") >= least).select(*keys))
    return None if hot.isEmpty() else hot


def same_keys(keys, prefix):
    """Equal keys, nulls equal too."""
    tests = [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]
    return reduce(lambda a, b: a & b, tests)


def mark_listed(df: DataFrame, listed: DataFrame, keys, name, hot_rows=HOT_ROWS) -> DataFrame:
    """Add ``name``: whether the key of a row is in ``listed``.

    ``listed`` has each key once, with ``key_rows``, the rows of ``df`` that
    hold it.  Every key with ``hot_rows`` rows and one of ``HOT_SHARES`` parts
    of the rows of listed keys (hence at most ``HOT_SHARES`` keys, a bounded
    broadcast) is matched without a shuffle; the rows then spread over the
    shuffle of the second lookup, where they can match nothing.  What is left
    in one task of a key is below that share of all rows.
    """
    keys = list(keys)
    total = listed.agg(F.sum("key_rows")).scalar()
    hot = (
        listed.filter((F.col("key_rows") >= hot_rows) & (F.col("key_rows") * HOT_SHARES >= total))
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    )
    # key_rows % 1 is always 0; a literal would be taken out of the join keys,
    # and with it the spreading of hot rows.
    cold = listed.select(
        *[F.col(k).alias(f"_cold_{k}") for k in keys],
        (F.col("key_rows") % 1).alias("_cold_spread"), F.lit(True).alias("_cold"))
    marked = df.join(F.broadcast(hot), same_keys(keys, "_hot_"), "left")
    spread = F.when(F.col("_hot"), F.spark_partition_id() + 1).otherwise(0).cast("bigint")
    marked = marked.withColumn("_spread", spread)
    marked = marked.join(
        cold, same_keys(keys, "_cold_") & (F.col("_spread") == F.col("_cold_spread")), "left")
    flag = F.coalesce(F.col("_hot"), F.col("_cold"), F.lit(False))
    return marked.select(*df.columns, flag.alias(name))


def rows_without(df: DataFrame, keys, known: DataFrame, hot_rows=HOT_ROWS) -> DataFrame:
    """Rows whose key ``known`` does not hold; a null key is never held.

    The keys are compared once each, then the unknown ones are looked up.
    """
    keys = list(keys)
    unknown = key_counts(df, keys).join(known.select(*keys), keys, "left_anti")
    return mark_listed(df, unknown, keys, "_unknown", hot_rows).filter("_unknown").drop("_unknown")
