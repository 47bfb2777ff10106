"""Duplicate keys: flag them all, keep the first, keep the latest.

One key may hold a large share of all rows, so no operator here gathers the
rows of a key in one task.
"""

from pyspark.sql import DataFrame, Window, functions as F

from sluice.operators.lookup import HOT_ROWS, hot_keys, key_counts, mark_listed, same_keys
from sluice.session import materialize, truncate_lineage


def flag_duplicates(df: DataFrame, keys, name="is_duplicate", hot_rows=HOT_ROWS) -> DataFrame:
    """Mark every row whose key occurs more than once; null keys group together.

    Only repeated keys are looked up.  ``df`` is read twice: pass a scan or a
    materialised frame.
    """
    repeated = key_counts(df, keys).filter("key_rows > 1")
    return mark_listed(df, repeated, keys, name, hot_rows)


def flag_duplicates_sized(df: DataFrame, keys, name="is_duplicate", max_broadcast=500_000) -> DataFrame:
    """``flag_duplicates`` for a written table: counts the repeated keys first.

    Few repeated keys, the usual case, are broadcast after that check, and the
    rows are not shuffled at all; many go the way that shuffles.  Write the
    result once if it is read more than once.
    """
    keys = list(keys)
    repeated = truncate_lineage(key_counts(df, keys).filter("key_rows > 1"))
    if repeated.count() > max_broadcast:
        return mark_listed(df, repeated, keys, name)
    lookup = repeated.select(
        *[F.col(k).alias(f"_dup_{k}") for k in keys], F.lit(True).alias("_dup"))
    marked = df.join(F.broadcast(lookup), same_keys(keys, "_dup_"), "left")
    return marked.select(*df.columns, F.coalesce(F.col("_dup"), F.lit(False)).alias(name))


def sql_order(order):
    """Columns in the order of SQL: descending puts nulls first, ascending last."""
    return [
        F.col(c).desc_nulls_first() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in order
    ]


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first in ``order`` ((column, "asc"|"desc") pairs).

    Written as row_number = 1, which Spark reduces to one row per key in every
    task before the shuffle.
    """
    first = Window.partitionBy(*keys).orderBy(*sql_order(order))
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, keys, by="updated_at", tie_break=()) -> DataFrame:
    """One row per key with the greatest ``by``; a missing value counts as latest."""
    return keep_first(df, keys, [(by, "desc")] + [(c, "desc") for c in tie_break])


def mark_first(df: DataFrame, keys, order, row_id="row_id", name="is_first", late=None, hot_rows=HOT_ROWS) -> DataFrame:
    """Mark the first row of each key; all rows stay.

    Rows are shuffled once, by key; rows of a hot key are spread over tasks by
    ``row_id`` and compared with its first row, which is found before and
    broadcast.  ``row_id`` must be unique and stable: part of a written table,
    or of a file scan; ``df`` is read twice.  ``late`` adds columns that the
    order needs after the shuffle, so that they are not part of it.
    """
    keys = list(keys)
    order = [*order, (row_id, "asc")]
    late = late or (lambda rows: rows)
    hot = hot_keys(df, keys, hot_rows)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*sql_order(order)))
    if hot is None:
        dealt = late(df.repartition(*keys))
        return dealt.select(*dealt.columns, (place == 1).alias(name))
    named = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    firsts = truncate_lineage(keep_first(
        late(df.join(F.broadcast(named), same_keys(keys, "_hot_"), "left_semi")), keys, order).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], F.col(row_id).alias("_first_id"), F.lit(True).alias("_hot")))
    marked = df.join(F.broadcast(firsts), same_keys(keys, "_hot_"), "left").drop(*[f"_hot_{k}" for k in keys])
    # Hot rows are dealt by their identity, each a key of its own.
    spread = F.when(F.col("_hot"), F.xxhash64(row_id)).otherwise(0)
    dealt = late(marked.withColumn("_spread", spread).repartition(*keys, "_spread"))
    place = F.row_number().over(Window.partitionBy(*keys, "_spread").orderBy(*sql_order(order)))
    first = F.when(F.col("_hot"), F.col(row_id) == F.col("_first_id")).otherwise(place == 1)
    shown = [c for c in dealt.columns if c not in ("_hot", "_first_id", "_spread")]
    return dealt.select(*shown, first.alias(name))


def part_repeated(df: DataFrame, keys, max_broadcast=500_000, share=0.05):
    """(rows of keys that occur once, all rows of keys that repeat); (None, ``df``) where many keys repeat.

    Only the rows of repeated keys need a ranking, so few of them leave the
    other rows where they lie.  An estimate from one scan tells whether more
    than ``share`` of the rows repeat a key; if not, the keys' 64-bit hashes,
    and nothing else, are shuffled and the repeated ones broadcast.  Keys of
    one hash count as repeated, which only sends them to the ranking.  ``df``
    is read several times: pass a scan or a materialised frame.
    """
    code = F.xxhash64(*keys)
    guess = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(code, 0.01).alias("codes")).first()
    if guess["rows"] - guess["codes"] > share * guess["rows"]:
        return None, df
    # Dealt before they are counted: combining hashes that hardly repeat would only cost a task's memory.
    repeated = materialize(
        df.select(code.alias("_code")).repartition("_code").groupBy("_code").agg(F.count(F.lit(1)).alias("code_rows"))
        .filter("code_rows > 1").select("_code"), "repeated-keys")
    if repeated.count() > max_broadcast:
        return None, df
    same = code == F.col("_code")
    return df.join(F.broadcast(repeated), same, "left_anti"), df.join(F.broadcast(repeated), same, "left_semi")


def surrogate_id(df: DataFrame, name="stg_claim_row_id") -> DataFrame:
    """Number rows for a table that is written next.

    Unique across tasks; the numbers are fixed once written, so read them back
    rather than computing them twice.  Lines of files carry ``row_no`` instead.
    """
    return df.withColumn(name, F.monotonically_increasing_id())
