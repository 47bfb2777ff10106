"""Stage-to-target merge: winners, losers, rejects, upserts."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sluice.functions.hashing import random_hash, record_hash
from sluice.operators.dedupe import keep_first, mark_first
from sluice.operators.rules import is_target_invalid, is_target_valid, target_reason

DUPLICATE_REASON = "duplicate claim_id in stage load"
# Latest first, the hash breaks ties.
MERGE_ORDER = [("ingested_at", "desc"), ("record_hash", "desc")]
INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"


def add_hash(df: DataFrame, hash_mode="md5", null_marker=None) -> DataFrame:
    """``md5`` of the claim columns, ``random`` per row, or ``keep`` as staged."""
    if hash_mode == "md5":
        return df.withColumn("record_hash", record_hash(null_marker=null_marker))
    if hash_mode == "random":
        return df.withColumn("record_hash", random_hash())
    if hash_mode == "keep":
        return df
    raise ValueError(f"unknown hash mode: {hash_mode}")


def winners(stage: DataFrame, as_of, key="claim_id", order=MERGE_ORDER, enforce_codes=False) -> DataFrame:
    """The valid row of each key that the merge takes; validity comes first."""
    return keep_first(stage.filter(is_target_valid(as_of, enforce_codes)), [key], order)


def invalid_rejects(stage: DataFrame, as_of, enforce_codes=False) -> DataFrame:
    """Rows the merge refuses, with the first reason that fits."""
    refused = stage.filter(is_target_invalid(as_of, enforce_codes))
    return refused.withColumn("rejection_reason", target_reason(as_of))


def ranked(stage: DataFrame, as_of, key="claim_id", order=MERGE_ORDER,
           row_id="row_id", enforce_codes=False) -> DataFrame:
    """Valid rows with ``is_first``; winners and losers are filters on it."""
    valid = stage.filter(is_target_valid(as_of, enforce_codes))
    return mark_first(valid, [key], order, row_id)


def losers(stage: DataFrame, as_of, key="claim_id", order=MERGE_ORDER,
           row_id="row_id", enforce_codes=False) -> DataFrame:
    """Valid rows that lost to another row of their key."""
    lost = ranked(stage, as_of, key, order, row_id, enforce_codes).filter(~F.col("is_first"))
    return lost.drop("is_first").withColumn("rejection_reason", F.lit(DUPLICATE_REASON))


def hashes_differ(old, new, policy="null_safe"):
    """Whether the policy changes an existing row with these hashes."""
    if policy == "always":
        return F.lit(True)
    if policy == "null_safe":
        return ~old.eqNullSafe(new)
    if policy == "strict":
        return F.coalesce(old != new, F.lit(False))
    raise ValueError(f"unknown update policy: {policy}")


def changed_rows(target: DataFrame, source: DataFrame, key="claim_id", policy="null_safe",
                 hash_column="record_hash", stamp=None, stamp_column="ingested_at") -> DataFrame:
    """The rows of ``source`` that a merge inserts or updates, as they will be stored.

    Of the target only the key, and the hash where the policy asks for it, is
    read.  Both sides have one row per key; a source row without a key is not
    merged.
    """
    compared = [] if policy == "always" else [hash_column]
    known = target.select(
        F.col(key).alias("_key"), *[F.col(c).alias("_hash") for c in compared], F.lit(True).alias("_known"))
    joined = source.select(*target.columns).filter(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_key"), "left")
    old = F.col("_hash") if compared else F.lit(None)
    written = joined.filter(F.col("_known").isNull() | hashes_differ(old, F.col(hash_column) if compared else old, policy))
    if stamp is not None:
        written = written.withColumn(stamp_column, F.lit(stamp).cast(target.schema[stamp_column].dataType))
    return written.select(*target.columns)


def taken_rows(source: DataFrame, schema, key="claim_id", stamp=None, stamp_column="ingested_at", more=()) -> DataFrame:
    """All rows of ``source`` with a key, as a merge that takes every one of them stores them, and the columns ``more``."""
    rows = source.select(*schema.names, *more).filter(F.col(key).isNotNull())
    if stamp is not None:
        rows = rows.withColumn(stamp_column, F.lit(stamp).cast(schema[stamp_column].dataType))
    return rows


def replace_rows(old: DataFrame, changed: DataFrame, key="claim_id") -> DataFrame:
    """``old`` with the rows of ``changed`` in place of those of the same keys."""
    return old.join(changed.select(key), key, "left_anti").select(*changed.columns).unionByName(changed)


def upsert(target: DataFrame, source: DataFrame, key="claim_id", policy="null_safe",
           hash_column="record_hash", stamp=None, stamp_column="ingested_at") -> DataFrame:
    """The target after the merge, with an ``action`` per row.

    Both sides have one row per key.  An existing row changes if the hashes
    differ (``null_safe``), if they differ and neither is null (``strict``),
    or ``always``.  ``stamp`` is the merge time given to new and changed rows.
    """
    columns = target.columns
    t, s = target.alias("t"), source.select(*columns).alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    hashed = policy != "always"
    differs = hashes_differ(*[F.col(f"{side}.{hash_column}") if hashed else F.lit(None) for side in "ts"], policy)
    action = (
        F.when(F.col(f"s.{key}").isNull(), KEPT)
        .when(F.col(f"t.{key}").isNull(), INSERT)
        .when(differs, UPDATE)
        .otherwise(UNCHANGED)
    )
    with_action = joined.withColumn("action", action)
    written = F.col("action").isin(INSERT, UPDATE)
    out = []
    for c in columns:
        new = F.lit(stamp).cast(target.schema[c].dataType) if c == stamp_column and stamp is not None else F.col(f"s.{c}")
        out.append(F.when(written, new).otherwise(F.col(f"t.{c}")).alias(c))
    return with_action.select(*out, "action")


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action; inserts and updates together are the upserted rows."""
    return merged.groupBy("action").agg(F.count("*").alias("row_count"))


def insert_ignore(existing: DataFrame, new: DataFrame, keys) -> DataFrame:
    """The rows of ``new`` whose keys are in neither ``existing`` nor earlier in ``new``.

    A key with a null never conflicts; such rows are passed on.  The others
    meet the existing keys in one aggregate, combined before its shuffle; of
    the rows of a key any one is kept whole.
    """
    keys = list(keys)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rest = [c for c in new.columns if c not in keys]
    both = new.filter(complete).withColumn("_known", F.lit(False)).unionByName(
        existing.filter(complete).select(*keys, F.lit(True).alias("_known")), allowMissingColumns=True)
    # A key without an existing row has rows of ``new`` only, and each first is that of the same row.
    groups = both.groupBy(*keys).agg(F.max("_known").alias("_known"), *[F.first(c).alias(c) for c in rest])
    fresh = groups.filter(~F.col("_known"))
    return fresh.select(*new.columns).unionByName(new.filter(~complete))
