"""sluice: record intake on Spark.

Pure functions from DataFrame to DataFrame: read messy records, check their
shape, coerce types, apply rules, split clean rows from quarantined ones,
stage, deduplicate, upsert, audit and reconcile.  No module holds a session, a
clock or a random value; ``as_of``, ``run_ts`` and ``load_id`` are parameters.
"""

__version__ = "0.1.0"
