"""Registered queries: a Spark callable and, where there is one, its SQL."""

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a (spark, sf_dir) -> DataFrame function under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add
