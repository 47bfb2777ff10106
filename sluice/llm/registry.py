"""Queries of this package and, where there is one, their SQL."""

import os
import shutil
import tempfile
from pathlib import Path

import sluice

QUERIES = {}
ORACLES = {}
_SHIPPED = set()


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def ship(spark) -> None:
    """Send this library's code to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(sluice.__file__).parent
        # Spark serves the archive from here as long as the application runs.
        folder = os.path.realpath(tempfile.mkdtemp(prefix="sluice-code-"))
        context.addPyFile(shutil.make_archive(f"{folder}/sluice-code", "zip", root.parent, root.name))
        _SHIPPED.add(context.applicationId)


def read(spark, sf_dir, name):
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
