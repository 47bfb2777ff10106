"""Write aside, recount, then make visible; and versioned tables.

Output of a load is written below ``_staging``, counted as written, and moved
to its place only if every output of the load has the right count.  Spark
readers skip folders whose name starts with an underscore.  A failed load
drops what it staged and leaves published data alone.
"""

import json
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

from sluice.session import CODEC
from sluice.sinks.archive import write_csv
from sluice.sinks.tables import hadoop_path, path_exists

BUCKET = "bucket"


@dataclass
class Output:
    """One output of a load: where it goes and how many rows it must have."""

    root: str
    name: str
    df: DataFrame
    expected: int = None
    kind: str = "parquet"
    order: tuple = ()
    hidden: tuple = ()  # columns only used for the order
    partition_by: tuple = ()  # a folder per value, e.g. per chunk

    def write(self, path):
        if self.kind == "csv":
            write_csv(self.df, path, self.order, self.hidden, mode="overwrite", partition_by=self.partition_by)
        else:
            self.df.write.option("compression", CODEC).mode("overwrite").parquet(path)

    def count(self, path) -> int:
        spark = self.df.sparkSession
        if self.kind == "csv":
            names = [c for c in self.df.columns if c not in self.hidden and c not in self.partition_by]
            text = T.StructType([T.StructField(c, T.StringType()) for c in names])
            reader = spark.read.schema(text).option("header", True).option("escape", '"').option("lineSep", "\n")
            return reader.csv(path).count()
        return spark.read.schema(self.df.schema).parquet(path).count()

    def staged(self, load_id):
        return f"{self.root}/_staging/{load_id}/{self.name}"

    @property
    def published(self):
        return f"{self.root}/{self.name}"

    def check(self, path, what):
        found = self.count(path)
        if self.expected is not None and found != self.expected:
            raise ValueError(f"{what}: {self.name} should hold {self.expected} rows, found {found}")
        return found


def rename(spark: SparkSession, source, target) -> None:
    fs, src = hadoop_path(spark, source)
    _, dst = hadoop_path(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def _intent_path(outputs, load_id) -> str:
    return f"{outputs[0].root}/_publishing/{load_id}.json"


def _write_text(spark: SparkSession, path, text) -> None:
    """A small file that appears whole: written aside, then renamed."""
    fs, final = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, f"{path}.writing")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(final, False)
    if not fs.rename(aside, final):
        raise OSError(f"could not place {path}")


def _read_text(spark: SparkSession, path):
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def take_back(spark: SparkSession, load_id, outputs) -> bool:
    """Undo a publish of ``load_id`` that a dead driver left half done; True if there was one.

    The intent record, written before the first move, names every output and
    whether it held data before.  Set-aside data goes back to its place; data
    promoted by the dead run, which a re-run makes again, goes.  Only then are
    the record and the staging folders removed.
    """
    text = _read_text(spark, _intent_path(outputs, load_id))
    if text is None:
        return False
    for move in reversed(json.loads(text)["moves"]):
        aside, published, had_old = move["aside"], move["published"], move["had_old"]
        if path_exists(spark, aside):
            remove(spark, published)
            rename(spark, aside, published)
        elif not had_old:
            remove(spark, published)
    for root in {m["root"] for m in json.loads(text)["moves"]}:
        remove(spark, f"{root}/_staging/{load_id}")
    remove(spark, _intent_path(outputs, load_id))
    return True


def publish(spark: SparkSession, load_id, outputs) -> dict:
    """Stage and check every output, then promote them; rows by output name.

    A publish of the same load that a dead driver left half done is taken back
    first.  What an output replaces is set aside, after an intent record that
    names every move.  If a promotion or the recount after it fails, everything
    promoted so far is taken back, in reverse order, and the earlier data
    returns to its place.  Set-aside data is deleted only after a success or a
    complete undo; otherwise it stays, with the record, for ``take_back``.
    """
    take_back(spark, load_id, outputs)
    rows, undo, settled = {}, [], False
    intent = _intent_path(outputs, load_id)
    try:
        for out in outputs:
            out.write(out.staged(load_id))
            rows[out.name] = out.check(out.staged(load_id), "recount before publishing")
        moves = [{"root": out.root, "aside": f"{out.staged(load_id)}.replaced", "published": out.published,
                  "had_old": path_exists(spark, out.published)} for out in outputs]
        _write_text(spark, intent, json.dumps({"load_id": load_id, "moves": moves}))
        for out, move in zip(outputs, moves, strict=True):
            if move["had_old"]:
                rename(spark, out.published, move["aside"])
                undo.append((move["aside"], out.published))
            rename(spark, out.staged(load_id), out.published)
            undo.append((out.published, out.staged(load_id)))
        for out in outputs:
            out.check(out.published, "recount after publishing")
        settled = True
    except BaseException:
        for source, target in reversed(undo):
            rename(spark, source, target)
        settled = True
        raise
    finally:
        if settled:
            remove(spark, intent)
            for out in outputs:
                remove(spark, f"{out.root}/_staging/{load_id}")
    return rows


# -- versioned tables -------------------------------------------------------
#
# A table without MERGE is written beside itself: <root>/<version>/ holds rows,
# and a file <root>/_versions/<number> makes the version readable.  The file names
# the version and, for a table in buckets of its key, the version that holds each
# bucket, so that a merge writes only the buckets it touches.  The highest number
# counts.  Nothing is overwritten, so a reader of the version before is not
# disturbed, and as the file of a number is created once, two writers that race
# for one number cannot both win.


def _markers(spark: SparkSession, root):
    fs, folder = hadoop_path(spark, f"{root}/_versions")
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def _read_marker(spark: SparkSession, root, number):
    fs, path = hadoop_path(spark, f"{root}/_versions/{number}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def current_marker(spark: SparkSession, root):
    """(version, buckets) of the current version, or None for a table never written."""
    numbers = _markers(spark, root)
    return _read_marker(spark, root, numbers[-1]) if numbers else None


def marker_paths(root, marker):
    """Folders that hold the rows of a version."""
    if marker.get("buckets") is None:
        return [f"{root}/{marker['version']}"]
    return [f"{root}/{v}/{BUCKET}={b}" for b, v in marker["buckets"].items()]


def next_version(spark: SparkSession, root, load_id):
    numbers = _markers(spark, root)
    return f"{int(numbers[-1]) + 1 if numbers else 1:08d}-{load_id}"


def read_paths(spark: SparkSession, paths, schema) -> DataFrame:
    """Rows of some folders of a versioned table; none without folders."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_version(spark: SparkSession, root, schema) -> DataFrame:
    """The current rows of a versioned table, empty if never written."""
    marker = current_marker(spark, root)
    return read_paths(spark, marker_paths(root, marker) if marker else [], schema)


def write_aside(df: DataFrame, root, version, partition_by=()) -> str:
    """Write the rows of a version; nobody reads them yet."""
    path = f"{root}/{version}"
    df.write.option("compression", CODEC).mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def switch_version(spark: SparkSession, root, version, buckets=None, count=None) -> None:
    """Make a written version the current one.

    ``buckets`` names the version of each bucket that has rows, ``count`` the
    number of buckets of the table.
    """
    number = version.split("-")[0]
    fs, marker = hadoop_path(spark, f"{root}/_versions/{number}")
    try:
        stream = fs.create(marker, False)
    except Py4JJavaError as error:
        raise OSError(f"{root}: another writer published version {number}") from error
    stream.write(bytearray(json.dumps({"version": version, "buckets": buckets, "count": count}).encode()))
    stream.close()


def expire_versions(spark: SparkSession, root, keep=5) -> int:
    """Delete what only versions before the last ``keep`` hold; folders deleted.

    Run it when no reader of those versions is left; loads never call it.
    """
    numbers = _markers(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]
    held = {p for n in kept for p in marker_paths(root, _read_marker(spark, root, n))}
    stale = {p for n in old for p in marker_paths(root, _read_marker(spark, root, n))} - held
    # The markers go first: no version may name a folder that is gone.
    for n in old:
        remove(spark, f"{root}/_versions/{n}")
    for p in stale:
        remove(spark, p)
    return len(stale)
