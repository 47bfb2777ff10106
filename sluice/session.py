"""Sessions for local use, and the shared folder for cut lineage.

On a cluster the session is given; nothing here changes its master, memory or
shuffle settings.
"""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Parquet codec of written tables: hashes and texts take a good deal less room than with the default.
CODEC = "zstd"


def local_session(cpus="*", app_name="sluice", shuffle_partitions=8, memory="16g"):
    """A local session for tests, benches and trial runs."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Generated methods beyond this size are never compiled by the JVM;
        # Spark then splits the stage's expressions into smaller ones.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="sluice-")
        spark.sparkContext.setCheckpointDir(folder)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(work_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str, partition_by=()) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Cheaper than a checkpoint for wide frames: later reads prune columns and
    partitions, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.option("compression", CODEC).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_counted(df: DataFrame, label: str, partition_by=(), **metrics) -> tuple[DataFrame, dict]:
    """``materialize``, and ``metrics`` (name to aggregate) taken from the write itself, not by another scan.

    A task that is run again may count twice; callers that publish recount
    what they wrote, so such a count fails the load and is never published.
    """
    from pyspark.sql import Observation

    seen = Observation(label)
    out = materialize(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), label, partition_by)
    return out, observed(seen, lambda: out.agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict())


def observed(seen, otherwise) -> dict:
    """The metrics of an Observation; where no task reported them (an input without files or rows), ``otherwise()``."""
    try:
        return seen.get
    except Exception:  # noqa: BLE001 - Spark raises a bare assertion for missing metrics
        return otherwise()


def truncate_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small frame that several plans reuse."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)
