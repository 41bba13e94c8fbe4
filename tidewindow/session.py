"""Session settings, the shared scratch folder, and pinning of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Bytes of a helper table that may be broadcast, as measured before the join.
BROADCAST_BYTES = 64 << 20


def build_session(
    app: str = "tidewindow", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the jobs here are planned for.

    Keyword names use ``__`` for the dot: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session without
    that setting gets a temporary folder.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tidewindow-")
    context.setCheckpointDir(configured)
    return context._jsc.sc().getCheckpointDir().get()


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared one.

    All folders of an application lie together and can be deleted with it.
    """
    application = f"{shared_folder(spark)}/tidewindow-{spark.sparkContext.applicationId}"
    return f"{application}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``, so that every later use reads the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
